"""Alignment of two sequences: what is kept, removed and inserted.

Equal heads and tails are kept.  In between, items that occur once on each
side are anchors; the longest run of anchors that is in order on both sides
stays, and the stretches between anchors are aligned with the most items kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

KEPT, REMOVED, INSERTED = range(3)
KINDS = ["kept", "removed", "inserted"]

Pairs = list[tuple[int, int]]


def _once(items: np.ndarray) -> dict[int, int]:
    """Place of every item that occurs once."""
    values, first, counts = np.unique(items, return_index=True, return_counts=True)
    return dict(zip(values[counts == 1].tolist(), first[counts == 1].tolist()))


def _rising(pairs: Pairs) -> Pairs:
    """The longest run of pairs, sorted by their first place, whose second
    places rise."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, place) in enumerate(pairs):
        at = bisect_left(tops, place)
        before[i] = last[at - 1] if at else -1
        tops[at : at + 1] = [place]
        last[at : at + 1] = [i]
    out: Pairs = []
    i = last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _most_kept(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How many items can be kept between ``old`` and each head of ``new``."""
    row = np.zeros(len(new) + 1, np.int64)
    for item in old.tolist():
        kept = np.where(new == item, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(kept)
    return row


def _between(old: np.ndarray, new: np.ndarray, i: int, j: int) -> Pairs:
    """Pairs with the most items kept, in memory linear in the two lengths:
    halves of ``old`` meet where their counts sum up best."""
    out: Pairs = []
    work = [(old, new, i, j)]
    while work:
        old, new, i, j = work.pop()
        if not len(old) or not len(new):
            continue
        if len(old) == 1:
            places = np.flatnonzero(new == old[0])
            if len(places):
                out.append((i, j + int(places[0])))
            continue
        half = len(old) // 2
        head = _most_kept(old[:half], new)
        tail = _most_kept(old[half:][::-1], new[::-1])[::-1]
        cut = int((head + tail).argmax())
        work.append((old[half:], new[cut:], i + half, j + cut))
        work.append((old[:half], new[:cut], i, j))
    return sorted(out)


def kept_pairs(old: np.ndarray, new: np.ndarray) -> Pairs:
    """Places (in ``old``, in ``new``) of the items that are kept."""
    most = min(len(old), len(new))
    differs = np.flatnonzero(old[:most] != new[:most])
    head = int(differs[0]) if len(differs) else most
    rest = most - head
    differs = np.flatnonzero(old[len(old) - rest :][::-1] != new[len(new) - rest :][::-1])
    tail = int(differs[0]) if len(differs) else rest
    pairs = [(k, k) for k in range(head)]
    ends = (len(old) - tail, len(new) - tail)
    own, other = _once(old[head : ends[0]]), _once(new[head : ends[1]])
    anchors = _rising(sorted((head + place, head + other[item]) for item, place in own.items() if item in other))
    i, j = head, head
    for a, b in [*anchors, ends]:
        pairs += _between(old[i:a], new[j:b], i, j)
        if (a, b) != ends:
            pairs.append((a, b))
        i, j = a + 1, b + 1
    return pairs + [(len(old) - k, len(new) - k) for k in range(tail, 0, -1)]


def edit_steps(old: np.ndarray, new: np.ndarray) -> tuple[list[int], list[int]]:
    """Kind and place of each step: removed items by their place in ``old``,
    kept and inserted ones by their place in ``new``; of a stretch that was
    replaced, the removed items first."""
    kinds: list[int] = []
    places: list[int] = []
    i = j = 0
    for a, b in [*kept_pairs(old, new), (len(old), len(new))]:
        kinds += [REMOVED] * (a - i) + [INSERTED] * (b - j)
        places += [*range(i, a), *range(j, b)]
        if a < len(old):
            kinds.append(KEPT)
            places.append(b)
        i, j = a + 1, b + 1
    return kinds, places


def aligned_rows(kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the arrays ``old`` and ``new``: the columns ``kept`` and the
    steps between the two, a row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [
                edit_steps(np.array(old.as_py() or [], np.int64), np.array(new.as_py() or [], np.int64))
                for old, new in zip(batch.column("old"), batch.column("new"))
            ]
            found = [pa.array([s[k] for s in steps], pa.list_(pa.int32())) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], names=[*kept, "kinds", "places"])

    return run
