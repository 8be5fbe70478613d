"""Words of many texts as 64-bit hashes, in numpy over a batch's bytes."""

from __future__ import annotations

import numpy as np

# Odd multipliers and seeds; any others would do as well.
BASE = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = 1 << 20


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base & (2**64 - 1))
    return np.multiply.accumulate(out)


_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SEGMENT + 1)
        _POWERS["up"] = _power_table(int(BASE), size)
        _POWERS["down"] = _power_table(pow(int(BASE), -1, 2**64), size)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def table_of(members: bytes | range, low: bool = True) -> np.ndarray:
    """Which bytes belong to ``members``."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words between the six blanks.
IN_WORD = ~table_of(b" \t\n\x0b\x0c\r")
#: ASCII letters and every byte of a longer character.
IN_LETTERS = table_of([*range(65, 91), *range(97, 123), *range(128, 256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and how many words each text has."""
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at[:-1]] = True
    edge[-1] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.diff(np.searchsorted(starts, at))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span, A-Z as a-z.  Spans are in order; bytes are taken in
    segments, so that temporary arrays stay small."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        low = int(starts[done])
        upto = max(done + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        high = int(ends[upto - 1])
        up, down = _powers(high - low + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[_LOWER[data[low:high]]] * up[:-1], out=sums[1:])
            s, e = starts[done:upto] - low, ends[done:upto] - low
            out[done:upto] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        done = upto
    return out


def shingles(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width``
    words; fewer words are one run, no word none."""
    starts, ends, counts = spans(data, at, IN_WORD)
    words = span_hashes(data, starts, ends)
    scale = _power_table(0xD6E8FEB86659FD93, width + 1)[1:]
    out, begin = [], 0
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            runs += words[k : k + len(runs)] * scale[k]
        runs = mix(runs)
        for count in counts.tolist():
            if count >= width:
                out.append(np.unique(runs[begin : begin + count - width + 1]))
            elif count:
                short = (words[begin : begin + count] * scale[:count]).sum(dtype=np.uint64) + np.uint64(count)
                out.append(mix(np.array([short], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            begin += count
    return out
