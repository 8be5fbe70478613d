"""A trie of ordered sets, searched for the sets that are similar enough.

The trie is kept in pages.  Sets in the order of their paths stand side by
side; a leaf page holds up to ``LEAF`` neighbours, and a page above holds
``FAN`` pages.  Every page knows the path that all its sets begin with, their
sizes, and whether they have become one component.  All sets of a leaf page
are searched for at once: a page is left for all of them together, and two
leaf pages that meet get their overlaps from one product of matrices.  So the
pairs of a large group of near copies cost a few machine operations each, not
a walk of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = 512  # sets of a leaf page
LEAF_TOKENS = 1 << 18  # and their tokens, if more than one set
FAN = 16  # pages below a page
SLICE = 2048  # tokens of a dense product at once
EXPANDED = 1 << 21  # pairs counted one by one at once


@dataclass
class Page:
    """Sets ``first`` to ``last`` - 1 in path order, which all begin with the
    tokens ``path``; their sizes; the pages below, none in a leaf.

    ``one``: a set of the only component here, or -1 where there may be
    several."""

    first: int
    last: int
    path: np.ndarray
    shortest: int
    longest: int
    kids: list["Page"] = field(default_factory=list)
    one: int = -1
    holders: tuple | None = None


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    return int(differs[0]) if len(differs) else n


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + lengths, lengths)


class SetTrie:
    """Sets of numbers in ascending order, where smaller numbers are tokens of
    more sets, so that much of what sets share lies on shared paths.

    ``sizes`` are those of the whole sets; ``sets`` may lack tokens that no
    other set has.  Sets are searched in path order, and named by it."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, num: int, den: int) -> None:
        self.sets, self.sizes, self.num, self.den = sets, sizes, num, den
        self.above = list(range(len(sets)))  # union-find over the sets
        self.on_path = np.zeros(1 + max((int(s[-1]) for s in sets if len(s)), default=0), bool)
        self.leaves = self._leaves()
        level = self.leaves
        while len(level) > 1:
            level = [self._over(level[k : k + FAN]) for k in range(0, len(level), FAN)]
        self.root = level[0]

    def _page(self, first: int, last: int, kids: list[Page]) -> Page:
        """Sets are in path order, so the first and the last share what all share."""
        path = self.sets[first][: _common(self.sets[first], self.sets[last - 1])]
        sizes = self.sizes[first:last]
        return Page(first, last, path, int(sizes.min()), int(sizes.max()), kids)

    def _leaves(self) -> list[Page]:
        out, first, tokens = [], 0, 0
        for k, own in enumerate(self.sets):
            if k > first and (k - first == LEAF or tokens + len(own) > LEAF_TOKENS):
                out.append(self._page(first, k, []))
                first, tokens = k, 0
            tokens += len(own)
        return [*out, self._page(first, len(self.sets), [])]

    def _over(self, kids: list[Page]) -> Page:
        return self._page(kids[0].first, kids[-1].last, kids) if len(kids) > 1 else kids[0]

    def find(self, k: int) -> int:
        while self.above[k] != k:
            self.above[k] = self.above[self.above[k]]
            k = self.above[k]
        return k

    def join(self, a: int, b: int) -> None:
        self.above[self.find(b)] = self.find(a)

    def _roots(self, page: Page) -> np.ndarray:
        return np.array([self.find(k) for k in range(page.first, page.last)])

    def _holders(self, leaf: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of a leaf, where the holders of each begin, and the
        holders as rows of the leaf."""
        if leaf.holders is None:
            own = self.sets[leaf.first : leaf.last]
            flat = np.concatenate(own)
            order = np.argsort(flat, kind="stable")
            flat, rows = flat[order], np.repeat(np.arange(len(own), dtype=np.int32), [len(s) for s in own])[order]
            begins = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
            leaf.holders = (flat[begins], np.r_[begins, len(flat)], rows)
        return leaf.holders

    def _overlaps(self, a: Page, b: Page) -> np.ndarray:
        """How many tokens each set of leaf ``a`` shares with each of ``b``.

        Tokens with many holders are columns of two dense matrices, whose
        product counts them; pairs of holders of the others are counted one
        by one."""
        (tokens, begins, rows), (others, other_begins, other_rows) = self._holders(a), self._holders(b)
        height, width = a.last - a.first, b.last - b.first
        if a is b:
            here = there = np.arange(len(tokens))
        else:
            at = np.searchsorted(others, tokens)
            at[at == len(others)] = 0
            here = np.flatnonzero(others[at] == tokens) if len(others) else np.zeros(0, np.int64)
            there = at[here]
        held, other_held = begins[here + 1] - begins[here], other_begins[there + 1] - other_begins[there]
        pairs = held * other_held
        if a is b:
            kept = held > 1  # a set's overlap with itself is not asked for
            here, there, held, other_held, pairs = here[kept], there[kept], held[kept], other_held[kept], pairs[kept]
        out = np.zeros((height, width), np.float32)
        often = pairs * 64 >= height * width
        for part in np.array_split(np.flatnonzero(often), -(-int(often.sum()) // SLICE) or 1):
            if len(part):
                left = np.zeros((height, len(part)), np.float32)
                left[rows[_ranges(begins[here[part]], held[part])], np.repeat(np.arange(len(part)), held[part])] = 1
                right = left
                if a is not b:
                    right = np.zeros((width, len(part)), np.float32)
                    right[other_rows[_ranges(other_begins[there[part]], other_held[part])], np.repeat(np.arange(len(part)), other_held[part])] = 1
                out += left @ right.T
        rest = np.flatnonzero(~often)
        if len(rest):
            upto = np.cumsum(pairs[rest])
            for part in np.split(rest, np.flatnonzero(np.diff(upto // EXPANDED)) + 1):
                # Each holder in a, as often as the token has holders in b.
                mine = _ranges(begins[here[part]], held[part])
                times = np.repeat(other_held[part], held[part])
                left = np.repeat(rows[mine], times).astype(np.int64)
                right = other_rows[_ranges(np.repeat(other_begins[there[part]], held[part]), times)]
                out += np.bincount(left * width + right, minlength=height * width).reshape(height, width).astype(np.float32)
        return out

    def _meet(self, a: Page, b: Page) -> None:
        """Join the similar sets of two leaves."""
        sizes = self.sizes[a.first : a.last, None] + self.sizes[None, b.first : b.last]
        similar = self._overlaps(a, b).astype(np.int64) * (self.num + self.den) >= self.num * sizes
        if a is b:
            np.fill_diagonal(similar, False)
        while similar.any():
            # Each set with the first that it is not yet joined with, again.
            similar &= self._roots(a)[:, None] != self._roots(b)[None, :]
            for k in np.flatnonzero(similar.any(1)).tolist():
                self.join(a.first + k, b.first + int(similar[k].argmax()))

    def _can_fit(self, leaf: Page, sizes: np.ndarray, page: Page) -> bool:
        """Whether any set of ``leaf`` can be similar to one below ``page``:
        by size, and by its overlap with the page's path and all that can
        still follow on either side."""
        low, high = -(-sizes * self.num // self.den), sizes * self.den // self.num
        fits = (page.longest >= low) & (page.shortest <= high)
        if not fits.any() or not len(page.path) or leaf is page:
            return bool(fits.any())
        own = self.sets[leaf.first : leaf.last]
        lengths = np.array([len(s) for s in own])
        flat = np.concatenate(own)
        self.on_path[page.path] = True
        sums = np.r_[0, np.cumsum(self.on_path[flat])]
        self.on_path[page.path] = False
        passed = np.r_[0, np.cumsum(flat > page.path[-1])]
        ends = np.cumsum(lengths)
        reached, after = sums[ends] - sums[ends - lengths], passed[ends] - passed[ends - lengths]
        most = reached + np.minimum(page.longest - len(page.path), after)
        return bool((fits & (most * (self.num + self.den) >= self.num * (sizes + np.maximum(low, page.shortest)))).any())

    def _is_one(self, page: Page) -> bool:
        """Whether everything below has become one component."""
        if page.one < 0 and (all(self._is_one(kid) for kid in page.kids) if page.kids else True):
            firsts = {self.find(kid.one) for kid in page.kids} if page.kids else set(self._roots(page).tolist())
            if len(firsts) == 1:
                page.one = firsts.pop()
        return page.one >= 0

    def link(self, leaf: Page) -> None:
        """Join every set of ``leaf`` with the sets of Jaccard similarity
        num/den or more in this leaf and in those before."""
        sizes = self.sizes[leaf.first : leaf.last]
        stack = [self.root]
        while stack:
            page = stack.pop()
            if page.first >= leaf.last or not self._can_fit(leaf, sizes, page):
                continue
            if self._is_one(page) and self._is_one(leaf) and self.find(page.one) == self.find(leaf.one):
                continue
            if page.kids:
                stack.extend(page.kids)
            else:
                self._meet(leaf, page)


def linked(ids: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """``(id, smallest id of its component)`` of sets that are linked in
    chains of similar pairs: one trie of all sets, searched for each."""
    if not sets:
        return []
    # Numbers by falling frequency, so that paths are shared.
    tokens, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.empty(len(tokens), np.int32)
    number[np.argsort(-count, kind="stable")] = np.arange(len(tokens), dtype=np.int32)
    sizes = np.array([len(s) for s in sets])
    # Tokens of one set only count for its size.
    shared = np.split(number[where], np.cumsum(sizes)[:-1])
    most = int((count > 1).sum())
    ordered = [np.sort(x[x < most]) for x in shared]
    by_path = sorted(range(len(sets)), key=[x.astype(">i4").tobytes() for x in ordered].__getitem__)
    trie = SetTrie([ordered[k] for k in by_path], sizes[by_path], num, den)
    for leaf in trie.leaves:
        trie.link(leaf)
    least: dict[int, int] = {}
    roots = [trie.find(k) for k in range(len(sets))]
    for k, root in zip(by_path, roots):
        least[root] = min(ids[k], least.get(root, ids[k]))
    return [(ids[k], least[root]) for k, root in zip(by_path, roots)]
