"""Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 2 << 20  # bytes of texts that a task holds as Python objects


def by_size(texts: pa.Array, most: int = MOST) -> Iterator[tuple[int, int]]:
    """``offset, length`` of neighbouring rows with at most ``most`` bytes of
    text; a longer text is a stretch of its own."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield low, high - low
        low = high
