"""Arrow batches in bounded pieces, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
PIECE_ROWS = 1024


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with up to `limit` bytes in the column and `rows` rows; a longer value is a slice alone."""
    sizes = batch.column(column)
    sizes = pa.compute.binary_length(sizes).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(batch):
        before = ends[low - 1] if low else 0
        high = max(low + 1, min(low + rows, int(np.searchsorted(ends, before + limit, side="right"))))
        yield batch.slice(low, high - low)
        low = high
    pa.default_memory_pool().release_unused()  # workers live on after their task


def binary_rows(flat: np.ndarray, first: np.ndarray) -> pa.Array:
    """Rows flat[first[i]:first[i + 1]] as binary values."""
    width = flat.dtype.itemsize
    offsets = pa.py_buffer((first * width).astype(np.int64))
    data = pa.py_buffer(np.ascontiguousarray(flat).view(np.uint8))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1, [None, offsets, data]).cast(
        pa.binary()
    )
