"""Arrow string columns as flat byte arrays for numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 20


def flat_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; text i is bytes[offsets[i]:offsets[i + 1]], null like empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_groups(offsets: np.ndarray, limit: int = SEGMENT_BYTES):
    """Cut rows into runs [i, j) of about ``limit`` bytes; a longer row is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
