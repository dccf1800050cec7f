"""Number columns as bytes, for messages between tasks."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(values: np.ndarray) -> bytes:
    """The bytes of all values by significance, compressed; the high bytes of small numbers cost almost nothing."""
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.T).tobytes())


def unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(n * size, 1)), np.uint8).reshape(size, n)
    return np.ascontiguousarray(rows.T).view(kind).reshape(n)


def gaps(ascending: np.ndarray) -> np.ndarray:
    """Each value less the one before it; ``np.cumsum`` undoes it."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))
