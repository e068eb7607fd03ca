"""Number columns as compressed bytes."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed bytes, first bytes first: high bytes are mostly alike."""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    plain = np.frombuffer(zstandard.decompress(data), np.uint8)
    planes = plain.reshape(size, len(plain) // size)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray, kind: str) -> bytes:
    """Rising numbers as their differences."""
    return pack(np.diff(values.astype(kind), prepend=values.dtype.type(0)), kind)


def unpack_sorted(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)
