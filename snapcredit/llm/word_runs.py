"""Words of a chunk of UTF-8 texts, laid end to end with one space after each, and the bytes of stretches of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes with A-Z lower-cased; bytes of longer characters stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the byte values in some inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


def with_breaks(raw: np.ndarray, lengths: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid end to end with one byte `mark` after each, and the end of each text."""
    ends = np.cumsum(lengths)
    return np.insert(raw, ends, mark), ends + np.arange(1, len(ends) + 1)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each maximal run of true values."""
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def joined(raw: np.ndarray, inside: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `inside` with one space after each, and where each starts."""
    start = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(np.sum(length)) + len(length), 0x20, np.uint8)
    out[np.arange(len(out) - len(length)) + np.repeat(np.arange(len(length)), length)] = raw[inside]
    return out, start


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each stretch, stretches one after another; they may overlap."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def texts_of(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The stretches as an Arrow array of strings."""
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    data = raw[spread(start, length)]
    held = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
    return held if offsets[-1] >= 1 << 31 else held.cast(pa.string())
