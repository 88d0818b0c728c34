"""Vectors of an Arrow batch as numpy matrices, and whole-number vectors as short bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LIMIT = float(2**62)  # whole numbers are held to this, either way


def matrices(array: pa.Array, take: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) for each length among the vectors that are not null and hold finite numbers only.

    ``take`` leaves out rows. An empty vector is a vector of length 0.
    """
    lengths = array.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = array.flatten().cast(pa.float64())
    finite = np.isfinite(values.to_numpy(zero_copy_only=False)) & ~values.is_null().to_numpy(zero_copy_only=False)
    held = np.maximum(lengths, 0)
    first = np.concatenate([[0], np.cumsum(held)])
    good = np.concatenate([[0], np.cumsum(finite)])
    fit = (lengths >= 0) & (good[first[1:]] - good[first[:-1]] == held)
    if take is not None:
        fit &= take
    numbers = values.to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[fit]).tolist():
        rows = np.flatnonzero(fit & (lengths == length))
        yield rows, numbers[first[rows][:, None] + np.arange(length)]


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * value) as int64, held to ±2^62."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64)


def packed(x: np.ndarray) -> list[pa.Array]:
    """Each row of an int64 matrix as bytes: a width of 1, 2, 4 or 8, then the numbers in the least width that holds the row.

    Equal vectors have equal bytes. Rows come in arrays of one width, not in their order.
    """
    most = np.maximum(x.max(axis=1, initial=0), ~x.min(axis=1, initial=0))
    widths, out = 1 << np.searchsorted([2**7, 2**15, 2**31], most, side="right"), []
    for width in np.unique(widths).tolist():
        part = x[widths == width].astype(f"<i{width}")
        data = np.frombuffer(part.tobytes(), np.uint8).reshape(len(part), width * x.shape[1])
        data = np.hstack([np.full((len(data), 1), width, np.uint8), data])
        offsets = np.arange(len(data) + 1, dtype=np.int32) * data.shape[1]
        out.append(pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]))
    return out


def unpacked(array: pa.Array, length: int) -> Iterator[np.ndarray]:
    """int64 matrices of the packed vectors, which all have this length."""
    sizes = pa.compute.binary_length(array).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = array.filter(pa.array(sizes == size))
        data = np.frombuffer(b"".join(rows.to_pylist()), np.uint8).reshape(-1, size)[:, 1:]
        width = (size - 1) // max(length, 1)
        yield np.ascontiguousarray(data).view(f"<i{max(width, 1)}").astype(np.int64).reshape(len(rows), length)
