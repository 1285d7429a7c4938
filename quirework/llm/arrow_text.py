"""Arrow text as numpy arrays of code points, and back, without a string call per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column in one uint32 array, and the n + 1 offsets of its rows; null as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=starts[1:])
    cps = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return cps, starts[at - at[0]]


def to_arrow(cps: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of `code_points`."""
    width = np.ones(len(cps), np.int64)
    width += (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
    ends = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(width, out=ends[1:])
    raw = cps.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    buffers = [None, pa.py_buffer(ends[offsets].astype(np.int64).tobytes()), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers).cast(pa.string())


def per_row_any(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether any flag of a row is set."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] > sums[offsets[:-1]]
