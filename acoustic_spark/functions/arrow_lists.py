"""Arrow list columns as numpy rows and back, used inside Arrow UDFs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ARROW_TYPES = {"float": pa.float32(), "double": pa.float64()}


def _lists(sizes, values: pa.Array) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def raw_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """Every list of a column as a view of its values, whatever their type (null as empty)."""
    values, offsets = np.asarray(column.values), np.asarray(column.offsets)
    for start, end, valid in zip(offsets[:-1], offsets[1:], np.asarray(column.is_valid())):
        yield values[start : end if valid else start]


def list_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """Every list of a column as doubles, one at a time (null as empty)."""
    for values in raw_rows(column):
        yield values.astype(np.float64)


def matrix_rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A list<list<value>> column as one matrix of all inner lists, and the outer sizes."""
    inner = column.flatten()
    values = np.asarray(inner.flatten(), dtype=np.float64)
    if values.size != len(inner) * width:
        raise ValueError(f"expected inner lists of {width} values")
    return values.reshape(-1, width), np.asarray(column.value_lengths().fill_null(0))


def flat_lists(rows: list[np.ndarray], value_type: pa.DataType) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.empty(0)
    return _lists([len(r) for r in rows], pa.array(flat, value_type))


def matrix_lists(matrix: np.ndarray, value_type: pa.DataType) -> pa.Array:
    """One list per matrix row."""
    return _lists(np.full(len(matrix), matrix.shape[1]), pa.array(matrix.ravel(), value_type))


def nested(matrices: list[np.ndarray], value_type: pa.DataType) -> pa.Array:
    """One list<list<value>> per matrix."""
    widths = np.concatenate([np.full(len(m), m.shape[1]) for m in matrices]) if matrices else []
    flat = np.concatenate([m.ravel() for m in matrices]) if matrices else np.empty(0)
    return _lists([len(m) for m in matrices], _lists(widths, pa.array(flat, value_type)))


def regroup(matrix: np.ndarray, sizes: np.ndarray, value_type: pa.DataType) -> pa.Array:
    """Rows of one matrix as list<list<value>> with the given outer sizes."""
    return _lists(sizes, matrix_lists(matrix, value_type))
