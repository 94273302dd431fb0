"""Columns of lists as Arrow functions see them, a batch of rows at once: entries are flat arrays, and null lists have none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lengths(lists: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)


def parents(lists: pa.Array) -> np.ndarray:
    """The row of each entry."""
    n = lengths(lists)
    return np.repeat(np.arange(len(n)), n)


def starts(lists: pa.Array) -> np.ndarray:
    n = lengths(lists)
    return np.cumsum(n) - n


def places(lists: pa.Array) -> np.ndarray:
    """The place of each entry in its list."""
    rows = parents(lists)
    return np.arange(len(rows)) - starts(lists)[rows]


def spread(lists: pa.Array, *values: pa.Array) -> list[pa.Array]:
    """Values of rows, once for each entry of the row's list."""
    rows = pa.array(parents(lists))
    return [v.take(rows) for v in values]


def fields(lists: pa.Array, *names: str) -> list[pa.Array]:
    """Fields of all entries; those of a null entry are null."""
    flat = lists.flatten()
    return [pc.struct_field(flat, n) for n in names]


def entries_at(lists: pa.Array, rows: np.ndarray, at: np.ndarray) -> pa.Array:
    """The flat index of entry ``at`` of each row's list, null where it has none."""
    return pa.array(starts(lists)[rows] + at, mask=at >= lengths(lists)[rows])


def relisted(lists: pa.Array, **columns: pa.Array) -> pa.Array:
    """Structs of these fields in lists as long as the given ones, null where those are."""
    ends = pa.array(np.r_[0, np.cumsum(lengths(lists))].astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(list(columns.values()), list(columns)), mask=lists.is_null())


def totals(lists: pa.Array, values: pa.Array) -> pa.Array:
    """Sums of the entries' values by list, added in their order; null for a null list and where a value is."""
    rows, some = parents(lists), np.asarray(values.is_valid())
    numbers = np.asarray(pc.fill_null(values, 0), dtype=np.float64)
    lost = np.bincount(rows[~some], minlength=len(lists)) > 0
    return pa.array(np.bincount(rows, numbers, len(lists)), mask=lost | np.asarray(lists.is_null()))


def hits(lists: pa.Array, values: pa.Array) -> np.ndarray:
    """How many entries of each list are true."""
    return np.bincount(parents(lists)[np.asarray(pc.fill_null(values, False))], minlength=len(lists))


def binaries(rows: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Rows of a byte matrix as binaries."""
    rows = np.ascontiguousarray(rows, np.uint8)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    valid = None if missing is None or not missing.any() else pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [valid, pa.py_buffer(ends), pa.py_buffer(rows)])


def byte_rows(values: pa.Array) -> np.ndarray:
    """Binaries of one length, none of them null, as the rows of a matrix."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(values), -1)


def line_steps(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of many one-pixel lines between whole places, one by one: (which line, x, y)."""
    n = np.maximum(np.maximum(np.abs(x1 - x0), np.abs(y1 - y0)), 1)
    line = np.repeat(np.arange(len(n)), n + 1)
    i = np.arange(len(line)) - (np.cumsum(n + 1) - n - 1)[line]
    at = lambda a, b: np.floor(a[line] + (b - a)[line] * i / n[line] + 0.5).astype(np.int64)
    return line, at(x0, x1), at(y0, y1)


def slices(n: int, each: int, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many cells, one row at least."""
    step = max(1, most // max(1, each))
    return ((a, min(n, a + step)) for a in range(0, n, step))
