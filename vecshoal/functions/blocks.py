"""Arrow list columns as NumPy matrices and back, for task code that works on whole batches."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, all of ``width`` elements, as one float64 matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, dtype=np.float64).reshape(-1, width)


def list_column(rows: np.ndarray, present: np.ndarray | None = None) -> pa.Array:
    """A matrix as a list column; rows where ``present`` is False become NULL."""
    width = rows.shape[1]
    values = pa.array(np.ascontiguousarray(rows).ravel())
    if present is None or present.all():
        offsets = np.arange(0, rows.size + 1, width, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values)
    offsets = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~present))


def fitting(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``width`` finite numbers, and those rows as a matrix."""
    ok = pc.fill_null(pc.equal(pc.list_value_length(column), width), False)
    ok = ok.to_numpy(zero_copy_only=False).copy()
    rows = matrix(column if ok.all() else column.filter(pa.array(ok)), width)
    # A missing element reads as NaN, and one NaN or infinity spoils the sum of its row.
    with np.errstate(invalid="ignore"):
        finite = np.isfinite(rows.sum(axis=1))
    if not finite.all():
        ok[ok] = finite
        rows = rows[finite]
    return ok, rows


def count_widths(column: pa.Array, widths: Counter) -> None:
    """Add to ``widths`` how many rows of a list column have how many elements; NULLs count as -1."""
    for found in pc.value_counts(pc.fill_null(pc.list_value_length(column), -1)).to_pylist():
        widths[found["values"]] += found["counts"]


def map_vectors(column: pa.Array, width: int, apply) -> pa.Array:
    """Apply a matrix-to-matrix function to the fitting rows; other rows give NULL."""
    ok, rows = fitting(column, width)
    return list_column(apply(rows), ok)


def label_vectors(column: pa.Array, width: int, apply) -> pa.Array:
    """Apply a matrix-to-integers function to the fitting rows; other rows give NULL."""
    ok, rows = fitting(column, width)
    labels = np.zeros(len(ok), dtype=np.int32)
    labels[ok] = apply(rows)
    return pa.array(labels, type=pa.int32(), mask=~ok)
