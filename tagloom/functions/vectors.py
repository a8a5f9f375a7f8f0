"""Vector arithmetic on ``array<double>`` Columns.

``dot``/``norm``/``cosine`` are built-in expressions. ``matrix_product`` is the
batched form for scoring one vector against many fixed ones: an Arrow batch is
reshaped to a matrix and multiplied once, several times faster than one
higher-order function per fixed vector (see README, "Measured choices").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_column(df: DataFrame, name: str) -> Column:
    """The column as ``array<double>``, whether it holds ML vectors or arrays."""
    return raw_array_column(df, name).cast("array<double>")


def raw_array_column(df: DataFrame, name: str) -> Column:
    """The column as an array in its own element type (``float`` stays narrow)."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return F.when(F.col(name).isNotNull(), vector_to_array(F.col(name)))
    return F.col(name)


def dot(a: Column, b: Column) -> Column:
    """Null when lengths differ or any element is null."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, 0 when either vector has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0.0, 0.0).otherwise(dot(a, b) / lengths)


def unit(a: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays zero."""
    length = norm(a)
    return F.when(length == 0.0, a).otherwise(F.transform(a, lambda x: x / length))


def unit_rows(rows: Sequence[Sequence[float]]) -> np.ndarray:
    matrix = np.asarray(rows, dtype="float64")
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def matrix_product(
    matrix: np.ndarray, *, unit_input: bool = False, bias: np.ndarray | None = None,
    logistic: bool = False,
) -> Callable[[Column], Column]:
    """Function from a vector Column to ``array<double>``: one value per matrix row.

    ``unit_input`` scales each incoming vector to length 1 (zero stays zero), so
    with unit rows the result is the cosine. ``logistic`` maps ``w.x + b`` to a
    probability. A null vector, null element or wrong length gives a null array.
    The matrix travels in the function's closure, so keep it small.

    Marked non-deterministic so that Spark neither copies it into a filter below
    nor repeats it: each row is multiplied once.
    """
    weights = np.ascontiguousarray(np.asarray(matrix, dtype="float64").T)
    offset = None if bias is None else np.asarray(bias, dtype="float64")
    dim, width = weights.shape

    @F.arrow_udf("array<double>")
    def multiply(batch: pa.Array) -> pa.Array:
        fits = pc.equal(pc.list_value_length(batch), dim).fill_null(False)
        values = batch.filter(fits).flatten()
        usable = fits.to_numpy(zero_copy_only=False).copy()
        x = values.to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim)
        if values.null_count:
            holes = pc.is_null(values).to_numpy(zero_copy_only=False).reshape(-1, dim)
            whole = ~holes.any(axis=1)
            usable[np.flatnonzero(usable)[~whole]] = False
            x = x[whole]
        if unit_input:
            lengths = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            x = np.divide(x, lengths, out=np.zeros_like(x), where=lengths > 0)
        out = x @ weights
        if offset is not None:
            out = out + offset
        if logistic:
            with np.errstate(over="ignore"):
                out = 1.0 / (1.0 + np.exp(-out))
        ends = np.concatenate([[0], np.cumsum(usable)]) * width
        return pa.ListArray.from_arrays(
            pa.array(ends.astype("int32")),
            pa.array(out.ravel()),
            mask=pa.array(~usable),
        )

    return multiply.asNondeterministic()
