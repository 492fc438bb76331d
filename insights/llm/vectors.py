"""Reading of embedding columns, for the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector of doubles is there and holds neither nulls nor NaN nor infinities."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))


def dimension(vectors: DataFrame, column: str) -> int:
    """The commonest length of the vectors (of equally common ones the greatest); 0 if there are none."""
    size = F.size(column)
    most = vectors.groupBy(size.alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return most["d"] if most else 0


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The rows of a list column, all of length ``d``, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
