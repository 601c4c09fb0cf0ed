"""Vectors as whole numbers: components times 256, all floors going down."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col

SCALE = 256


def largest(dim: int) -> int:
    """Components up to this keep squared distances, and sums of a billion vectors, within a long."""
    return min(1 << 30, math.isqrt((1 << 62) // max(dim, 1)) // 2)


def usable(vector: str, dim: int) -> Column:
    """Whether a vector has `dim` components, none null, NaN, infinite or beyond `largest`."""
    bound = F.lit(float(largest(dim) // SCALE))
    fits = F.forall(col(vector), lambda x: x.isNotNull() & (F.abs(x) <= bound))  # NaN is above all numbers
    return F.coalesce((F.size(col(vector)) == dim) & fits, F.lit(False))


def whole(column: pa.Array, dim: int) -> np.ndarray:
    """rows x dim whole numbers, of a column of usable vectors only."""
    flat = np.asarray(pc.cast(column.flatten(), pa.float64()), dtype=np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), dim)


def floor_mean(total: int, count: int) -> int:
    return total // count


def starting(rows: DataFrame, n: int, dim: int, *order: Column) -> np.ndarray:
    """The first `n` rows of (id, vector) under an order, as whole numbers; equal ones by their components."""
    first = rows.where("id is not null").orderBy(*order, "vector").select("vector").limit(n).toArrow()
    return whole(first.column("vector").combine_chunks(), dim) if first.num_rows else np.zeros((0, dim), dtype=np.int64)
