"""Integer vectors for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers a unit is parted into.
UNITS = 1024
#: Components must be smaller than this on either side, so that squared distances of 64 integers, and four times as much, fit in a long.
LARGEST = float(1 << 16)


def whole(vector: Column) -> Column:
    """True where a vector is there and has neither null nor non-finite components, nor any of LARGEST or more."""
    # NaN is greater than any number to Spark, so it fails the comparison as infinities do.
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST))


def integers(vector: Column) -> Column:
    """floor(UNITS * component) of each; tried only, as the planner may look at vectors that whole() drops."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * UNITS).try_cast("int"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of an Arrow batch as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x from all centers.

    As floats where all sums stay below 2 ** 53, since those are exact and faster; else as integers.
    """
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centers).max(initial=0)))
    kind = np.float64 if 4 * x.shape[1] * most * most < 1 << 53 else np.int64
    a, b = x.astype(kind), centers.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def component_sums(df: DataFrame, keys: list[str], width: int, *more: Column) -> DataFrame:
    """Adds up rows of (keys, n, sums): the counts and, component by component, the sums."""
    sums = [F.sum(F.col("sums")[i]) for i in range(width)]
    return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*sums).alias("sums"), *more)
