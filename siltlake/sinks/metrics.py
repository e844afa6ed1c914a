"""Row counts that a write gives on the way, without a job of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, Observation]:
    """df, and an observation that has `rows` and `null_keys` once df has been written."""
    seen = Observation()
    blank = F.lit(False)
    for k in keys or []:
        blank = blank | F.col(k).isNull()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.when(blank, 1).otherwise(0)).alias("null_keys")), seen
