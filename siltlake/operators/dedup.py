"""Deduplication by key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orderable(kind: str) -> bool:
    """Whether values of a type, by its text, can be compared."""
    return not re.search(r"\b(map<|variant|interval$)", kind)


def _fields(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(names)])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], earliest: bool = False) -> DataFrame:
    """One row per key: the last by the order columns (nulls lose), or the first (nulls win).

    Ties are broken by all other columns, so the result does not depend on how rows are dealt out. It is the greatest
    or least of a struct of the row, in which nulls are least: an aggregate, of which each task
    sends one row per key on, so that the many rows of one key, or of a null key, never meet.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    kinds = dict(df.dtypes)
    ranked = [c for c in dict.fromkeys([*order, *rest]) if c not in keys and orderable(kinds[c])]
    if len(ranked) == len(rest):
        pick, names = (F.min if earliest else F.max)(_fields(ranked)), ranked
    else:
        names = rest
        pick = (F.min_by if earliest else F.max_by)(_fields(rest), _fields(ranked) if ranked else F.lit(0))
    at = {c: f"__row.c{n}" for n, c in enumerate(names)}
    one = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(pick.alias("__row"))
    return one.select(*[F.col(at[c]).alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])


def exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def by_first_present(df: DataFrame, keys: Sequence[str], candidates: Sequence[str] = ("updated_at", "created_at", "timestamp", "start_time")) -> DataFrame:
    """latest() by the first candidate column that df has; without any, an arbitrary but fixed row."""
    return latest(df, keys, [next((c for c in candidates if c in df.columns), keys[0])])


def one_per_key(df: DataFrame, keys: Sequence[str], what: str = "batch") -> DataFrame:
    """df, the rows of which are read only if every key has one: a key that comes twice ends the job with its values.

    The count is an aggregate over the key, so the many rows of one key never meet either; it costs a shuffle of df.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"), F.first(_fields(rest) if rest else F.lit(0)).alias("__row"))
    named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null"))) for k in keys])
    single = F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.concat(F.lit(f"the {what} has a key more than once: "), named, F.lit(" comes "), F.col("__n").cast("string"), F.lit(" times"))))
    at = {c: f"__row.c{n}" for n, c in enumerate(rest)}
    return counted.where(single).select(*[F.col(at[c]).alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])
