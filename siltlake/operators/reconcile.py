"""Reconciling a frame with the schema of the table it goes to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions.exprs import conform_timestamp
from siltlake.functions.names import sanitise, timestamp_like


def reconcile(df: DataFrame, target: T.StructType) -> DataFrame:
    """Target columns in their order, then extra ones.

    Columns are matched by name, else by sanitised name, the first of several that share one; timestamp columns are conformed to
    text, other columns cast to the target's type; columns that df lacks are null; extra columns are kept
    under their sanitised names, with a number where one is taken.
    """
    by_name: dict[str, str] = {}
    for c in df.columns:
        name, n = sanitise(c), 2
        while name in by_name:
            name, n = f"{sanitise(c)}_{n}", n + 1
        by_name[name] = c
    exact = {c: n for n, c in by_name.items()}
    out = []
    for f in target:
        source = by_name.pop(exact.get(f.name, sanitise(f.name)), None)
        if source is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif timestamp_like(f.name, f.dataType):
            text = conform_timestamp(F.col(f"`{source}`"), df.schema[source].dataType)
            out.append((text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f"`{source}`").try_cast(f.dataType).alias(f.name))
    return df.select(*out, *[F.col(f"`{c}`").alias(n) for n, c in by_name.items()])


def resolve_columns(df: DataFrame, keys: Sequence[str], external: Sequence[str] = ()) -> DataFrame:
    """Keys first; of names equal but for case the first wins; absent external columns as nulls."""
    seen: set[str] = set()
    names = [c for c in [*keys, *df.columns] if c in df.columns and not (c.lower() in seen or seen.add(c.lower()))]
    return df.select(*names, *[F.lit(None).cast("string").alias(c) for c in external if c.lower() not in seen])


def as_text(df: DataFrame, kept: Sequence[str] = ("_updated_at", "_inserted_at", "_data_as_of")) -> DataFrame:
    """All columns as strings but for the kept ones."""
    return df.select(*[F.col(c) if c in kept else F.col(c).cast("string").alias(c) for c in df.columns])


def probe(spark: SparkSession, sql: str) -> T.StructType:
    """The schema of a query; nothing runs."""
    return spark.sql(sql).schema


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """All batches by name; a column whose type differs between them becomes a string."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for c, kind in df.dtypes:
            kinds.setdefault(c, set()).add(kind)
    mixed = {c for c, k in kinds.items() if len(k) > 1}
    cast = [df.select(*[F.col(c).cast("string").alias(c) if c in mixed else F.col(c) for c in df.columns]) for df in frames]
    out = cast[0]
    for df in cast[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
