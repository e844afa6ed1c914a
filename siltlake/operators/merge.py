"""Merges of a batch into a keyed table, as functions from DataFrames to a DataFrame.

Each takes the target as it is and the incoming batch and returns the target as it becomes, so the
same code serves batch jobs, foreachBatch and tests. A merge keeps one row per key (of scd2: one that is current), so a
batch must have each key once: what happens to one that comes twice is told by `duplicates`, which is `error`, and ends the
job where its rows are read, or `latest`, which takes the key's last row by the order column, ties by all columns.
run_at is the run's one timestamp. Columns are matched by name, whatever its case; those that one
side lacks are null there, and a side with two names that differ in case alone is an error. A null key is a
key like any other, so that a batch merged again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.functions.exprs import HIGH_DATE
from siltlake.functions.names import AUDIT, payload
from siltlake.operators import dedup

ERROR, LATEST = "error", "latest"


def by_lower_case(df: DataFrame) -> dict[str, str]:
    """Column names by their lower case."""
    out: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in out:
            raise ValueError(f"columns {out[c.lower()]} and {c} differ in case alone")
        out[c.lower()] = c
    return out


def aligned(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns of either under the target's names, the target's first; new ones are null."""
    mine, theirs = by_lower_case(target), by_lower_case(source)
    kinds = {f.name.lower(): f.dataType for f in source.schema} | {f.name.lower(): f.dataType for f in target.schema}
    names = theirs | mine
    order = [*mine, *(c for c in theirs if c not in mine)]

    def pad(df: DataFrame, own: dict[str, str]) -> DataFrame:
        return df.select(*[(F.col(f"`{own[c]}`") if c in own else F.lit(None)).cast(kinds[c]).alias(names[c]) for c in order])

    return pad(target, mine), pad(source, theirs)


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Whether any of the columns differs between two aliases; nulls are equal to each other."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def on_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def matched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column, Column]:
    """Full outer join as t and s, and whether a row has either side."""
    met = target.withColumn("__t", F.lit(True)).alias("t").join(source.withColumn("__s", F.lit(True)).alias("s"), on_keys("t", "s", keys), "full_outer")
    return met, F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()


def single(source: DataFrame, keys: Sequence[str], order: str | None, duplicates: str) -> DataFrame:
    """The batch with one row per key."""
    if duplicates == LATEST:
        return dedup.latest(source, keys, [order] if order else [])
    if duplicates != ERROR:
        raise ValueError(f"duplicates is {ERROR} or {LATEST}, not {duplicates}")
    return dedup.one_per_key(source, keys)


def audited(df: DataFrame, order: str, run_at: Column) -> DataFrame:
    """df with the audit columns it lacks."""
    fill = {
        "_valid_from": F.coalesce(F.col(order).try_cast("timestamp"), run_at), "_valid_to": F.lit(HIGH_DATE).cast("timestamp"),
        "_is_current": F.lit("Y"), "_is_deleted": F.lit("N"), "_inserted_at": run_at, "_updated_at": run_at,
    }
    return df.select(*[c for c in df.columns if c not in AUDIT], *[F.col(a) if a in df.columns else fill[a].alias(a) for a in AUDIT])


def scd1(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str, run_at: Column, duplicates: str = ERROR) -> DataFrame:
    """Type 1: a changed row that is not older overwrites; _inserted_at stays; new rows come in; the rest is untouched."""
    target, source = aligned(target, audited(source, order, run_at))
    source = single(source, keys, order, duplicates)
    content = payload(target.columns, list(keys))
    met, there, came = matched(target, source, keys)
    newer = F.col(f"t.{order}").isNull() | (F.col(f"s.{order}") >= F.col(f"t.{order}"))
    update = there & came & differs("t", "s", [*content, "_is_deleted"]) & newer
    take = F.coalesce(update, F.lit(False)) | ~there
    stamps = {"_inserted_at": F.when(there, F.col("t._inserted_at")).otherwise(run_at), "_updated_at": F.when(take, run_at).otherwise(F.col("t._updated_at")), "_is_current": F.when(take, F.lit("Y")).otherwise(F.col("t._is_current"))}
    return met.select(*[stamps.get(c, F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))).alias(c) for c in target.columns])


def scd2(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str, run_at: Column, duplicates: str = ERROR) -> DataFrame:
    """Type 2: a changed row that is not older closes the current version and opens another; an older one is dropped."""
    source = audited(source, order, run_at).withColumns({"_valid_from": F.coalesce(F.col(order).try_cast("timestamp"), run_at), "_valid_to": F.lit(HIGH_DATE).cast("timestamp"), "_is_current": F.lit("Y"), "_inserted_at": run_at, "_updated_at": run_at})
    target, source = aligned(target, source)
    source = single(source, keys, order, duplicates)
    content = payload(target.columns, list(keys))
    current, closed = target.where("_is_current = 'Y'"), target.where("NOT (_is_current <=> 'Y')")
    met, there, came = matched(current, source, keys)
    newer = F.col("t._valid_from").isNull() | (F.col("s._valid_from") >= F.col("t._valid_from"))
    turn = F.coalesce(there & came & differs("t", "s", [*content, "_is_deleted"]) & newer, F.lit(False))
    close = {"_is_current": F.when(turn, F.lit("N")).otherwise(F.col("t._is_current")), "_valid_to": F.when(turn, F.col("s._valid_from")).otherwise(F.col("t._valid_to")), "_updated_at": F.when(turn, run_at).otherwise(F.col("t._updated_at"))}
    old = F.struct(*[close.get(c, F.col(f"t.{c}")).alias(c) for c in target.columns])
    new = F.struct(*[F.col(f"s.{c}").alias(c) for c in target.columns])
    # One pass over the join: a key gives its old version, its new one, or both.
    versions = F.array_compact(F.array(F.when(there, old), F.when(turn | ~there, new)))
    opened = met.select(F.explode(versions).alias("v")).select("v.*")
    return opened.unionByName(closed)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str | None = None, duplicates: str = ERROR) -> DataFrame:
    """Source rows replace those of their keys; the rest stays."""
    target, source = aligned(target, source)
    source = single(source, keys, order, duplicates)
    return target.alias("t").join(source.select(*keys).alias("s"), on_keys("t", "s", keys), "left_anti").unionByName(source)


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    target, source = aligned(target, source)
    return target.unionByName(source)


def delta(incoming: DataFrame, target: DataFrame | None, keys: Sequence[str], stamp: str = "_updated_at", enriched: str | None = None) -> DataFrame:
    """Incoming rows worth merging: new keys, newer stamps, or keys whose enrichment is still null in the target."""
    if target is None:
        return incoming
    stamped = stamp in incoming.columns and stamp in target.columns
    kept = [*keys, *([stamp] if stamped else []), *([enriched] if enriched and enriched in target.columns else [])]
    known = target.select(*[F.col(c).alias(f"__{c}") for c in kept], F.lit(True).alias("__known"))
    same = [incoming[k].eqNullSafe(known[f"__{k}"]) for k in keys]
    pick = F.col("__known").isNull()
    if stamped:
        pick = pick | (F.col(stamp) > F.col(f"__{stamp}"))
    if enriched and enriched in target.columns:
        pick = pick | F.col(f"__{enriched}").isNull()
    return incoming.join(known, same, "left").where(pick).select(incoming.columns)


def changed(incoming: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Incoming rows that are new or whose content differs from the target's."""
    if target is None:
        return incoming
    content = [c for c in payload(incoming.columns, list(keys)) if c in target.columns]
    met = incoming.alias("s").join(target.withColumn("__known", F.lit(True)).alias("t"), on_keys("s", "t", keys), "left")
    return met.where(F.col("t.__known").isNull() | differs("s", "t", content)).select("s.*")


def missing_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of df that other lacks; a null key is a key like any other."""
    mine, theirs = df.select(*keys).dropDuplicates(), other.select(*keys)
    return mine.alias("t").join(theirs.alias("s"), on_keys("t", "s", keys), "left_anti")


STRATEGIES = {"scd1": scd1, "scd2": scd2, "upsert": scd1, "merge_into": scd1}


def apply(strategy: str, target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: str, run_at: Column, duplicates: str = ERROR) -> DataFrame:
    """The table after a batch by the configured strategy; anything unknown appends."""
    if strategy == "overwrite":
        return audited(source, order, run_at)
    if strategy in STRATEGIES:
        if target is None:
            return single(audited(source, order, run_at), keys, order, duplicates)
        return STRATEGIES[strategy](target, source, keys, order, run_at, duplicates)
    if target is None:
        return audited(source, order, run_at)
    return append(target, audited(source, order, run_at))
