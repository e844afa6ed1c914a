"""Marts as a graph: what each reads, in which order they run, and their refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.names import TECHNICAL
from siltlake.operators import dedup, merge, reconcile, transform
from siltlake.sinks import tables


@dataclass(frozen=True)
class Mart:
    """build gets the frames of what it reads, in that order, and the run's timestamp."""

    name: str
    reads: Sequence[str]
    keys: Sequence[str]
    build: Callable[..., DataFrame]
    incremental: bool = False
    #: Buckets of keys the table is laid out in, so that a refresh rewrites those it touches alone; 0 rewrites the table.
    buckets: int = 0
    #: Applied to what the build gives; its columns stand for the build's of the same name, and those of `external` that neither has are null.
    hook: Callable[..., DataFrame] | None = None
    external: Sequence[str] = ()


def order(marts: Mapping[str, Mart], wanted: Sequence[str] | None = None) -> list[str]:
    """The wanted marts and all they rest on, dependencies first. A cycle is an error."""
    need, todo = set(), list(wanted or marts)
    while todo:
        name = todo.pop()
        if name not in marts:
            raise KeyError(f"no mart {name}")
        if name not in need:
            need.add(name)
            todo += [r for r in marts[name].reads if r in marts]
    graph = {n: sorted(r for r in marts[n].reads if r in marts) for n in sorted(need)}
    return list(TopologicalSorter(graph).static_order())


def refresh(spark: SparkSession, marts: Mapping[str, Mart], run_at: Column, wanted: Sequence[str] | None = None, halt: bool = False) -> dict[str, str]:
    """Builds marts in order and merges each into its table gold_<name>; failures are kept apart and raised at the end.

    A mart whose dependency failed is skipped. Returns each mart's status.
    """
    status: dict[str, str] = {}
    for name in order(marts, wanted):
        mart = marts[name]
        if any(status.get(r, "ok") != "ok" for r in mart.reads):
            status[name] = "skipped"
            continue
        try:
            built = mart.build(*[spark.table(f"gold_{r}" if r in marts else r) for r in mart.reads], run_at)
            table, rows = f"gold_{name}", conformed(built, mart)
            if mart.buckets:
                tables.merge_touched(rows, table, mart.keys, lambda target, batch, mart=mart: merged_mart(batch, target, mart, run_at), mart.buckets)
            else:
                tables.replace(merged_mart(rows, tables.current(spark, table), mart, run_at), table)
            status[name] = "ok"
        except Exception as e:
            if halt:
                raise
            status[name] = f"failed: {e}"
    if failed := {n: s for n, s in status.items() if s.startswith("failed")}:
        raise RuntimeError(f"marts failed: {failed}")
    return status


def hooked(built: DataFrame, mart: Mart) -> DataFrame:
    """What a build gives, after its hook and with its external columns."""
    return reconcile.resolve_columns(transform.layered(built, mart.hook, {"mart": mart.name}), mart.keys, mart.external)


def conformed(built: DataFrame, mart: Mart) -> DataFrame:
    """What a build gives: as text, one row per key."""
    return dedup.latest(reconcile.as_text(hooked(built, mart)), mart.keys, [c for c in built.columns if c not in TECHNICAL][:1])


def merged_mart(rows: DataFrame, target: DataFrame | None, mart: Mart, run_at: Column) -> DataFrame:
    """The mart's table after a build of rows, merged by key."""
    if mart.incremental:
        rows = merge.changed(rows, target, mart.keys)
    rows = rows.withColumns({"_updated_at": run_at, "_inserted_at": run_at})
    if target is None:
        return rows
    kept = target.select(*mart.keys, F.col("_inserted_at").alias("__first"))
    met = rows.alias("s").join(kept.alias("t"), merge.on_keys("s", "t", mart.keys), "left")
    rows = met.select(*[F.col(f"s.{c}") for c in rows.columns if c != "_inserted_at"], F.coalesce("t.__first", "s._inserted_at").alias("_inserted_at"))
    return merge.upsert(target, rows, mart.keys)
