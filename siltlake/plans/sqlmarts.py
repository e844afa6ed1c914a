"""Marts written as SQL files; what each reads is found in its parsed plan."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence
from dataclasses import replace
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.names import base_name
from siltlake.operators import transform
from siltlake.plans.graph import Mart, hooked, order

#: Prefixes that a mart's name may be written with.
PREFIXES = ("gold_tbl_", "gold_", "v_")


def _each(seq: JavaObject) -> list[JavaObject]:
    return [seq.apply(k) for k in range(seq.size())]


def _found(plan: JavaObject, hidden: frozenset[str], out: dict[str, None]) -> None:
    """Adds the relations that a plan reads by name, in the order they are met. hidden are the names of common table expressions in scope."""
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedWith":
        scope = hidden
        for cte in _each(plan.cteRelations()):
            own = frozenset([cte._1().lower()])
            # Only a recursive expression sees itself; otherwise its name is still the table's inside it.
            _found(cte._2(), scope | own if plan.allowRecursion() else scope, out)
            scope |= own
        _found(plan.child(), scope, out)
        return
    if kind == "UnresolvedRelation":
        parts = _each(plan.multipartIdentifier())
        if len(parts) > 1 or parts[0].lower() not in hidden:
            out[".".join(parts)] = None
    for below in (*_each(plan.children()), *_each(plan.subqueries())):
        _found(below, hidden, out)


def relations(spark: SparkSession, sql: str) -> list[str]:
    """The tables and views that a query names, subqueries included; names in strings, comments and common table expressions are none."""
    out: dict[str, None] = {}
    _found(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset(), out)
    return list(out)


def mart_name(name: str, prefixes: Sequence[str] = PREFIXES) -> str:
    """A mart's name from a file's or a relation's."""
    return base_name(name.rpartition(".")[2], tuple(prefixes))


def read_files(spark: SparkSession, folder: str, prefixes: Sequence[str] = PREFIXES) -> dict[str, str]:
    """The text of each `*.sql` file of a folder by mart name; the folder may be in any store that Spark reads."""
    rows = spark.read.option("pathGlobFilter", "*.sql").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value").orderBy("file").collect()
    out: dict[str, str] = {}
    for r in rows:
        name = mart_name(posixpath.basename(unquote(r["file"]))[: -len(".sql")], prefixes)
        if name in out:
            raise ValueError(f"two files hold a mart {name}")
        out[name] = r["value"]
    if not out:
        raise FileNotFoundError(f"no SQL file in {folder}")
    return out


def evaluated(spark: SparkSession, sql: str, views: Mapping[str, DataFrame], run_at: Column) -> DataFrame:
    """The query's frame, with each view under its name while it is analysed; `:run_at` is the run's timestamp."""
    for name in views:
        if any(t.isTemporary and t.name.lower() == name.lower() for t in spark.catalog.listTables()):
            raise ValueError(f"{name} is both a mart and a view of the session")
    # As values: parameters are literals to Spark, and a timestamp with a cast is none.
    args = {"run_at": spark.range(1).select(run_at.cast("timestamp")).first()[0]} if re.search(r":run_at\b", sql) else {}
    try:
        for name, frame in views.items():
            frame.createTempView(name)
        return spark.sql(sql, args=args) if args else spark.sql(sql)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def discover(
    spark: SparkSession, folder: str, keys: Mapping[str, Sequence[str]], incremental: Sequence[str] = (), buckets: Mapping[str, int] | None = None, prefixes: Sequence[str] = PREFIXES,
    hooks: Sequence[str] = (), external: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, Mart]:
    """The marts of a folder of SQL files, each with the keys given for it.

    A relation that names another mart of the folder, with or without a prefix, is what the graph orders by; all others must be
    tables or views that the session knows. A mart that names itself reads its own table as it was. hooks are folders in which
    `<mart>.py` may hold a mart's transform; external names columns that are null where neither SQL nor transform gives them.
    """
    texts = read_files(spark, folder, prefixes)
    if lacking := sorted(set(texts) - set(keys)):
        raise ValueError(f"marts without keys: {lacking}")
    out = {}
    for name, sql in texts.items():
        made = _mart(spark, name, sql, texts, keys[name], prefixes)
        hook = transform.find_hook(spark, f"{name}.py", hooks) if hooks else None
        out[name] = replace(made, incremental=name in incremental, buckets=(buckets or {}).get(name, 0), hook=hook, external=(external or {}).get(name, ()))
    return out


def _mart(spark: SparkSession, name: str, sql: str, texts: Mapping[str, str], keys: Sequence[str], prefixes: Sequence[str]) -> Mart:
    written = {r: mart_name(r, prefixes) for r in relations(spark, sql)}
    inner = {r: m for r, m in written.items() if m in texts and m != name}
    outer = [r for r in written if r not in inner]
    reads = [*dict.fromkeys(inner.values()), *outer]

    def build(*given) -> DataFrame:
        *frames, run_at = given
        of = dict(zip(reads, frames))
        return evaluated(spark, sql, {r: of[m] for r, m in inner.items() if "." not in r}, run_at)  # a name with its schema is the catalogue's

    return Mart(name, reads, keys, build)


def frames(spark: SparkSession, marts: Mapping[str, Mart], run_at: Column, wanted: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The wanted marts and all they rest on as frames of one plan, without a table between them."""
    out: dict[str, DataFrame] = {}
    for name in order(marts, wanted):
        out[name] = hooked(marts[name].build(*[out[r] if r in marts else spark.table(r) for r in marts[name].reads], run_at), marts[name])
    return out
