"""The declarative transform of a batch, in the order of its steps.

Steps are composed into few projections: text, standard timestamps and cleaning make one; casts,
renames and audit columns one each. Keys and the order column follow renames and are never excluded.
"""

from __future__ import annotations

import importlib
import importlib.util
import inspect
import types
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.exprs import HIGH_DATE, std_timestamp, yes_no
from siltlake.functions.names import AUDIT
from siltlake.sinks import state

#: Metadata columns of the landing zone, and where a delete flag may stand.
METADATA = (
    "_raw_data", "_ingest_timestamp", "_extracted_at", "_batch_id", "_source_system", "_source_table", "_file_name", "_file_path", "_row_num",
    "_ingested_at", "_table_name", "_execution_id", "_raw_payload",
)
DELETED = ("_is_deleted", "sys_is_deleted", "is_deleted", "deleted")


@dataclass
class Transform:
    """Configuration of one table's transform."""

    keys: Sequence[str] = ()
    order: str | None = None
    metadata: Sequence[str] = METADATA
    cast_all_to_string: bool = True
    illegal: str | None = None
    where: str | None = None
    casts: dict[str, str] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    exclude: Sequence[str] = ()
    hook: Callable[..., DataFrame] | None = None
    external: Sequence[str] = ()


def schema_lines(df: DataFrame) -> list[str]:
    """A line for each column, payload before audit columns: what a run logs of a batch's schema."""
    kinds = dict(df.dtypes)
    payload = [c for c in df.columns if c not in AUDIT]
    return [f"{len(df.columns)} columns, {len(payload)} of them payload"] + [f"{c}: {kinds[c]}" for c in [*payload, *(c for c in df.columns if c in AUDIT)]]


def load_hook(path: str, name: str = "transform") -> Callable[..., DataFrame]:
    """The function of that name in a Python file."""
    spec = importlib.util.spec_from_file_location("siltlake_hook", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return getattr(module, name)


def hook_in(spark: SparkSession, path: str, name: str = "transform") -> Callable[..., DataFrame] | None:
    """The function of that name in a Python file in any store that Spark reads; None where there is no such file."""
    if not state.exists(spark, path):
        return None
    module = types.ModuleType("siltlake_hook")
    exec(compile(spark.read.text(path, wholetext=True).first()["value"], path, "exec"), module.__dict__)
    return getattr(module, name)


def find_hook(spark: SparkSession, where: str, folders: Sequence[str] = (), source: str = "", table: str = "", name: str = "transform") -> Callable[..., DataFrame] | None:
    """A hook by its place: a file with a full path or address; else a file in one of the folders, in their order, under the name given
    or as `<source>_<table>.py`; else a module that can be imported, `package.module` or `package.module:function`. None where there is none.

    A file or module without the function is an error, as is one that fails.
    """
    if where.startswith("/") or "://" in where:
        return hook_in(spark, where, name)
    files = [w for w in (where, f"{source}_{table}.py" if source and table else "") if w.endswith(".py")]
    for folder in folders:
        for f in files:
            if found := hook_in(spark, f"{folder.rstrip('/')}/{f}", name):
                return found
    module, _, function = where.removesuffix(".py").replace("/", ".").partition(":")
    try:
        known = bool(module) and importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:  # a package on the way
        known = False
    return getattr(importlib.import_module(module), function or name) if known else None


def layered(df: DataFrame, hook: Callable[..., DataFrame] | None, context: dict[str, Any]) -> DataFrame:
    """df after its hook. A column that the hook makes stands for those of its name in any case that df had."""
    if hook is None:
        return df
    out = call_hook(hook, df, context)
    made = {c.lower() for c in out.columns if c not in df.columns}
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in df.columns or c.lower() not in made])


def call_hook(hook: Callable[..., DataFrame], df: DataFrame, context: dict[str, Any]) -> DataFrame:
    """hook(df), hook(df, spark) or hook(df, spark, context), by what it takes; context may be a keyword."""
    taken = inspect.signature(hook).parameters
    if "context" in taken and taken["context"].kind is inspect.Parameter.KEYWORD_ONLY:
        return hook(df, context=context)
    return hook(*(df, df.sparkSession, context)[: max(1, min(3, len(taken)))])


def cast(value: Column, kind: str) -> Column:
    """Casts that give null where they cannot; timestamps by the fixed format."""
    if kind.lower() in ("timestamp", "datetime"):
        return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss"))
    return value.try_cast(kind)


def audit(df: DataFrame, order: str | None, run_at: Column) -> DataFrame:
    """df with its audit columns, last and in their order."""
    flag = next((c for c in DELETED if c in df.columns), None)
    start = F.col(order).try_cast("timestamp") if order and order in df.columns else F.lit(None).cast("timestamp")
    values = {
        "_valid_from": F.date_trunc("second", F.coalesce(start, run_at)), "_valid_to": F.lit(HIGH_DATE).cast("timestamp"),
        "_is_current": yes_no(F.col("_is_current")) if "_is_current" in df.columns else F.lit("Y"),
        "_is_deleted": yes_no(F.col(flag)) if flag else F.lit("N"),
        "_inserted_at": F.col("_inserted_at").try_cast("timestamp") if "_inserted_at" in df.columns else run_at, "_updated_at": run_at,
    }
    return df.select(*[c for c in df.columns if c not in AUDIT], *[values[a].alias(a) for a in AUDIT])


def run(df: DataFrame, config: Transform, run_at: Column, context: dict[str, Any] | None = None) -> DataFrame:
    df = df.drop(*config.metadata)

    def as_text(c: str) -> Column:
        value = F.col(c)
        if config.cast_all_to_string and c not in AUDIT:
            value = value.cast("string")
        if dict(df.dtypes)[c] == "string" or (config.cast_all_to_string and c not in AUDIT):
            value = std_timestamp(value)
        if config.illegal and c not in AUDIT:
            value = F.regexp_replace(value.cast("string"), config.illegal, "")
        return value.alias(c)

    df = df.select(*map(as_text, df.columns))
    if config.where:
        df = df.where(config.where)
    if config.casts:
        df = df.select(*[cast(F.col(c), config.casts[c]).alias(c) if c in config.casts else F.col(c) for c in df.columns])
    for name, expression in config.derived.items():  # one by one, as a later one may use an earlier
        df = df.withColumn(name, F.expr(expression))
    df = df.withColumnsRenamed({a: b for a, b in config.renames.items() if a in df.columns})
    held = {config.renames.get(c, c) for c in [*config.keys, *([config.order] if config.order else [])]}
    df = df.drop(*[c for c in config.exclude if c not in held])
    if config.hook:
        df = call_hook(config.hook, df, context or {})
    df = df.withColumns({c: F.lit(None).cast("string") for c in config.external if c not in df.columns})
    return audit(df, config.renames.get(config.order, config.order), run_at)
