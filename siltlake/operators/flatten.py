"""Flattening of nested records, driven by the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def joined(values: Column, kind: T.DataType) -> Column:
    """Values of an array of primitives, comma-joined; booleans as True and False."""
    shown = F.transform(values, lambda x: F.when(x, "True").when(~x, "False") if isinstance(kind, T.BooleanType) else x.cast("string"))
    return F.array_join(shown, ", ")


def array_columns(name: str, value: Column, kind: T.ArrayType, sep: str) -> list[Column]:
    """An array as text: primitives joined, or JSON where one is null; objects as JSON and a joined column per field; empty as null."""
    empty = value.isNull() | (F.size(value) == 0)
    if not isinstance(kind.elementType, T.StructType):
        plain = F.to_json(value) if isinstance(kind.elementType, (T.ArrayType, T.MapType)) else F.when(F.exists(value, lambda x: x.isNull()), F.to_json(value)).otherwise(joined(value, kind.elementType))
        return [F.when(~empty, plain).alias(name)]
    out = [F.when(~empty, F.to_json(value)).alias(name)]
    for f in kind.elementType.fields:
        got = F.filter(F.transform(value, _field(f.name)), lambda x: x.isNotNull())
        text = F.to_json(got) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else joined(got, f.dataType)
        out.append(F.when(~empty & (F.size(got) > 0), text).alias(f"{name}{sep}{f.name}"))
    return out


def _field(name: str):
    return lambda x: x[name]


def expanded(name: str, value: Column, kind: T.DataType, sep: str) -> list[Column]:
    if isinstance(kind, T.StructType):
        return [c for f in kind.fields for c in expanded(f"{name}{sep}{f.name}", value[f.name], f.dataType, sep)]
    if isinstance(kind, T.ArrayType):
        return array_columns(name, value, kind, sep)
    return [(F.to_json(value) if isinstance(kind, T.MapType) else value).alias(name)]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """df without nested columns.

    Structs become columns named parent_child at any depth. The first top-level array of structs makes
    one row per element, its fields prefixed by the array's name (an empty or null array keeps its row,
    with nulls); other arrays become text.
    """
    first = next((f for f in df.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)), None)
    if first:
        df = df.withColumn(first.name, F.explode_outer(first.name))
    return df.select(*[c for f in df.schema for c in expanded(f.name, F.col(f"`{f.name}`"), f.dataType, sep)])
