"""Flattening of JSON records that have no schema, by what each record holds.

A field may be a scalar in one record, a list in the next and an object in a third. Records are parsed to VARIANT; the
schemas of all of them are merged by an aggregate, and where records disagree (the merged schema says VARIANT) objects and lists
are looked at apart, in a further pass each. What comes out is the tree of all field names: the only thing
the driver gets. Then every record is taken apart in one projection, without a shuffle, by the kind of each of its values:

* an object gives the columns of its fields, named parent_child, and none under its own name;
* the first list in the record that begins with an object gives a row for each element, whose fields are named list_field;
  the other columns repeat, the list's own stays null, as do the fields of elements that are no objects;
* any other list is text under its own name: scalars joined by `, ` with True and False for booleans; JSON if it holds a list,
  a null or an object; null if it is empty. Objects in it give a column for each field besides, of the values that are not null,
  joined;
* a scalar is text.

All columns are strings. A record that is no JSON object (null, malformed, a name twice) keeps its row, with nulls. Names
that differ in case alone, or come from several places (`a_b`, and b in a), are one column: the first place with a value counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Maker = Callable[[Column], Column]


@dataclass
class Shape:
    """What is found at a place: scalars or lists (text), the fields of objects, the elements of lists."""

    text: bool = False
    fields: dict[str, Shape] = field(default_factory=dict)
    items: Shape | None = None


#: Steps to a place: a field's name, or None for the elements of a list.
Path = tuple[str | None, ...]


def field_path(name: str) -> str:
    for mark in "\"'":
        if mark not in name:
            return f"$[{mark}{name}{mark}]"
    raise ValueError(f"no path leads to the field {name}")


def child(value: Column, name: str) -> Column:
    return F.variant_get(value, field_path(name), "variant")


def elements(value: Column) -> Column:
    return F.when(is_kind(value, "ARRAY"), value).try_cast("array<variant>")


def is_kind(value: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def parsed_schema(text: str) -> T.DataType:
    """A variant's schema as a type; an object is a struct in it."""
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def add(shape: Shape, kind: T.DataType, path: Path, unclear: list[tuple[Path, Shape]]) -> None:
    """Adds a type to a shape; places where records disagree go to unclear."""
    if isinstance(kind, T.VariantType):
        unclear.append((path, shape))
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            add(shape.fields.setdefault(f.name, Shape()), f.dataType, (*path, f.name), unclear)
    else:
        shape.text = True
        if isinstance(kind, T.ArrayType):
            shape.items = shape.items or Shape()
            add(shape.items, kind.elementType, (*path, None), unclear)


def shape_of(records: DataFrame) -> Shape:
    """The tree of names in the column v. A pass over the records, and one for each place where they disagree."""
    root = Shape()
    unclear: list[tuple[Path, Shape]] = [((), root)]
    while unclear:
        path, shape = unclear.pop()
        values = records.select(F.col("v").alias("x"))
        for name in path:
            values = values.select((F.explode(elements(F.col("x"))) if name is None else child(F.col("x"), name)).alias("x"))
        x = F.col("x")
        objects, lists = is_kind(x, "OBJECT"), is_kind(x, "ARRAY")
        found = values.agg(
            F.schema_of_variant_agg(F.when(objects, x)).alias("objects"), F.schema_of_variant_agg(F.when(lists, x)).alias("lists"),
            F.coalesce(F.bool_or(x.isNotNull() & ~objects & ~lists), F.lit(False)).alias("scalars"),
        ).first()
        shape.text |= found["scalars"]
        for schema, begins in ((found["objects"], "OBJECT<"), (found["lists"], "ARRAY<")):
            if (schema or "").startswith(begins):
                add(shape, parsed_schema(schema), path, unclear)
    return root


def spelled(value: Column) -> Column:
    """A scalar in a joined list."""
    return F.when(is_kind(value, "BOOLEAN"), F.initcap(value.try_cast("string"))).otherwise(value.try_cast("string"))


def shown(value: Column) -> Column:
    """A scalar or list as the text of its column; null for an object."""
    of = elements(value)
    plain = F.forall(of, lambda e: ~(is_kind(e, "OBJECT") | is_kind(e, "ARRAY") | is_kind(e, "VOID")))
    as_list = F.when(F.size(of) > 0, F.when(plain, F.array_join(F.transform(of, spelled), ", ")).otherwise(F.to_json(value)))
    return F.when(is_kind(value, "ARRAY"), as_list).when(~is_kind(value, "OBJECT") & ~is_kind(value, "VOID"), value.try_cast("string"))


def columns(shape: Shape, name: str, sep: str) -> list[tuple[str, Maker]]:
    """The columns that the fields of an object give, and how they come from it."""
    return [c for key, below in shape.fields.items() for c in place(below, f"{name}{sep}{key}" if name else key, lambda v, key=key: child(v, key), sep)]


def place(shape: Shape, name: str, get: Maker, sep: str) -> list[tuple[str, Maker]]:
    """The columns of one field."""
    out: list[tuple[str, Maker]] = [(name, lambda v: shown(get(v)))] if shape.text else []
    if shape.items:
        out += [(n, lambda v, of=of: joined(elements(get(v)), of)) for n, of in columns(shape.items, name, sep)]
    return out + [(n, lambda v, of=of: of(get(v))) for n, of in columns(shape, name, sep)]


def joined(values: Column, of: Maker) -> Column:
    """What the objects of a list have in one field, joined; null where none has it."""
    found = F.filter(F.transform(values, lambda e: F.when(is_kind(e, "OBJECT"), of(e))), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def flatten_records(df: DataFrame, column: str, keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """The columns named by keep, and those of the JSON records in `column`."""
    records = df.select(*keep, F.col(column).cast("string").alias("__j")).select(*keep, "__j", F.try_parse_json("__j").alias("v"))
    root = shape_of(records)
    lists = [n for n, s in root.fields.items() if s.items and s.items.fields]
    v, item, chosen = F.col("v"), F.col("__item"), F.col("__chosen")
    if lists:
        begins = F.create_map(*[x for n in lists for x in (F.lit(n), is_kind(F.variant_get("v", field_path(n) + "[0]", "variant"), "OBJECT"))])
        first = F.get(F.filter(F.json_object_keys("__j"), lambda k: F.coalesce(begins[k], F.lit(False))), 0)
        records = records.withColumn("__chosen", first)
        of = F.coalesce(*[F.when(chosen == n, elements(child(v, n))) for n in lists])
        records = records.select(*keep, "v", "__chosen", F.explode_outer(of).alias("__item"))
    out: dict[str, list[Column]] = {}
    names: dict[str, str] = {}

    def put(name: str, value: Column) -> None:
        names.setdefault(name.lower(), name)
        out.setdefault(name.lower(), []).append(value)

    for key, shape in root.fields.items():
        for name, of in place(shape, key, lambda x, key=key: child(x, key), sep):
            put(name, F.when(~chosen.eqNullSafe(key), of(v)) if key in lists else of(v))
        if key in lists:
            for name, of in columns(shape.items, key, sep):
                put(name, F.when(chosen.eqNullSafe(key), of(item)))
    return records.select(*keep, *[F.coalesce(*values).alias(names[n]) for n, values in out.items()])
