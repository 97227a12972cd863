"""Metadata as a lossless JSON string and as a flat map of strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glimmerdex.decisions import RESERVED_META_NAMES, UNFLATTENED_KEYS

SCALARS = (T.StringType, T.NumericType, T.BooleanType)


def sanitize_key(col: Column) -> Column:
    """Lower-case; runs outside [a-z0-9_] become one underscore; outer ones go."""
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9_]+", "_"), F.lit("_"))


def sanitize_name(name: str) -> str:
    """The same rule for a key known when the plan is built."""
    return re.sub("[^a-z0-9_]+", "_", name.lower()).strip("_")


def flatten_columns(fields: list[T.StructField]) -> Column:
    """Typed metadata columns to map<string,string>.

    Names are known here, so clashes are settled while building the plan: of
    the columns sharing a sanitized name the last non-null one wins.
    """
    by_name: dict[str, list[str]] = {}
    for field in fields:
        name = sanitize_name(field.name)
        if field.name in UNFLATTENED_KEYS or name in RESERVED_META_NAMES:
            continue
        if isinstance(field.dataType, SCALARS):
            by_name.setdefault(name, []).append(field.name)
    if not by_name:
        return F.expr("cast(map() as map<string,string>)")
    entries = [
        F.struct(
            F.lit(name).alias("key"),
            F.coalesce(*[F.col(f"`{c}`").cast("string") for c in reversed(columns)]).alias("value"),
        )
        for name, columns in by_name.items()
    ]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def json_types(json: Column) -> Column:
    """map<key, type name> of the top level of a JSON object."""
    typed = F.from_json(json, "map<string,variant>")
    return F.transform_values(typed, lambda _, v: F.schema_of_variant(v))


def is_scalar_type(kind: Column) -> Column:
    return ~(kind.startswith("OBJECT") | kind.startswith("ARRAY") | (kind == "VOID"))


def flatten_json(json: Column) -> Column:
    """JSON metadata to map<string,string>: scalars only, the last of clashing keys wins."""
    values = F.from_json(json, "map<string,string>")
    kinds = F.map_values(json_types(json))
    entries = F.arrays_zip(
        F.map_keys(values).alias("key"), F.map_values(values).alias("value"), kinds.alias("kind")
    )
    kept = F.filter(
        entries, lambda e: is_scalar_type(e["kind"]) & ~e["key"].isin(*UNFLATTENED_KEYS)
    )
    named = F.transform(
        kept, lambda e: F.struct(sanitize_key(e["key"]).alias("key"), e["value"].alias("value"))
    )
    named = F.filter(named, lambda e: ~e["key"].isin(*RESERVED_META_NAMES))
    flat = F.aggregate(
        named,
        F.expr("cast(map() as map<string,string>)"),
        lambda m, e: F.map_concat(
            F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])
        ),
    )
    return F.coalesce(flat, F.expr("cast(map() as map<string,string>)"))


def json_field(json: Column, key: str) -> Column:
    """Text of a top-level field, null where the value counts as empty.

    Empty are: missing, null, '', false, the number zero, an empty list or object.
    """
    value = F.from_json(json, "map<string,string>")[key]
    kind = json_types(json)[key]
    is_text = kind == "STRING"
    empty = (
        value.isNull()
        | (kind == "VOID")
        | (is_text & (value == ""))
        | (~is_text & value.isin("false", "[]", "{}"))
        | (~is_text & (F.coalesce(value.try_cast("double"), F.lit(1.0)) == 0))
    )
    return F.when(~empty, value)


def column_field(fields: list[T.StructField], key: str) -> Column:
    """The same for a typed column, null when the column does not exist."""
    field = next((f for f in fields if f.name == key), None)
    if field is None:
        return F.lit(None).cast("string")
    col = F.col(f"`{key}`")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(col, col.cast("string"))
    if isinstance(field.dataType, T.NumericType):
        return F.when(col != 0, col.cast("string"))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return F.nullif(col.cast("string"), F.lit(""))
