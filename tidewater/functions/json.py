"""SQL/JSON functions over string columns, through Spark's variant type."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENIENT = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "mode": "PERMISSIVE"}


def _variant(s: Column) -> Column:
    return F.try_parse_json(s)


def is_json_value(s: Column) -> Column:
    return F.when(s.isNotNull(), _variant(s).isNotNull())


def _shape(s: Column, prefix: str) -> Column:
    shape = F.schema_of_variant(_variant(s))
    return F.when(s.isNotNull(), F.coalesce(shape.startswith(prefix), F.lit(False)))


def is_json_object(s: Column) -> Column:
    return _shape(s, "OBJECT<")


def is_json_array(s: Column) -> Column:
    return _shape(s, "ARRAY<")


def is_json_scalar(s: Column) -> Column:
    return is_json_value(s) & ~is_json_object(s) & ~is_json_array(s)


def json_exists(s: Column, path: str) -> Column:
    return F.when(
        s.isNotNull(), F.try_variant_get(_variant(s), path, "variant").isNotNull()
    )


def json_value(
    s: Column, path: str, returning: str = "string", on_empty: Column | None = None,
    on_error: Column | None = None, raise_on_error: bool = False,
) -> Column:
    """Scalar at ``path``; objects and arrays are errors, missing paths are empty."""
    v = F.try_variant_get(_variant(s), path, "variant")
    shape = F.schema_of_variant(v)
    nested = shape.startswith("OBJECT<") | shape.startswith("ARRAY<")
    got = F.try_variant_get(v, "$", returning)
    bad = nested | (got.isNull() & (shape != "VOID"))
    null = F.lit(None).cast(returning)
    failed = F.raise_error(F.lit(f"JSON_VALUE: no scalar at {path}")).cast(returning) \
        if raise_on_error else (on_error if on_error is not None else null)
    return (
        F.when(s.isNull(), null)
        .when(_variant(s).isNull(), failed)
        .when(v.isNull(), on_empty if on_empty is not None else null)
        .when(bad, failed)
        .otherwise(got)
    )


def json_query(s: Column, path: str, wrapper: str = "without") -> Column:
    """Object or array at ``path`` as JSON text.

    ``wrapper``: ``without``, ``conditional`` (wrap scalars) or ``unconditional``.
    """
    v = F.try_variant_get(_variant(s), path, "variant")
    text = F.to_json(v)
    shape = F.schema_of_variant(v)
    nested = shape.startswith("OBJECT<") | shape.startswith("ARRAY<")
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    if wrapper == "unconditional":
        return wrapped
    if wrapper == "conditional":
        return F.when(nested, text).otherwise(wrapped)
    if wrapper == "without":
        return F.when(nested, text)
    raise ValueError(f"unknown wrapper {wrapper}")


def json_object(fields: dict[str, Column], absent_on_null: bool = False) -> Column:
    packed = F.struct(*[c.alias(k) for k, c in fields.items()])
    return F.to_json(packed, {"ignoreNullFields": str(absent_on_null).lower()})


def json_array(items: list[Column], absent_on_null: bool = True) -> Column:
    arr = F.array(*items)
    if absent_on_null:
        arr = F.filter(arr, lambda x: x.isNotNull())
    return F.to_json(arr, {"ignoreNullFields": "false"})


def json_type(s: Column) -> Column:
    shape = F.schema_of_variant(_variant(s))
    return (
        F.when(shape.startswith("OBJECT<"), F.lit("OBJECT"))
        .when(shape.startswith("ARRAY<"), F.lit("ARRAY"))
        .when(shape == "BIGINT", F.lit("INTEGER"))
        .when(shape.startswith("DECIMAL") | (shape == "DOUBLE"), F.lit("DOUBLE"))
        .when(shape == "VOID", F.lit("NULL"))
        .otherwise(shape)
    )


def json_depth(s: Column) -> Column:
    """Nesting levels of values: a scalar or an empty container counts 1."""
    no_strings = F.regexp_replace(s, r'"(?:[^"\\]|\\.)*"', "s")
    leaves = F.regexp_replace(F.regexp_replace(no_strings, r"\s+", ""), r"\{\}|\[\]", "s")
    step = lambda acc, ch: F.struct(
        (acc.open + F.when(ch.isin("{", "["), 1).when(ch.isin("}", "]"), -1).otherwise(0)).alias("open"),
        F.greatest(acc.top, acc.open + F.when(ch.isin("{", "["), 1).otherwise(0)).alias("top"),
    )
    zero = F.struct(F.lit(0).alias("open"), F.lit(0).alias("top"))
    depth = F.aggregate(F.split(leaves, ""), zero, step, lambda acc: acc.top + 1)
    return F.when(is_json_value(s), depth)


@F.pandas_udf(T.StringType())
def _indented(texts: pd.Series) -> pd.Series:
    import json

    return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), indent=2, ensure_ascii=False))


def json_pretty(s: Column) -> Column:
    """Indented text; the built-in writer indents structs only."""
    return _indented(F.to_json(_variant(s)))


def from_lenient(s: Column, schema: T.StructType) -> Column:
    """Rows from loose JSON: single quotes and bare names pass, unknown fields
    are ignored, broken text gives NULL, a NULL string field becomes ``''``."""
    row = F.from_json(s, _with_trap(schema), {**LENIENT, "columnNameOfCorruptRecord": "_broken"})
    fields = [
        (F.coalesce(row[f.name], F.lit("")) if isinstance(f.dataType, T.StringType) else row[f.name]).alias(f.name)
        for f in schema.fields
    ]
    return F.when(s.isNotNull() & row["_broken"].isNull(), F.struct(*fields))


def _with_trap(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("_broken", T.StringType())])


def to_compact(row: Column) -> Column:
    """JSON text without empty fields."""
    return F.to_json(row, {"ignoreNullFields": "true"})


def partial_update(row: Column, s: Column, schema: T.StructType) -> Column:
    """``row`` with the fields that are present in the JSON text replaced."""
    new = F.from_json(s, schema, LENIENT)
    present = F.from_json(s, "map<string,string>", LENIENT)
    return F.struct(
        *[
            F.when(F.coalesce(F.map_contains_key(present, f.name), F.lit(False)), new[f.name])
            .otherwise(row[f.name]).alias(f.name)
            for f in schema.fields
        ]
    )


def jsonp(callback: str, row: Column) -> Column:
    return F.concat(F.lit(callback + "("), to_compact(row), F.lit(")"))
