"""Lookup keys: schema-driven flattening of scalar and nested key columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Key = tuple[str, Column, T.DataType]

ARGS_TYPE = "array<struct<name:string,value:string>>"


def resolve_keys(df: DataFrame, keys: Mapping[str, str | Column] | Sequence[str]) -> list[Key]:
    """Lookup-column name -> probe column, with types read from the plan (no job runs)."""
    named = keys.items() if isinstance(keys, Mapping) else [(k, k) for k in keys]
    pairs = [(name, F.col(c) if isinstance(c, str) else c) for name, c in named]
    schema = df.select(*[c.alias(f"k{i}") for i, (_, c) in enumerate(pairs)]).schema
    return [(name, c, f.dataType) for (name, c), f in zip(pairs, schema.fields, strict=True)]


def leaves(name: str, value: Column, dtype: T.DataType) -> list[Key]:
    """The leaf fields of a key in order, under their own (unqualified) names."""
    if not isinstance(dtype, T.StructType):
        return [(name, value, dtype)]
    found: list[Key] = []
    for f in dtype.fields:
        found += leaves(f.name, value[f.name], f.dataType)
    return found


def key_text(value: Column, dtype: T.DataType, date_keys: str = "iso") -> Column:
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("string") if date_keys == "epoch" else value.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if date_keys == "epoch":
            return F.unix_millis(value.cast("timestamp")).cast("string")
        return F.replace(value.cast("string"), F.lit(" "), F.lit("T"))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def key_leaves(keys: Sequence[Key], date_keys: str = "iso") -> list[tuple[str, Column, bool]]:
    """(name, text, needs_encoding) of every leaf key; the text is null where the key is."""
    flat = [leaf for key in keys for leaf in leaves(*key)]
    return [
        (name, key_text(value, dtype, date_keys), not isinstance(dtype, _SAFE_TEXT)) for name, value, dtype in flat
    ]


# Types whose text holds only characters that form encoding leaves alone.
_SAFE_TEXT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType)


def lookup_args(keys: Sequence[Key], date_keys: str = "iso") -> Column:
    """All non-null leaf keys as ``array<struct<name, value>>``."""
    pairs = [
        F.struct(F.lit(name).alias("name"), text.alias("value")) for name, text, _ in key_leaves(keys, date_keys)
    ]
    if not pairs:
        return F.expr(f"cast(array() as {ARGS_TYPE})")
    return F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())
