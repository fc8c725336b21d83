"""Row encoders and response decoders, looked up by format name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_restframe_corrupt"

Fields = list[tuple[str, Column, T.DataType]]


# ---------------------------------------------------------------- JSON out


def _has_timestamp(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has_timestamp(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_timestamp(dtype.elementType)
    return isinstance(dtype, T.MapType) and _has_timestamp(dtype.valueType)


def _json_ready(value: Column, dtype: T.DataType) -> Column:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` text at any depth, the rest untouched."""
    if not _has_timestamp(dtype):
        return value
    if isinstance(dtype, T.StructType):
        fields = [_json_ready(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: _json_ready(v, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, v: _json_ready(v, dtype.valueType))
    return value.cast("string")


def encode_json(fields: Fields, options: Mapping[str, str] | None = None) -> Column:
    """One JSON object per row, null fields kept."""
    if not fields:
        return F.lit("{}")
    ready = [_json_ready(value, dtype).alias(name) for name, value, dtype in fields]
    keep = "true" if (options or {}).get("encode.ignore-null-fields") == "true" else "false"
    return F.to_json(F.struct(*ready), {"ignoreNullFields": keep})


def encode_raw(fields: Fields, options: Mapping[str, str] | None = None) -> Column:
    if len(fields) != 1:
        raise ValueError("the raw format takes exactly one column")
    return fields[0][1].cast("string")


def encode_csv(fields: Fields, options: Mapping[str, str] | None = None) -> Column:
    ready = [_json_ready(value, dtype).alias(name) for name, value, dtype in fields]
    return F.to_csv(F.struct(*ready), dict(options or {}))


# ---------------------------------------------------------------- JSON in

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wire_type(dtype: T.DataType) -> T.DataType:
    """The type with every leaf read as text, so that one bad leaf spoils nothing else."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, wire_type(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(wire_type(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), wire_type(dtype.valueType))
    return T.StringType()


def _plain(dtype: T.DataType) -> bool:
    """True when the wire value already is the declared value."""
    return wire_type(dtype) == dtype or dtype == T.StringType()


def from_wire(value: Column, dtype: T.DataType) -> Column:
    if _plain(dtype):
        return value
    if isinstance(dtype, T.StructType):
        fields = [from_wire(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: from_wire(v, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, v: from_wire(v, dtype.valueType))
    if isinstance(dtype, T.BooleanType):
        return F.lower(F.trim(value)) == "true"
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(value)
    return F.trim(value).try_cast(dtype)


def _bad(wire: Column, dtype: T.DataType) -> Column | None:
    """True when some leaf is present but not readable as its declared type."""
    if _plain(dtype) or isinstance(dtype, (T.BooleanType, T.BinaryType)):
        return None
    if isinstance(dtype, T.StructType):
        tests = [_bad(wire[f.name], f.dataType) for f in dtype.fields]
        tests = [t for t in tests if t is not None]
        if not tests:
            return None
        total = tests[0]
        for test in tests[1:]:
            total = total | test
        return total
    if isinstance(dtype, T.ArrayType):
        if _bad(F.lit(""), dtype.elementType) is None:
            return None
        return F.coalesce(F.exists(wire, lambda v: _bad(v, dtype.elementType)), F.lit(False))
    if isinstance(dtype, T.MapType):
        if _bad(F.lit(""), dtype.valueType) is None:
            return None
        return F.coalesce(
            F.exists(F.map_values(wire), lambda v: _bad(v, dtype.valueType)), F.lit(False)
        )
    return wire.isNotNull() & from_wire(wire, dtype).isNull()


def wire_json(body: Column, schema: T.StructType) -> Column:
    """One parse of a JSON object into its wire struct plus the corrupt-record field."""
    read = T.StructType([*wire_type(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(body, read, {"columnNameOfCorruptRecord": CORRUPT})


def is_object(body: Column) -> Column:
    return F.json_object_keys(body).isNotNull()


def wire_failed(wire: Column, schema: T.StructType) -> Column:
    """True when the parsed object does not fit the declared schema."""
    structural = wire.isNull() | wire[CORRUPT].isNotNull()
    leaves = _bad(wire, schema)
    return structural if leaves is None else structural | F.coalesce(leaves, F.lit(False))


def decode_wire(wire: Column, schema: T.StructType) -> Column:
    return F.struct(*[from_wire(wire[f.name], f.dataType).alias(f.name) for f in schema.fields])


Encoder = Callable[[Fields, Mapping[str, str]], Column]
Decoder = Callable[[Column, T.StructType, Mapping[str, str]], Column]

# The ids of the formats.
ENCODERS: dict[str, Encoder] = {"json": encode_json, "raw": encode_raw, "csv": encode_csv}


def decode_raw(body: Column, schema: T.StructType, options: Mapping[str, str]) -> Column:
    if len(schema.fields) != 1:
        raise ValueError("the raw format takes exactly one column")
    field = schema.fields[0]
    return F.struct(body.try_cast(field.dataType).alias(field.name))


def decode_csv(body: Column, schema: T.StructType, options: Mapping[str, str]) -> Column:
    return F.from_csv(body, schema.simpleString()[len("struct<") : -1].replace(":", " "), dict(options))


# Decoders other than JSON give a struct, null when the body cannot be decoded.
DECODERS: dict[str, Decoder] = {"raw": decode_raw, "csv": decode_csv}


def register_format(name: str, encoder: Encoder | None = None, decoder: Decoder | None = None) -> None:
    if encoder is not None:
        ENCODERS[name] = encoder
    if decoder is not None:
        DECODERS[name] = decoder


def format_options(options: Mapping[str, str], name: str) -> dict[str, str]:
    """The options given for one format, without the ``<name>.`` prefix."""
    prefix = f"{name}."
    return {k[len(prefix) :]: v for k, v in options.items() if k.startswith(prefix)}
