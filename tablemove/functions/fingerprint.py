"""Order-insensitive, duplicate-sensitive content fingerprints.

One scan with partial aggregation and no shuffle of rows. Columns are taken by
name, so a table whose partition columns moved last has the same fingerprint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "n_rows"
_CHUNKS = 4
_CHUNK_BITS = 16
_FLAGS_PER_WORD = 62
FINGERPRINT_COLUMNS = [ROWS, *[f"fp{i}" for i in range(_CHUNKS)]]


def _canonical(value: Column, data_type: T.DataType) -> Column:
    """A value without maps: entries sorted by key, at every level."""
    if isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _canonical(e["key"], data_type.keyType).alias("key"),
                _canonical(e["value"], data_type.valueType).alias("value"),
            ),
        )
        return F.sort_array(entries)
    if isinstance(data_type, T.ArrayType) and has_map(data_type):
        return F.transform(value, lambda e: _canonical(e, data_type.elementType))
    if isinstance(data_type, T.StructType) and has_map(data_type):
        fields = [_canonical(value[f.name], f.dataType).alias(f.name) for f in data_type]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def has_map(data_type: T.DataType) -> bool:
    """True when the type is a map or contains one; maps cannot be hashed or grouped."""
    if isinstance(data_type, T.ArrayType):
        return has_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(has_map(f.dataType) for f in data_type)
    return isinstance(data_type, T.MapType)


def comparable(field: T.StructField) -> Column:
    """The column in a form that can be grouped by, and equal only where it is the same."""
    column = F.col(_ref(field.name))
    if isinstance(field.dataType, T.StringType) and field.dataType.simpleString() != "string":
        return column.cast("binary")  # a collation may call different texts equal
    if isinstance(field.dataType, T.VariantType):
        return F.struct(*_plain(column, field.dataType))
    return _canonical(column, field.dataType)


def _ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value_hash(value: Column, data_type: T.DataType) -> Column:
    """64-bit hash of a value of any type; NULLs and sizes count at every level.

    Spark's own hash skips NULLs and array bounds, and cannot take maps.
    """
    if isinstance(data_type, T.ArrayType):
        elements = F.transform(value, lambda e: _value_hash(e, data_type.elementType))
        return F.xxhash64(F.size(value), value.isNull(), elements)
    if isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(_value_hash(e["key"], data_type.keyType), _value_hash(e["value"], data_type.valueType)),
        )
        return F.xxhash64(F.size(value), value.isNull(), F.sort_array(entries))
    if isinstance(data_type, T.StructType):
        return F.xxhash64(value.isNull(), *[_value_hash(value[f.name], f.dataType) for f in data_type])
    return F.xxhash64(value.isNull(), *_plain(value, data_type))


def _plain(value: Column, data_type: T.DataType) -> list[Column]:
    """A value that is no array, map or struct, in columns that Spark can hash."""
    if isinstance(data_type, T.VariantType):
        # The text of a variant does not tell its types.
        return [F.schema_of_variant(value), F.to_json(value)]
    if isinstance(data_type, T.StringType) and data_type.simpleString() != "string":
        return [value.cast("binary")]
    return [value]


def _hash_inputs(field: T.StructField) -> list[Column]:
    column, data_type = F.col(_ref(field.name)), field.dataType
    if isinstance(data_type, T.ArrayType) and not data_type.containsNull and _is_plain(data_type.elementType):
        return [F.size(column), column]
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return [_value_hash(column, data_type)]
    return _plain(column, data_type)


def _is_plain(data_type: T.DataType) -> bool:
    nested = isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    return not nested and (not isinstance(data_type, T.StringType) or data_type.simpleString() == "string")


def row_hash(schema: T.StructType) -> Column:
    """64-bit hash of a row; NULLs count, and differ by position."""
    fields = sorted(schema.fields, key=lambda f: f.name.lower())
    inputs = [column for field in fields for column in _hash_inputs(field)]
    words = [fields[i:i + _FLAGS_PER_WORD] for i in range(0, len(fields), _FLAGS_PER_WORD)]
    for word in words:
        bits = [
            F.when(F.col(_ref(field.name)).isNull(), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
            for bit, field in enumerate(word)
        ]
        inputs.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
    return F.xxhash64(*inputs)


def fingerprint(hash_column: Column) -> list[Column]:
    """Aggregates that make up the fingerprint of a set of rows.

    The hash is summed in 16-bit chunks: every sum stays a primitive long and
    cannot overflow below 10^14 rows.
    """
    mask = F.lit((1 << _CHUNK_BITS) - 1).cast("bigint")
    sums = [
        F.coalesce(
            F.sum(F.shiftrightunsigned(hash_column, _CHUNK_BITS * i).bitwiseAND(mask)), F.lit(0)
        ).cast("bigint").alias(f"fp{i}")
        for i in range(_CHUNKS)
    ]
    return [F.count(F.lit(1)).alias(ROWS), *sums]
