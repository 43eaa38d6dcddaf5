"""Table formats: what the session can read, and what a format can hold."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Serde classes by which a catalog of provider "hive" names its format.
HIVE_SERDES = {
    "org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe": "parquet",
    "org.apache.hadoop.hive.serde2.avro.AvroSerDe": "avro",
}

_BUILT_IN = ("parquet", "orc", "json", "csv")
_NEEDS_JAR = ("delta", "avro")
_NO_SUCH_SOURCE = ("DATA_SOURCE_NOT_FOUND", "Failed to find data source")

# Options under which a text format gives every value back unchanged: NULL differs from
# the empty text, and blanks, quotes and line breaks are kept.
LOSSLESS_OPTIONS = {
    "csv": {
        "multiLine": "true",
        "lineSep": "\n",
        "quoteAll": "true",
        "escape": '"',
        "nullValue": "\\N",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    },
    "json": {
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    },
}

#: Options by which a text format takes a fraction of the space. Such a file is read by one task, so it ends after
#: so many rows.
COMPACT_OPTIONS = {fmt: {"compression": "gzip", "maxRecordsPerFile": "2000000"} for fmt in ("csv", "json")}


def is_available(spark: SparkSession, fmt: str) -> bool:
    """True when the session has a data source of that name."""
    fmt = fmt.lower()
    if fmt in _BUILT_IN:
        return True
    try:
        spark.read.format(fmt).schema("a INT").load("/nonexistent-path-for-format-lookup")
    except Exception as error:  # without a jar the JVM reports a missing class
        return not any(text in str(error) for text in _NO_SUCH_SOURCE)
    return True


def available(spark: SparkSession) -> list[str]:
    """Formats usable in this session; those of optional jars come last."""
    return [*_BUILT_IN, *[f for f in _NEEDS_JAR if is_available(spark, f)]]


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def unsupported_columns(fmt: str, schema: T.StructType) -> list[str]:
    """Columns a format cannot hold."""
    if fmt.lower() != "csv":
        return []
    return [f.name for f in schema if _is_nested(f.dataType)]


def check_writable(spark: SparkSession, fmt: str, schema: T.StructType) -> None:
    """Raise before any data moves if the format cannot take the schema."""
    if not is_available(spark, fmt):
        raise ValueError(f"format {fmt} is not available in this session")
    rejected = unsupported_columns(fmt, schema)
    if rejected:
        raise ValueError(f"format {fmt} cannot hold columns {', '.join(rejected)}")


def lossless_options(fmt: str, schema: T.StructType) -> dict[str, str]:
    """Options for a new table of a text format.

    Files whose values may hold line breaks cannot be split by a reader, so tables
    without texts keep to single lines.
    """
    options = dict(LOSSLESS_OPTIONS.get(fmt.lower(), {}))
    if not any(isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)) for f in schema):
        options.pop("multiLine", None)
    return options


def effective_format_column(provider: Column, serde: Column) -> Column:
    """Lower-case format of a table; NULL for a serde that is not supported."""
    serdes = F.create_map(*[F.lit(v) for pair in HIVE_SERDES.items() for v in pair])
    lowered = F.lower(F.trim(provider))
    return F.when(lowered == "hive", F.try_element_at(serdes, serde)).otherwise(lowered)


def effective_format(provider: str | None, serde: str | None) -> str:
    """Driver-side form of :func:`effective_format_column` for one table."""
    if not provider:
        raise ValueError("the table has no provider")
    if provider.lower() != "hive":
        return provider.lower()
    if serde not in HIVE_SERDES:
        raise NotImplementedError(f"hive tables with serde {serde!r} are not supported")
    return HIVE_SERDES[serde]
