"""Deciding what to do per object: one join over two inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.sources.formats import effective_format_column
from tablemove.sources.inventory import EXTERNAL, VIEW

CREATE = "CREATE"
RECREATE = "RECREATE"
REPLACE = "REPLACE"
IN_SYNC = "IN_SYNC"
BLOCKED = "BLOCKED"
ORPHAN = "ORPHAN"


def _shape(columns: Column) -> Column:
    """Digest of names and types in order; nullability and comments do not count.

    A digest keeps the shuffled rows short however many columns a table has.
    """
    in_order = F.sort_array(
        F.transform(
            columns, lambda c: F.struct(c["pos"], F.lower(c["name"]).alias("name"), c["type"].alias("type"))
        )
    )
    names_and_types = F.transform(in_order, lambda c: F.struct(c["name"], c["type"]))
    return F.sha2(F.to_json(names_and_types), 256)


def _own(inventory: DataFrame, name: str, kind: str) -> Column:
    """A column of an inventory that may have been left out."""
    return F.col(name) if name in inventory.columns else F.lit(None).cast(kind)


def _place(location: Column) -> Column:
    """A location in one spelling: no trailing slash, ``file:/`` for ``file:///`` and plain paths."""
    plain = F.rtrim(F.regexp_replace(location, "^file:/+", "/"), F.lit("/"))
    return F.when(location.isNull() | (location == ""), F.lit(None)).when(plain == "", "/").otherwise(plain)


def _layout(partition_cols: Column, options: Column) -> Column:
    """Digest of the partitioning and the options; the path is no option here."""
    columns = F.transform(F.coalesce(partition_cols, F.array().cast("array<string>")), F.lower)
    entries = F.map_entries(F.coalesce(options, F.create_map().cast("map<string,string>")))
    entries = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.sha2(F.to_json(F.struct(columns, F.sort_array(F.filter(entries, lambda e: e["key"] != "path")))), 256)


def _side(inventory: DataFrame, prefix: str, place: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return inventory.select(
        F.lower("schema").alias("schema"),
        F.lower("name").alias("name"),
        F.struct(
            F.upper("object_type").alias("object_type"),
            effective_format_column(F.col("provider"), F.col("serde")).alias("fmt"),
            _shape(F.col("columns")).alias("shape"),
            _place(_own(inventory, place, "string")).alias("place"),
            _layout(
                _own(inventory, "partition_cols", "array<string>"), _own(inventory, "options", "map<string,string>")
            ).alias("layout"),
            *([F.struct(*keep).alias("kept")] if keep else []),
        ).alias(prefix),
    )


def classify(source: DataFrame, target: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Action per table of two inventories, matched by schema and name.

    CREATE (no target), IN_SYNC, RECREATE (drifted external target), BLOCKED (drifted
    managed target, a view in its place, a source format that is not supported, or columns that are not
    known), ORPHAN (no source). ``reason`` is MISSING, UNSUPPORTED, VIEW, FORMAT, UNKNOWN, SCHEMA,
    LOCATION or LAYOUT (partitioning or options), the first that holds. The location of a source is
    its ``external_location``, if it has been resolved, else its ``location``; unknown ones are not
    compared. Columns of the source named in ``keep`` are carried along.
    """
    left = _side(source.filter(F.upper("object_type") != VIEW), "s",
                 "external_location" if "external_location" in source.columns else "location", keep)
    joined = left.join(_side(target, "t", "location"), ["schema", "name"], "full_outer")
    has_source, has_target = F.col("s").isNotNull(), F.col("t").isNotNull()
    is_view = F.coalesce(F.col("t.object_type") == VIEW, F.lit(False))
    unsupported = has_source & F.col("s.fmt").isNull()
    reason = (
        F.when(~has_source | (~has_target & ~unsupported), "MISSING")
        .when(unsupported, "UNSUPPORTED")
        .when(is_view, "VIEW")
        .when(~F.col("s.fmt").eqNullSafe(F.col("t.fmt")), "FORMAT")
        .when(F.col("s.shape").isNull() | F.col("t.shape").isNull(), "UNKNOWN")
        .when(~F.col("s.shape").eqNullSafe(F.col("t.shape")), "SCHEMA")
        .when(F.col("s.place") != F.col("t.place"), "LOCATION")
        .when(F.col("s.layout") != F.col("t.layout"), "LAYOUT")
    )
    decided = joined.filter(has_source | ~is_view).select(
        "schema",
        "name",
        F.col("s.fmt").alias("source_format"),
        F.col("t.fmt").alias("target_format"),
        reason.alias("reason"),
        (F.col("t.object_type") == EXTERNAL).alias("__external"),
        has_source.alias("__has_source"),
        *[F.col(f"s.kept.{k}").alias(k) for k in keep],
    )
    return decided.select(
        "schema",
        "name",
        "source_format",
        "target_format",
        F.when(~F.col("__has_source"), ORPHAN)
        .when(F.col("reason").isNull(), IN_SYNC)
        .when(F.col("reason") == "MISSING", CREATE)
        .when(F.col("reason").isin("UNSUPPORTED", "UNKNOWN", "VIEW"), BLOCKED)
        .when(F.col("__external"), RECREATE)
        .otherwise(BLOCKED)
        .alias("action"),
        "reason",
        *keep,
    )
