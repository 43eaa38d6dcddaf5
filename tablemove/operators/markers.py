"""Provenance markers: which object went where, by whom, when and how."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.functions.names import ObjectName, literal, require, table_sql

# Property prefix per operation, and the keys of the two filters.
PREFIXES = {"ctas": "upgraded", "clone": "cloned", "convert": "converted", "sync": "synced"}
FILTER_KEYS = {"upgraded": "upgraded_to", "roll_backed": "roll_backed_from"}
# Every property that a move writes on its source, by its exact key.
KEYS = frozenset(f"{p}_{part}" for p in PREFIXES.values() for part in ("to", "by", "at", "type")) | {
    FILTER_KEYS["roll_backed"]
}


def stamp(spark: SparkSession) -> tuple[str, datetime]:
    """Current user and time, asked once per batch."""
    return tuple(spark.sql("SELECT current_user(), current_timestamp()").first())


def mark(
    spark: SparkSession,
    name: str | ObjectName,
    operation: str,
    target: str,
    how: str,
    style: str = "properties",
    by_at: tuple[str, datetime] | None = None,
) -> None:
    """Write the marker of ``operation`` on an object.

    ``style`` is ``'properties'`` (``<prefix>_to, _by, _at, _type``) or ``'comment'``.
    """
    user, at = by_at or stamp(spark)
    prefix = PREFIXES[operation]
    if style == "comment":
        text = f"{prefix.capitalize()} to {target} by {user} at {at} via {how}."
        spark.sql(f"COMMENT ON TABLE {table_sql(spark, name)} IS {literal(text)}")
        return
    if style != "properties":
        raise ValueError(f"unknown marker style {style!r}")
    set_properties(
        spark,
        name,
        {f"{prefix}_to": target, f"{prefix}_by": user, f"{prefix}_at": str(at), f"{prefix}_type": how},
    )


def mark_rolled_back(spark: SparkSession, name: str | ObjectName, origin: str) -> None:
    """Write the marker of an object restored from ``origin``."""
    set_properties(spark, name, {FILTER_KEYS["roll_backed"]: origin})


def set_properties(spark: SparkSession, name: str | ObjectName, properties: dict[str, str]) -> None:
    if properties:
        spark.sql(f"ALTER TABLE {table_sql(spark, name)} SET TBLPROPERTIES ({pairs_sql(properties)})")


def pairs_sql(pairs: dict[str, str]) -> str:
    """``'k' = 'v', ...`` for OPTIONS and TBLPROPERTIES."""
    return ", ".join(f"{literal(k)} = {literal(v)}" for k, v in pairs.items())


def has_marker(properties: Column, kind: str) -> Column:
    """True when the property map carries the marker ``'upgraded'`` or ``'roll_backed'``."""
    require(kind=kind)
    if kind not in FILTER_KEYS:
        raise ValueError(f"kind must be one of {', '.join(FILTER_KEYS)}")
    return F.coalesce(F.map_contains_key(properties, FILTER_KEYS[kind]), F.lit(False))


def filter_marked(inventory: DataFrame, kind: str) -> DataFrame:
    """Rows of an inventory that carry the marker."""
    return inventory.filter(has_marker(F.col("properties"), kind))
