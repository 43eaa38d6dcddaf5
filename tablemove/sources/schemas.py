"""Schemas as objects: describing, deriving and creating them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.functions.names import literal, require, schema_sql
from tablemove.operators.locations import resolve

# Fixed value: wording of the generated schema comment.
_COMMENT = "Migrated from {source} within the same location."


def describe_schema(
    spark: SparkSession, catalog: str, schema: str, mounts: DataFrame | None = None
) -> DataFrame:
    """One row ``database, location, external_location``.

    ``external_location`` is the location with its mount replaced by the mount's
    source; NULL for a schema on platform-local storage.
    """
    require(catalog=catalog, schema=schema)
    described = spark.sql(f"DESCRIBE SCHEMA {schema_sql(spark, catalog, schema)}")
    key, value = (F.col(c) for c in described.columns[:2])
    row = described.agg(
        F.max(F.when(key == "Location", value)).alias("location"),
    ).select(
        F.lit(catalog).alias("catalog"),
        F.lit(schema).alias("database"),
        "location",
        F.lit("schema").alias("object_type"),
    )
    resolved = resolve(row, mounts) if mounts is not None else row.withColumn(
        "external_location", F.col("location")
    )
    return resolved.select("catalog", "database", "location", "external_location")


def derive_schemas(sources: DataFrame, target_catalog: str) -> DataFrame:
    """Target schema per source schema: same name, own folder, generated comment.

    ``sources`` has ``catalog, database, external_location``. A NULL location means
    the target's default location.
    """
    folder = F.regexp_replace("external_location", "/+$", "")
    before, after = _COMMENT.split("{source}")
    return sources.select(
        F.lit(target_catalog).alias("target_catalog"),
        F.col("database").alias("target_schema"),
        F.when(
            folder.isNotNull() & (folder != ""), F.concat_ws("/", folder, F.col("database"))
        ).alias("target_location"),
        F.concat(
            F.lit(before), F.col("catalog"), F.lit("."), F.col("database"), F.lit(after)
        ).alias("target_comment"),
    )


def ensure_schema(
    spark: SparkSession, catalog: str, schema: str, location: str | None = None, comment: str = ""
) -> None:
    """Create the schema unless it exists."""
    require(catalog=catalog, schema=schema)
    statement = f"CREATE SCHEMA IF NOT EXISTS {schema_sql(spark, catalog, schema)}"
    if comment:
        statement += f" COMMENT {literal(comment)}"
    if location:
        statement += f" LOCATION {literal(location)}"
    spark.sql(statement)
