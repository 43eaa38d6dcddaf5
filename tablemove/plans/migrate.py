"""Batch entry points: whole schemas copied, cloned, converted or synced."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.functions.names import ObjectName, require, schema_sql, split_names, target_of
from tablemove.operators import convert, copy, external, markers, views
from tablemove.operators.drift import ORPHAN, classify
from tablemove.operators.outcome import Outcome
from tablemove.plans.report import run_batch
from tablemove.sources.inventory import INVENTORY, filter_kind, inventory, list_objects
from tablemove.sources.schemas import derive_schemas, describe_schema, ensure_schema


def _sources(
    spark: SparkSession, catalog: str, schemas: str | list[str], tables: str | list[str] | None
) -> Iterator[ObjectName]:
    """Tables (not views) to work on; no names means all tables of the schemas."""
    wanted = split_names(tables)
    missing = {name.lower() for name in wanted}
    for schema in split_names(schemas):
        for row in list_objects(spark, catalog, schema, wanted, "table").orderBy("name").toLocalIterator():
            missing.discard(row["name"].lower())
            yield ObjectName(catalog, schema, row["name"])
    if missing:
        raise ValueError(f"not found in {catalog}: {', '.join(sorted(missing))}")


def _check_single(source: list[str], **single_only) -> None:
    """A target name or location makes sense for one source table only."""
    given = [name for name, value in single_only.items() if value]
    if given and len(source) != 1:
        raise ValueError(f"{', '.join(given)} applies to a single source table")


def copy_schema(
    spark: SparkSession,
    source_catalog: str,
    source_schema: str,
    target_catalog: str,
    target_schema: str = "",
    tables: str | list[str] | None = None,
    target_table: str = "",
    location: str = "",
    create_schema: bool = False,
    schema_comment: str = "",
    schema_location: str = "",
    on_error: str = "stop",
    report_table: str | None = None,
    **clauses,
) -> list[Outcome]:
    """CTAS copies of tables; ``clauses`` go to :func:`operators.copy.ctas`."""
    require(source_schema=source_schema, target_catalog=target_catalog)
    _check_single(split_names(tables), target_table=target_table, location=location)
    if create_schema:
        ensure_schema(spark, target_catalog, target_schema or source_schema, schema_location, schema_comment)
    by_at = markers.stamp(spark)
    steps = (
        lambda s=s: copy.ctas(
            spark,
            s,
            target_of(s, target_catalog, target_schema, target_table),
            location=location or None,
            by_at=by_at,
            **clauses,
        )
        for s in _sources(spark, source_catalog, source_schema, tables)
    )
    return run_batch(spark, steps, on_error, report_table=report_table)


def clone_schema(
    spark: SparkSession,
    source_catalog: str,
    source_schema: str,
    target_catalog: str,
    target_schema: str = "",
    tables: str | list[str] | None = None,
    target_table: str = "",
    location: str = "",
    create_schema: bool = False,
    schema_comment: str = "",
    schema_location: str = "",
    on_error: str = "stop",
    report_table: str | None = None,
    level: str = "fingerprint",
    marker: str = "properties",
) -> list[Outcome]:
    """Clones of tables, managed or (one table with a location) external."""
    require(source_schema=source_schema, target_catalog=target_catalog)
    _check_single(split_names(tables), target_table=target_table, location=location)
    if create_schema:
        ensure_schema(spark, target_catalog, target_schema or source_schema, schema_location, schema_comment)
    by_at = markers.stamp(spark)
    steps = (
        lambda s=s: copy.clone(
            spark,
            s,
            target_of(s, target_catalog, target_schema, target_table),
            location=location or None,
            level=level,
            marker=marker,
            by_at=by_at,
        )
        for s in _sources(spark, source_catalog, source_schema, tables)
    )
    return run_batch(spark, steps, on_error, report_table=report_table)


def convert_schema(
    spark: SparkSession,
    catalog: str,
    schema: str,
    to: str = "delta",
    tables: str | list[str] | None = None,
    analyze: bool = False,
    on_error: str = "stop",
    report_table: str | None = None,
    level: str = "fingerprint",
    marker: str = "properties",
) -> list[Outcome]:
    """In-place format conversion of tables."""
    require(schema=schema)
    by_at = markers.stamp(spark)
    steps = (
        lambda s=s: convert.convert_format(spark, s, to, analyze, level, marker, by_at)
        for s in _sources(spark, catalog, schema, tables)
    )
    return run_batch(spark, steps, on_error, report_table=report_table)


def _derive_targets(
    spark: SparkSession,
    source_catalog: str,
    source_schemas: list[str],
    target_catalog: str,
    target_schema: str,
    mounts: DataFrame | None,
    schema_location: str,
    schema_comment: str,
) -> None:
    """Create target schemas: the given one, else one per source schema in its place."""
    if target_schema:
        ensure_schema(spark, target_catalog, target_schema, schema_location, schema_comment)
        return
    for schema in source_schemas:
        row = derive_schemas(describe_schema(spark, source_catalog, schema, mounts), target_catalog).first()
        ensure_schema(
            spark, target_catalog, row["target_schema"], row["target_location"], row["target_comment"]
        )


def sync_external(
    spark: SparkSession,
    source_catalog: str,
    source_schemas: str | list[str],
    target_catalog: str,
    target_schema: str = "",
    tables: str | list[str] | None = None,
    target_table: str = "",
    mounts: DataFrame | None = None,
    create_schema: bool = False,
    schema_comment: str = "",
    schema_location: str = "",
    on_error: str = "stop",
    report_table: str | None = None,
    level: str = "count",
    marker: str = "properties",
) -> list[Outcome]:
    """External tables over the files of others, in either direction between catalogs.

    What to do is decided for the whole batch by one join of the two inventories; only tables to create, or to
    create again, then cost commands.
    """
    schemas = split_names(source_schemas)
    require(source_schemas=schemas, target_catalog=target_catalog)
    _check_single(split_names(tables), target_table=target_table)
    if create_schema:
        _derive_targets(
            spark, source_catalog, schemas, target_catalog, target_schema, mounts,
            schema_location, schema_comment,
        )
    by_at = markers.stamp(spark)
    listed = inventory(spark, source_catalog, schemas, tables, "table")
    # Locations of the whole batch are resolved by one join.
    places = external.resolved_locations(listed, mounts).select("schema", "name", "external_location", "resolution")
    source = listed.join(places, ["schema", "name"]).withColumns(
        {
            "source_name": F.struct("schema", "name"),
            "schema": F.lit(target_schema) if target_schema else F.col("schema"),
            "name": F.lit(target_table) if target_table else F.col("name"),
        }
    )
    there = [s for s in ([target_schema] if target_schema else schemas)
             if spark.catalog.databaseExists(schema_sql(spark, target_catalog, s))]
    names = [target_table] if target_table else tables
    target = (
        inventory(spark, target_catalog, there, names, missing_ok=True) if there else spark.createDataFrame([], INVENTORY)
    )
    plan = classify(source, target, (*external.PLAN, "source_name")).filter(F.col("action") != ORPHAN)

    def step(row):
        source = ObjectName(source_catalog, row["source_name"]["schema"], row["source_name"]["name"])
        target = target_of(source, target_catalog, target_schema, target_table)
        return lambda: external.sync(spark, source, target, None, None, marker, level, by_at, row.asDict())

    steps = (step(row) for row in plan.orderBy("source_name").toLocalIterator())
    return run_batch(spark, steps, on_error, report_table=report_table)


def sync_views(
    spark: SparkSession,
    source_catalog: str,
    source_schemas: str | list[str],
    target_catalog: str,
    views_wanted: str | list[str] | None = None,
    mounts: DataFrame | None = None,
    create_schema: bool = False,
    report_table: str | None = None,
    target_schema: str = "",
    schema_comment: str = "",
    schema_location: str = "",
    on_error: str = "continue",
) -> list[Outcome]:
    """Views of one catalog re-created in another, in either direction.

    They go to the schemas of their names, or all to ``target_schema``, which is created with its
    comment and location if wanted.
    """
    schemas = split_names(source_schemas)
    require(source_schemas=schemas, target_catalog=target_catalog)
    if create_schema:
        _derive_targets(
            spark, source_catalog, schemas, target_catalog, target_schema, mounts,
            schema_location, schema_comment,
        )
    source = filter_kind(inventory(spark, source_catalog, schemas, views_wanted), "view")
    target = filter_kind(inventory(spark, target_catalog, [target_schema] if target_schema else schemas), "view")
    return views.sync_all(
        spark, source, target, source_catalog, target_catalog, target_schema, on_error, report_table
    )
