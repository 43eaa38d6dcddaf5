"""Seeding and tearing down estates of test tables in several formats and places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablemove.functions.names import ObjectName, schema_sql, table_sql
from tablemove.operators.outcome import COPY, Outcome, attempt
from tablemove.operators.views import create_view
from tablemove.plans.report import run_batch
from tablemove.sources.formats import COMPACT_OPTIONS, check_writable, lossless_options
from tablemove.sources.inventory import list_objects


def copy_table(
    spark: SparkSession,
    source: str | ObjectName | DataFrame,
    target: str | ObjectName,
    fmt: str = "parquet",
    location: str | None = None,
) -> Outcome:
    """Overwrite a managed table, or an external one with ``location``; text formats are compressed."""
    target = ObjectName.parse(target)

    def work(outcome: Outcome) -> None:
        frame = source if isinstance(source, DataFrame) else spark.table(table_sql(spark, source))
        check_writable(spark, fmt, frame.schema)
        options = {**lossless_options(fmt, frame.schema), **COMPACT_OPTIONS.get(fmt.lower(), {})}
        writer = frame.write.format(fmt).mode("overwrite").options(**options)
        if location:
            writer = writer.option("path", location)
        writer.saveAsTable(table_sql(spark, target))
        outcome.action, outcome.description = COPY, f"{fmt} table written"

    label = "frame" if isinstance(source, DataFrame) else source
    return attempt("seed", label, target, work)


def copy_schema(
    spark: SparkSession,
    catalog: str,
    schema: str,
    target_catalog: str,
    target_schema: str,
    fmt: str = "parquet",
    location: str | None = None,
    rename: Callable[[str], str] = lambda name: name,
    on_error: str = "stop",
) -> list[Outcome]:
    """Copy every table of a schema; with ``location`` each into a folder below it."""
    steps = (
        lambda name=row["name"]: copy_table(
            spark,
            ObjectName(catalog, schema, name),
            ObjectName(target_catalog, target_schema, rename(name)),
            fmt,
            f"{location.rstrip('/')}/{rename(name)}" if location else None,
        )
        for row in list_objects(spark, catalog, schema, kind="table").orderBy("name").toLocalIterator()
    )
    return run_batch(spark, steps, on_error)


def make_view(
    spark: SparkSession, table: str | ObjectName, view: str | ObjectName, limit: int | None = None
) -> str:
    """A view on a table, or on its first ``limit`` rows."""
    text = f"SELECT * FROM {table_sql(spark, table)}"
    return create_view(spark, view, text if limit is None else f"{text} LIMIT {limit}")


def drop_schemas(spark: SparkSession, catalog: str, schemas: list[str]) -> None:
    """Drop schemas with all they contain; files of external tables stay."""
    for schema in schemas:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema_sql(spark, catalog, schema)} CASCADE")
