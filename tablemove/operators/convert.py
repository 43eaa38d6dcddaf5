"""Converting the format of a table in place."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from tablemove.functions.names import ObjectName, literal, table_sql
from tablemove.operators import markers
from tablemove.operators.copy import duplicate, publish, repair
from tablemove.operators.drift import IN_SYNC
from tablemove.operators.outcome import CONVERT, Outcome, attempt
from tablemove.sources.formats import check_writable, effective_format
from tablemove.sources.inventory import EXTERNAL, VIEW, describe, schema_of

CONVERTIBLE = ("parquet",)


def convert_format(
    spark: SparkSession,
    table: str | ObjectName,
    to: str = "delta",
    analyze: bool = False,
    level: str = "fingerprint",
    marker: str = "properties",
    by_at: tuple[str, datetime] | None = None,
) -> Outcome:
    """Convert a Parquet (or Hive-Parquet) table to another format under its name.

    The new files are written and checked beside the old ones before the name moves.
    Where the session has Delta, a conversion to it is left to its own command, which
    keeps the data files. Statistics are only collected with ``analyze``.
    """
    table, to = ObjectName.parse(table), to.lower()

    def work(outcome: Outcome) -> None:
        spark.catalog.refreshTable(table_sql(spark, table))
        about = describe(spark, table)
        outcome.source_object_type = about["object_type"]
        if about["object_type"] == VIEW:
            raise ValueError(f"{table} is a view; only tables are converted")
        current = effective_format(about["provider"], about["serde"])
        if current == to:
            outcome.action, outcome.description = IN_SYNC, f"table is already {to}"
            return
        if current not in CONVERTIBLE:
            raise ValueError(f"table is {current}, not {' or '.join(CONVERTIBLE)}; conversion is not supported")
        check_writable(spark, to, schema_of(spark, table))
        if to == "delta":
            outcome.statement = f"CONVERT TO DELTA {table_sql(spark, table)} NO STATISTICS"
            spark.sql(outcome.statement)
        else:
            _rewrite(spark, table, about, to, level, outcome)
        repair(spark, table, bool(about["partition_cols"]) and to != "delta")
        converted = describe(spark, table)
        if (converted["provider"] or "").lower() != to:
            raise AssertionError(f"{table} is {converted['provider']} after the conversion")
        markers.mark(spark, table, "convert", to.upper(), "format conversion", marker, by_at)
        if analyze:
            spark.sql(f"ANALYZE TABLE {table_sql(spark, table)} COMPUTE STATISTICS")
        outcome.action, outcome.description = CONVERT, f"converted from {current} to {to}"

    return attempt("convert", table, table, work)


def _rewrite(
    spark: SparkSession, table: ObjectName, about: dict, to: str, level: str, outcome: Outcome
) -> None:
    external = about["object_type"] == EXTERNAL

    def write(name: ObjectName, where: str | None) -> tuple[int, ...]:
        outcome.statement, wrote = duplicate(spark, table, about, name, where, to, level)
        if about["comment"]:
            spark.sql(f"COMMENT ON TABLE {table_sql(spark, name)} IS {literal(about['comment'])}")
        return wrote

    _, outcome.source_rows, outcome.target_rows = publish(
        spark,
        table,
        about["location"] if external else None,
        write,
        spark.table(table_sql(spark, table)),
        bool(about["partition_cols"]),
        level,
    )
