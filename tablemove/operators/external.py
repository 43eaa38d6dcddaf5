"""External tables over existing files: registering, repairing and syncing them."""

from __future__ import annotations

import json
import re
from datetime import datetime
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.names import ObjectName, literal, quote, table_sql
from tablemove.operators import markers
from tablemove.operators.copy import drop, put_back, rename, repair
from tablemove.operators.drift import BLOCKED, CREATE, IN_SYNC, RECREATE, classify
from tablemove.operators.locations import NEEDS_DATA_MOVEMENT, UNCHANGED, resolve
from tablemove.operators.outcome import Outcome, attempt
from tablemove.operators.validate import assert_equal
from tablemove.sources.formats import is_available
from tablemove.sources.inventory import INVENTORY, VIEW, describe, exists
from tablemove.sources.workspace import is_missing, unique


def register(
    spark: SparkSession,
    name: str | ObjectName,
    fmt: str,
    location: str,
    schema: T.StructType | None = None,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Create an external table over files unless it exists; no data moves.

    Without a schema the files' own is used. A partitioned table is repaired, since it
    reads empty until its partitions are known. Returns the statement.
    """
    if not is_available(spark, fmt):
        raise ValueError(f"format {fmt} is not available in this session")
    statement = f"CREATE TABLE IF NOT EXISTS {table_sql(spark, name)}"
    if schema is not None and fmt.lower() != "delta":
        statement += f" ({schema.toDDL()})"
    statement += f" USING {fmt}"
    if options:
        statement += f" OPTIONS ({markers.pairs_sql(options)})"
    if partition_by and schema is not None:
        statement += f" PARTITIONED BY ({', '.join(quote(c) for c in partition_by)})"
    statement += f" LOCATION {literal(location)}"
    spark.sql(statement)
    partitioned = partition_by or describe(spark, name)["partition_cols"]
    repair(spark, name, bool(partitioned) and fmt.lower() != "delta")
    return statement


def resolved_locations(tables: DataFrame, mounts: DataFrame | None) -> DataFrame:
    """Rows of an inventory with ``external_location`` and ``resolution``."""
    located = tables.select("catalog", "schema", "name", "location", F.lit("table").alias("object_type"))
    if mounts is not None:
        return resolve(located, mounts)
    return located.select(
        "*", F.col("location").alias("external_location"), F.lit(UNCHANGED).alias("resolution")
    )


def resolve_location(spark: SparkSession, about: dict, mounts: DataFrame | None) -> tuple[str, str]:
    """External location and resolution of one described table."""
    if mounts is None:
        return about["location"], UNCHANGED
    row = resolved_locations(spark.createDataFrame([about], INVENTORY), mounts).first()
    return row["external_location"], row["resolution"]


#: Why a target is not in sync, by the reasons of ``drift.classify``.
_WHY = {
    "FORMAT": "formats differ (target is {target_format}, source is {source_format})",
    "SCHEMA": "schemas differ",
    "LOCATION": "locations differ (source is at {external_location})",
    "LAYOUT": "partitioning or options differ",
    "UNKNOWN": "the columns of one side are not known",
    "UNSUPPORTED": "the format of the source is not supported",
    "VIEW": "a view is in its place",
}
#: What a plan carries along for each source table.
PLAN = ("object_type", "partition_cols", "external_location", "resolution")


def _planned(spark: SparkSession, source: dict, target: dict | None, place: tuple[str | None, str]) -> dict:
    """The plan for a single table, by the same join as for a batch."""
    named = {**source, "schema": "s", "name": "t"}
    left = spark.createDataFrame([named], INVENTORY)
    left = left.withColumn("external_location", F.lit(place[0]).cast("string")).withColumn("resolution", F.lit(place[1]))
    right = spark.createDataFrame([{**target, "schema": "s", "name": "t"}] if target else [], INVENTORY)
    return classify(left, right, PLAN).first().asDict()


def sync(
    spark: SparkSession,
    source: str | ObjectName,
    target: str | ObjectName,
    mounts: DataFrame | None = None,
    place: tuple[str, str] | None = None,
    marker: str = "properties",
    level: str = "count",
    by_at: tuple[str, datetime] | None = None,
    plan: dict | None = None,
) -> Outcome:
    """Make ``target`` an external table over the files of ``source``.

    A target that drifted is created again if it is external; a managed one is an error, as dropping it
    would delete data. ``place`` is the location and its resolution if they are known already. ``plan`` is
    the row of :func:`drift.classify` if a batch has planned; a table in sync then costs no
    command, but for partitions that came or went. Both tables read
    the same files, so schema and count are compared by default, from file footers.
    """
    source, target = ObjectName.parse(source), ObjectName.parse(target)

    def work(outcome: Outcome) -> None:
        todo = plan
        if todo is None:
            spark.catalog.refreshTable(table_sql(spark, source))
            about = describe(spark, source)
            outcome.source_object_type = about["object_type"]
            if about["object_type"] == VIEW:
                raise ValueError(f"{source} is a view; views have their own sync")
            current = describe(spark, target) if exists(spark, target) else None
            todo = _planned(spark, about, current, place or resolve_location(spark, about, mounts))
        outcome.source_object_type = todo["object_type"]
        location, fmt = todo["external_location"], todo["source_format"]
        if not location or todo["resolution"] == NEEDS_DATA_MOVEMENT:
            raise ValueError(f"{source} is on local storage; it needs data movement")
        partitions, reason = todo["partition_cols"], _WHY.get(todo["reason"], "").format(**todo)
        if todo["action"] == BLOCKED:
            outcome.action = BLOCKED
            raise ValueError(f"{reason}; {target} is left as it is")
        if todo["action"] == IN_SYNC:
            outcome.action, outcome.description = IN_SYNC, "no action required, tables are in sync"
            if partitions and fmt != "delta":
                repair_difference(spark, target, location)
            return
        if plan is not None:
            spark.catalog.refreshTable(table_sql(spark, source))
            about = describe(spark, source)
        schema = spark.table(table_sql(spark, source)).schema

        def create(name: ObjectName) -> str:
            return register(spark, name, fmt, location, schema, partitions, about["options"])

        if todo["action"] == CREATE:
            outcome.action, outcome.description = CREATE, f"{fmt} table created"
            outcome.statement = create(target)
        else:
            outcome.action, outcome.description = RECREATE, f"table created again: {reason}"
            outcome.statement = recreate(spark, target, create, bool(partitions))
        outcome.source_rows, outcome.target_rows = assert_equal(spark, source, target, level)
        markers.mark(spark, source, "sync", str(target), "external table sync", marker, by_at)

    return attempt("sync", source, target, work)


#: Partitions that one command adds or drops.
PARTITIONS_PER_COMMAND = 200
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_difference(spark: SparkSession, name: str | ObjectName, location: str) -> DataFrame:
    """``partition, change``: folders with files that the catalog lacks (ADD), and partitions without files (DROP).

    The folders are listed by tasks; what is equal on both sides never reaches the driver.
    """
    base = re.sub("^file:/+", "file:/", location if ":" in location else f"file:{location}").rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location).select("path")
    inside = F.expr(f"substring(regexp_replace(path, '^file:/+', 'file:/'), {len(base) + 2})")
    folder = F.regexp_extract(inside, "^((?:[^/=]+=[^/]*/)+)", 1)
    found = files.select(F.rtrim(folder, F.lit("/")).alias("partition")).filter("partition <> ''").distinct()
    known = spark.sql(f"SHOW PARTITIONS {table_sql(spark, name)}").select("partition")
    both = found.withColumn("f", F.lit(1)).join(known.withColumn("k", F.lit(1)), "partition", "full_outer")
    change = F.when(F.col("k").isNull(), "ADD").when(F.col("f").isNull(), "DROP")
    return both.select("partition", change.alias("change")).filter("change IS NOT NULL")


def _partition_sql(partition: str) -> str:
    """``p=1/q=a%20b`` as a clause; names of folders are escaped."""
    pairs = (part.split("=", 1) for part in partition.split("/"))
    return "PARTITION (" + ", ".join(f"{quote(unquote(k))} = {literal(unquote(v))}" for k, v in pairs) + ")"


def repair_difference(spark: SparkSession, name: str | ObjectName, location: str) -> tuple[int, int]:
    """Add the partitions that came to an external table and drop those that went; returns how many.

    Partitions that stayed cost no command. One elsewhere than below the table's folder is never dropped, nor
    one whose folder is there without files.
    """
    table, done = table_sql(spark, name), {"ADD": 0, "DROP": 0}
    rows = ((r["change"], r["partition"]) for r in partition_difference(spark, name, location).toLocalIterator())
    while chunk := list(islice(rows, PARTITIONS_PER_COMMAND)):
        if any(_NO_VALUE in partition for _, partition in chunk):
            # A value of NULL can't be written in a clause.
            repair(spark, name, True)
        named = [(c, p) for c, p in chunk if _NO_VALUE not in p]
        added = [_partition_sql(p) for c, p in named if c == "ADD"]
        gone = [_partition_sql(p) for c, p in named if c == "DROP" and _is_gone(spark, name, location, p)]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
        if gone:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
        done["ADD"] += len(added)
        done["DROP"] += len(gone)
    spark.sql(f"REFRESH TABLE {table}")
    return done["ADD"], done["DROP"]


def _is_gone(spark: SparkSession, name: str | ObjectName, location: str, partition: str) -> bool:
    text = spark.sql(f"DESCRIBE EXTENDED {table_sql(spark, name)} {_partition_sql(partition)} AS JSON").first()[0]
    place, base = (re.sub("^file:/+", "/", p).rstrip("/") for p in (json.loads(text).get("location") or "", location))
    return place.startswith(f"{base}/") and is_missing(spark, place if base == location.rstrip("/") else f"file:{place}")


def recreate(spark: SparkSession, target: ObjectName, create, partitioned: bool) -> str:
    """Replace an external definition; the new one exists before the old one goes.

    Only definitions change, the files of both stay.
    """
    staging = target.renamed(unique(f"{target.name}__staging"))
    old = target.renamed(unique(f"{target.name}__old"))
    statement = create(staging)
    was_partitioned = bool(describe(spark, target)["partition_cols"])
    try:
        rename(spark, target, old, was_partitioned)
        rename(spark, staging, target, partitioned)
    except Exception as cause:
        put_back(spark, staging, target, old, partitioned, was_partitioned, cause)
        drop(spark, staging)
        raise
    drop(spark, old)
    return statement
