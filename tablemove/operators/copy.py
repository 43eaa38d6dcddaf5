"""Copying tables: CTAS with a projection, clones, and replacing by swap."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.fingerprint import FINGERPRINT_COLUMNS, ROWS, fingerprint, row_hash
from tablemove.functions.names import (
    ObjectName,
    literal,
    physical_schema,
    quote,
    session_sql,
    table_sql,
)
from tablemove.operators import markers
from tablemove.operators.outcome import CLONE, COPY, Outcome, attempt
from tablemove.operators.validate import (
    LEVELS,
    require_equal,
    require_no_difference,
    schema_differences,
    take_fingerprint,
)
from tablemove.sources.formats import check_writable, effective_format, lossless_options
from tablemove.sources.inventory import VIEW, describe, exists
from tablemove.sources.workspace import is_empty, remove, unique

_HASH = "__row_hash"


@dataclass
class Layout:
    """Physical clauses of a table to write."""

    fmt: str
    options: dict[str, str] = field(default_factory=dict)
    partition_by: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)
    n_buckets: int | None = None
    rebalance: bool = False


def measured(frame: DataFrame, level: str = "fingerprint") -> tuple[DataFrame, Observation]:
    """The frame with its fingerprint (or row count) taken while it is written.

    The observation sits on top of the plan, in the stage that writes, so a task that
    is run again after a lost executor is counted once and the source is read once.
    """
    observation = Observation()
    if level == "count":
        return frame.observe(observation, F.count(F.lit(1)).alias(ROWS)), observation
    hashed = frame.withColumn(_HASH, row_hash(frame.schema))
    return hashed.observe(observation, *fingerprint(F.col(_HASH))).drop(_HASH), observation


def measured_fingerprint(observation: Observation) -> tuple[int, ...]:
    values = observation.get
    return tuple(values[c] for c in FINGERPRINT_COLUMNS if c in values)


def repair(spark: SparkSession, name: str | ObjectName, partitioned: bool) -> None:
    """Bring the catalog up to date with the files of a table."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table_sql(spark, name)}")
    spark.sql(f"REFRESH TABLE {table_sql(spark, name)}")


def drop(spark: SparkSession, name: str | ObjectName) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table_sql(spark, name)}")


def rename(spark: SparkSession, old: ObjectName, new: ObjectName, partitioned: bool) -> None:
    """Rename a table and repair it.

    A catalog may keep the old folders as partition locations after a rename. The table
    then reads empty, and dropping it would delete whatever has taken its old place, so
    no renamed table may be read or dropped before it is repaired.
    """
    _, schema = physical_schema(spark, new.catalog, new.schema)
    spark.sql(f"ALTER TABLE {table_sql(spark, old)} RENAME TO {quote(schema)}.{quote(new.name)}")
    repair(spark, new, partitioned)


def replacement_location(location: str) -> str:
    """Folder for a new version of an external table, beside the current one."""
    return f"{location.rstrip('/')}__{unique('v')}"


def swap(
    spark: SparkSession, staging: ObjectName, target: ObjectName, rows: int, partitioned: bool
) -> None:
    """Put ``staging`` in the place of ``target``; the old table is dropped last.

    There is a short moment between the two renames in which ``target`` does not
    exist. Whatever step fails, and if the result does not hold ``rows`` rows, both
    tables go back to where they were.
    """
    old = target.renamed(unique(f"{target.name}__old"))
    was_partitioned = bool(describe(spark, target)["partition_cols"])
    try:
        rename(spark, target, old, was_partitioned)
        rename(spark, staging, target, partitioned)
        found = spark.table(table_sql(spark, target)).count()
        if found != rows:
            raise AssertionError(f"{target} holds {found} of {rows} rows after the swap")
    except Exception as cause:
        put_back(spark, staging, target, old, partitioned, was_partitioned, cause)
        raise
    drop(spark, old)


def put_back(
    spark: SparkSession,
    staging: ObjectName,
    target: ObjectName,
    old: ObjectName,
    partitioned: bool,
    was_partitioned: bool,
    cause: Exception,
) -> None:
    """Undo the renames of a swap as far as they were done; ``cause`` stays the error.

    A rename that failed in its repair has still moved the table, so what is done is
    read from the catalog.
    """
    try:
        if not exists(spark, old):
            return
        if exists(spark, target):
            rename(spark, target, staging, partitioned)
        rename(spark, old, target, was_partitioned)
    except Exception as error:  # the first error is the one to report
        cause.add_note(f"putting {old} back as {target} failed as well: {error}")


def _scan(frame: DataFrame, level: str) -> tuple[int, ...]:
    return (frame.count(),) if level == "count" else take_fingerprint(frame)


def publish(
    spark: SparkSession,
    target: ObjectName,
    location: str | None,
    write: Callable[[ObjectName, str | None], tuple[int, ...]],
    frame: DataFrame,
    partitioned: bool,
    level: str = "fingerprint",
) -> tuple[bool, int, int]:
    """Write and check a table, then make it visible as ``target``.

    ``write(name, location)`` creates a table and returns the fingerprint (or count) of
    what it wrote. A new target is written in place; an existing one is replaced only
    after its successor has been read back and found equal at ``level``.
    Returns whether a table was replaced, and the row counts of both sides.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}")
    replacing = exists(spark, target)
    if replacing and describe(spark, target)["object_type"] == VIEW:
        raise ValueError(f"{target} is a view")
    staged = target.renamed(unique(f"{target.name}__staging")) if replacing else target
    if replacing and location:
        location = replacement_location(location)
    elif location and not is_empty(spark, location):
        # Writing would add to these files, and a failure could not be undone.
        raise ValueError(f"{location} is not empty")
    try:
        wrote = write(staged, location)
        repair(spark, staged, partitioned and bool(location))
        copy = spark.table(table_sql(spark, staged))
        differences = schema_differences(frame.schema, copy.schema)
        if differences:
            raise AssertionError("the schemas differ: " + "; ".join(differences))
        read = _scan(copy, level)
        if wrote != read:
            # The observation is not trusted alone to refuse a copy: ask the source.
            wrote = _scan(frame, level)
        require_equal(wrote, read)
        if level == "diff":
            require_no_difference(frame, copy)
        if replacing:
            swap(spark, staged, target, read[0], partitioned)
    except Exception:
        drop(spark, staged)
        if location:
            # The folder was empty, so all that is in it is what failed here.
            remove(spark, location)
        raise
    return replacing, wrote[0], read[0]


def save(
    spark: SparkSession,
    frame: DataFrame,
    name: ObjectName,
    location: str | None,
    layout: Layout,
    level: str = "fingerprint",
) -> tuple[int, ...]:
    """Create a table from a frame; returns the fingerprint of the rows written."""
    if layout.rebalance and layout.partition_by:
        # Few files per partition, and a hot partition is split over several tasks.
        frame = frame.hint("rebalance", *[quote(c) for c in layout.partition_by])
    counted, observation = measured(frame, level)
    writer = counted.write.format(layout.fmt).options(**layout.options)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    elif layout.cluster_by:
        writer = writer.clusterBy(*layout.cluster_by)
    if layout.n_buckets:
        writer = writer.bucketBy(layout.n_buckets, layout.bucket_by)
        if layout.sort_by:
            writer = writer.sortBy(layout.sort_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table_sql(spark, name))
    return measured_fingerprint(observation)


def _layout(
    source: dict,
    schema: T.StructType,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    rebalance: bool | None = None,
) -> Layout:
    """Clauses of a copy: the user's, else the source's as far as its columns remain."""
    kept = {c.lower() for c in schema.names}
    source_fmt = effective_format(source["provider"], source["serde"]) if source["provider"] else None
    target_fmt = (fmt or source_fmt or "parquet").lower()
    inherited = source["options"] if source_fmt == target_fmt else {}
    layout = Layout(
        fmt=target_fmt,
        options={**lossless_options(target_fmt, schema), **(inherited if options is None else options)},
    )
    if partition_by:
        layout.partition_by = list(partition_by)
    else:
        layout.partition_by = [c for c in source["partition_cols"] if c.lower() in kept]
        if all(c.lower() in kept for c in source["cluster_cols"]):
            layout.cluster_by = source["cluster_cols"]
        if source["n_buckets"] and all(c.lower() in kept for c in source["bucket_cols"]):
            layout.n_buckets = source["n_buckets"]
            layout.bucket_by = source["bucket_cols"]
            layout.sort_by = [c for c in source["sort_cols"] if c.lower() in kept]
    # Files of a source with the same partitions already hold few partitions each.
    changed = layout.partition_by != source["partition_cols"]
    layout.rebalance = changed if rebalance is None else rebalance
    return layout


def _describe_metadata(
    spark: SparkSession, name: ObjectName, properties: dict[str, str], comment: str | None
) -> None:
    markers.set_properties(spark, name, properties)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table_sql(spark, name)} IS {literal(comment)}")


# Properties the catalog sets itself and refuses in TBLPROPERTIES.
_RESERVED = {"owner", "provider", "location", "comment", "collation", "external", "is_managed_location"}
# Properties that belong to one table: its layout, and the state of its incremental clone.
STATE_PROPERTY = "tablemove.incremental.state"
# Fixed value: what Spark shows in place of a secret.
_REDACTED = "*********(redacted)"
_NOT_INHERITED = _RESERVED | {"clusteringColumns", STATE_PROPERTY}


def own_properties(properties: dict[str, str]) -> dict[str, str]:
    """Properties to carry over: no markers of earlier moves, nothing the catalog sets.

    A value that Spark redacts as a secret cannot be read, and isn't replaced by the mask.
    """
    return {
        k: v
        for k, v in properties.items()
        if k not in _NOT_INHERITED and k not in markers.KEYS and v != _REDACTED
    }


def ctas(
    spark: SparkSession,
    source: str | ObjectName,
    target: str | ObjectName,
    select: list[str] | None = None,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
    properties: dict[str, str] | None = None,
    comment: str | None = None,
    location: str | None = None,
    fmt: str | None = None,
    rebalance: bool | None = None,
    level: str = "fingerprint",
    marker: str = "properties",
    by_at: tuple[str, datetime] | None = None,
) -> Outcome:
    """Copy a table or view with data movement, replacing the target.

    ``select`` is a list of SQL expressions (all columns by default). Clauses that are
    not given come from the source. ``location`` makes the target external; a
    replaced external target moves to a new folder beside it.

    Rows are redistributed by the partition columns when these differ from the
    source's, which is the only shuffle of a copy; ``rebalance`` decides otherwise.
    ``level`` is the check before the target is visible, as in ``validate``.
    """
    source, target = ObjectName.parse(source), ObjectName.parse(target)

    def work(outcome: Outcome) -> None:
        if source == target:
            raise ValueError("source and target are the same table")
        spark.catalog.refreshTable(table_sql(spark, source))
        about = describe(spark, source)
        outcome.source_object_type = about["object_type"]
        frame = spark.table(table_sql(spark, source)).selectExpr(*(select or ["*"]))
        layout = _layout(about, frame.schema, fmt, options, partition_by, rebalance)
        check_writable(spark, layout.fmt, frame.schema)
        carried = own_properties(about["properties"]) if about["object_type"] != VIEW else {}

        def write(name: ObjectName, where: str | None) -> tuple[int, ...]:
            wrote = save(spark, frame, name, where, layout, level)
            _describe_metadata(
                spark, name, {**carried, **(properties or {})}, about["comment"] if comment is None else comment
            )
            return wrote

        replaced, outcome.source_rows, outcome.target_rows = publish(
            spark, target, location, write, frame, bool(layout.partition_by), level
        )
        if about["object_type"] != VIEW:
            markers.mark(spark, source, "ctas", str(target), "CTAS", marker, by_at)
        outcome.action = COPY
        outcome.statement = _ctas_text(source, target, select, layout, location)
        outcome.description = "target replaced" if replaced else "target created"

    return attempt("ctas", source, target, work)


def _ctas_text(
    source: ObjectName, target: ObjectName, select: list[str] | None, layout: Layout, location: str | None
) -> str:
    text = f"CREATE OR REPLACE TABLE {target} USING {layout.fmt}"
    if layout.options:
        text += f" OPTIONS ({markers.pairs_sql(layout.options)})"
    if layout.partition_by:
        text += f" PARTITIONED BY ({', '.join(layout.partition_by)})"
    elif layout.cluster_by:
        text += f" CLUSTER BY ({', '.join(layout.cluster_by)})"
    if location:
        text += f" LOCATION {literal(location)}"
    return f"{text} AS SELECT {', '.join(select or ['*'])} FROM {source}"


def create_like(
    spark: SparkSession,
    source: ObjectName,
    name: ObjectName,
    location: str | None,
    properties: dict[str, str],
    fmt: str | None = None,
) -> str:
    """Create an empty table with the columns, comments and partitioning of another."""
    statement = f"CREATE TABLE {session_sql(spark, name)} LIKE {session_sql(spark, source)}"
    if fmt:
        statement += f" USING {fmt}"
    if properties:
        statement += f" TBLPROPERTIES ({markers.pairs_sql(properties)})"
    if location:
        statement += f" LOCATION {literal(location)}"
    spark.sql(statement)
    return statement


def duplicate(
    spark: SparkSession,
    source: ObjectName,
    about: dict,
    name: ObjectName,
    location: str | None,
    fmt: str | None = None,
    level: str = "fingerprint",
) -> tuple[str, tuple[int, ...]]:
    """Create ``name`` like ``source``, if wanted in another format, and fill it.

    Returns the statement and the fingerprint of the rows written.
    """
    frame = spark.table(table_sql(spark, source))
    properties = own_properties(about["properties"])
    if session_sql(spark, name) and session_sql(spark, source):
        statement = create_like(spark, source, name, location, properties, fmt)
        counted, observation = measured(frame, level)
        counted.write.insertInto(table_sql(spark, name))
        return statement, measured_fingerprint(observation)
    # Other catalogs have no CREATE TABLE LIKE; the writer carries the same clauses.
    layout = _layout(about, frame.schema, fmt)
    wrote = save(spark, frame, name, location, layout, level)
    markers.set_properties(spark, name, properties)
    return _ctas_text(source, name, None, layout, location), wrote


def clone(
    spark: SparkSession,
    source: str | ObjectName,
    target: str | ObjectName,
    location: str | None = None,
    level: str = "fingerprint",
    marker: str = "properties",
    by_at: tuple[str, datetime] | None = None,
) -> Outcome:
    """Copy data and metadata of a table; ``location`` makes the clone external.

    Columns, their comments, partitioning, bucketing, options and properties are
    kept; the description of the table is not part of a clone.
    """
    source, target = ObjectName.parse(source), ObjectName.parse(target)

    def work(outcome: Outcome) -> None:
        if source == target:
            raise ValueError("source and target are the same table")
        spark.catalog.refreshTable(table_sql(spark, source))
        about = describe(spark, source)
        outcome.source_object_type = about["object_type"]
        if about["object_type"] == VIEW:
            raise ValueError(f"{source} is a view; clone copies tables")

        # A clone of a Hive table is a native table of the format behind its serde.
        is_hive = (about["provider"] or "").lower() == "hive"
        fmt = effective_format(about["provider"], about["serde"]) if is_hive else None

        def write(name: ObjectName, where: str | None) -> tuple[int, ...]:
            outcome.statement, wrote = duplicate(spark, source, about, name, where, fmt, level)
            return wrote

        replaced, outcome.source_rows, outcome.target_rows = publish(
            spark,
            target,
            location,
            write,
            spark.table(table_sql(spark, source)),
            bool(about["partition_cols"]),
            level,
        )
        kind = "External" if location else "Managed"
        markers.mark(spark, source, "clone", str(target), f"{kind} table by clone", marker, by_at)
        outcome.action = CLONE
        outcome.description = f"{kind} table {'replaced' if replaced else 'created'}"

    return attempt("clone", source, target, work)
