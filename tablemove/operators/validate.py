"""Checking that two tables are equal: schema, count, fingerprint, exact difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.fingerprint import (
    FINGERPRINT_COLUMNS,
    ROWS,
    comparable,
    fingerprint,
    row_hash,
)
from tablemove.functions.names import ObjectName, table_sql
from tablemove.sources.workspace import new_area

LEVELS = ("count", "fingerprint", "diff")

TableOrFrame = str | ObjectName | DataFrame


def _frame(spark: SparkSession, table: TableOrFrame) -> DataFrame:
    return table if isinstance(table, DataFrame) else spark.table(table_sql(spark, table))


def schema_differences(source: T.StructType, target: T.StructType) -> list[str]:
    """Differences in column names and types, by name; empty when equal."""
    left = {f.name.lower(): f.dataType for f in source}
    right = {f.name.lower(): f.dataType for f in target}
    texts = [f"{name}: missing in target" for name in left if name not in right]
    texts += [f"{name}: not in source" for name in right if name not in left]
    texts += [
        f"{name}: {left[name].simpleString()} in source, {right[name].simpleString()} in target"
        for name in left
        if name in right and _type_text(left[name]) != _type_text(right[name])
    ]
    return texts


def _type_text(data_type: T.DataType) -> str:
    return data_type.simpleString().lower()


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Column-level difference of two inventories, matched by schema, name and column.

    ``status`` is SAME, MISSING, EXTRA, TYPE, ORDER or NULLABLE, the first that holds.
    """

    def side(inventory: DataFrame, prefix: str) -> DataFrame:
        columns = inventory.select(
            F.lower("schema").alias("schema"), F.lower("name").alias("name"), F.explode("columns").alias("c")
        )
        return columns.select(
            "schema", "name", F.lower("c.name").alias("column"), F.col("c").alias(prefix)
        )

    joined = side(source, "s").join(side(target, "t"), ["schema", "name", "column"], "full_outer")
    status = (
        F.when(F.col("t").isNull(), "MISSING")
        .when(F.col("s").isNull(), "EXTRA")
        .when(F.lower("s.type") != F.lower("t.type"), "TYPE")
        .when(F.col("s.pos") != F.col("t.pos"), "ORDER")
        .when(F.col("s.nullable") != F.col("t.nullable"), "NULLABLE")
        .otherwise("SAME")
    )
    return joined.select(
        "schema",
        "name",
        "column",
        F.col("s.type").alias("source_type"),
        F.col("t.type").alias("target_type"),
        status.alias("status"),
    )


#: Pairs of tables whose aggregates are stacked in one plan.
PAIRS_PER_JOB = 50


def counts(
    spark: SparkSession,
    pairs: list[tuple[TableOrFrame, TableOrFrame]],
    names: list[str] | None = None,
) -> DataFrame:
    """Row counts of pairs of tables and their difference, some pairs a job.

    A pair is labelled with its source's name unless ``names`` are given.
    """
    counted = _by_pair(spark, _labelled(pairs, names), lambda frame: [])
    difference = F.col("source_rows") - F.col("target_rows")
    return counted.select("name", "source_rows", "target_rows", difference.alias("diff"))


def fingerprints(
    spark: SparkSession,
    pairs: list[tuple[TableOrFrame, TableOrFrame]],
    names: list[str] | None = None,
) -> DataFrame:
    """Counts of pairs of tables and whether their contents agree, some pairs a job."""
    taken = _by_pair(spark, _labelled(pairs, names), lambda frame: fingerprint(row_hash(frame.schema))[1:])
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_fp") == F.col("target_fp"))
    return taken.select("name", "source_rows", "target_rows", same.alias("same"))


def _labelled(pairs, names: list[str] | None) -> list[tuple[str, TableOrFrame, TableOrFrame]]:
    labels = names or [str(source) for source, _ in pairs]
    return [(n, s, t) for n, (s, t) in zip(labels, pairs, strict=True)]


def _by_pair(spark: SparkSession, pairs: list[tuple[str, TableOrFrame, TableOrFrame]], aggregates) -> DataFrame:
    """One row per pair. Many pairs are taken in groups, whose rows go to one table: no plan grows with them all."""
    groups = range(0, len(pairs), PAIRS_PER_JOB)
    if len(groups) <= 1:
        return _stacked(spark, pairs, 0, aggregates)
    path = new_area(spark, "pairs")
    for start in groups:
        part = _stacked(spark, pairs[start : start + PAIRS_PER_JOB], start, aggregates)
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def _stacked(spark: SparkSession, pairs: list[tuple[str, TableOrFrame, TableOrFrame]], start: int, aggregates) -> DataFrame:
    """A global aggregate of each side of some pairs, stacked, then paired."""
    sides = []
    for position, (name, source, target) in enumerate(pairs, start):
        for label, table in (("source", source), ("target", target)):
            frame = _frame(spark, table)
            values = aggregates(frame)
            sides.append(
                frame.agg(F.count(F.lit(1)).alias(ROWS), *values).select(
                    F.lit(position).alias("position"),
                    F.lit(name).alias("name"),
                    F.lit(label).alias("side"),
                    ROWS,
                    F.array(*[F.col(c) for c in FINGERPRINT_COLUMNS[1:][: len(values)]])
                    .cast("array<bigint>")
                    .alias("fp"),
                )
            )
    stacked = reduce(DataFrame.unionByName, sides)

    def of(side: str, column: str):
        return F.max(F.when(F.col("side") == side, F.col(column)))

    return stacked.groupBy("position", "name").agg(
        of("source", ROWS).alias("source_rows"),
        of("target", ROWS).alias("target_rows"),
        of("source", "fp").alias("source_fp"),
        of("target", "fp").alias("target_fp"),
    )


def take_fingerprint(frame: DataFrame) -> tuple[int, ...]:
    """Count and content fingerprint in one scan."""
    hashed = frame.select(row_hash(frame.schema).alias("h"))
    return tuple(hashed.agg(*fingerprint(F.col("h"))).first())


def content_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Exact multiset difference: rows whose number differs, with both numbers.

    Both sides are stacked and counted per distinct row, so there is one shuffle and
    copies of a row are merged before it. Columns are matched by name; map columns
    appear as sorted arrays of entries.
    """
    differences = schema_differences(source.schema, target.schema)
    if differences:
        raise AssertionError("the schemas differ: " + "; ".join(differences))
    names = source.columns

    def side(frame: DataFrame, is_source: int) -> DataFrame:
        fields = {f.name.lower(): f for f in frame.schema}
        return frame.select(
            *[comparable(fields[n.lower()]).alias(n) for n in names], F.lit(is_source).alias("__source")
        )

    stacked = side(source, 1).unionByName(side(target, 0))
    keys = [F.col("`" + n.replace("`", "``") + "`") for n in names]
    return (
        stacked.groupBy(*keys)
        .agg(
            F.sum("__source").cast("bigint").alias("n_source"),
            F.sum(1 - F.col("__source")).cast("bigint").alias("n_target"),
        )
        .filter(F.col("n_source") != F.col("n_target"))
    )


#: Bits of the key hash by which buckets of rows are told apart, level by level.
BUCKET_BITS = (12, 8)


def _bucketed(frame: DataFrame, keys: list[str] | None, bits: int) -> DataFrame:
    """The frame with ``__bucket``, the first bits of the hash of a row's key."""
    wanted = {k.lower() for k in keys or frame.columns}
    fields = [f for f in frame.schema if f.name.lower() in wanted]
    if len(fields) < len(wanted):
        raise ValueError(f"not all of {', '.join(sorted(wanted))} are columns")
    return frame.withColumn("__bucket", F.shiftrightunsigned(row_hash(T.StructType(fields)), 64 - bits))


def bucket_differences(
    source: DataFrame, target: DataFrame, keys: list[str] | None = None, bits: tuple[int, ...] = BUCKET_BITS
) -> DataFrame:
    """``bucket, n_source, n_target``: where two tables differ, by the hash of ``keys`` (all columns if none are given).

    Fingerprints are taken of buckets, then of the smaller ones inside those that differ, and so on. Each
    level is a scan of both sides with partial aggregation; what is shuffled, and what the next level is
    joined with, is a row for each bucket and at most two to the power of all ``bits``.
    """
    if differences := schema_differences(source.schema, target.schema):
        raise AssertionError("the schemas differ: " + "; ".join(differences))
    found, total = None, 0
    for more in bits:
        sides = []
        for label, frame in (("source", source), ("target", target)):
            hashed = _bucketed(frame, keys, total + more).select("__bucket", row_hash(frame.schema).alias("__hash"))
            if found is not None:
                above = F.broadcast(found.select(F.col("bucket").alias("__above")))
                hashed = hashed.join(above, F.shiftright("__bucket", more) == F.col("__above"), "left_semi")
            names = [f"{label}_{c}" for c in FINGERPRINT_COLUMNS]
            taken = [value.alias(name) for value, name in zip(fingerprint(F.col("__hash")), names, strict=True)]
            sides.append(hashed.groupBy(F.col("__bucket").alias("bucket")).agg(*taken))
        both = sides[0].join(sides[1], "bucket", "full_outer")
        same = reduce(lambda a, b: a & b, [F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in FINGERPRINT_COLUMNS])
        number = lambda side: F.coalesce(f"{side}_{ROWS}", F.lit(0)).cast("bigint").alias(f"n_{side}")
        path = new_area(source.sparkSession, "bucket_differences")
        differing = both.filter(~same).select("bucket", number("source"), number("target"))
        differing.write.parquet(path)
        found, total = source.sparkSession.read.schema(differing.schema).parquet(path), total + more
    return found


def localized_diff(
    source: DataFrame, target: DataFrame, keys: list[str] | None = None, bits: tuple[int, ...] = BUCKET_BITS
) -> DataFrame:
    """The exact difference, as of :func:`content_diff`, of only the buckets whose fingerprints differ.

    Two large tables that differ in few rows are scanned, but only the rows of a few buckets are shuffled.
    With ``keys``, a row and its changed version are in one bucket.
    """
    buckets = F.broadcast(bucket_differences(source, target, keys, bits).select(F.col("bucket").alias("__bucket")))
    sides = [_bucketed(f, keys, sum(bits)).join(buckets, "__bucket", "left_semi").drop("__bucket") for f in (source, target)]
    return content_diff(*sides)


def diff_summary(source: DataFrame, target: DataFrame) -> DataFrame:
    """Numbers of missing and extra rows, copies counted: one row."""
    net = F.col("n_source") - F.col("n_target")
    zero = F.lit(0).cast("bigint")
    return content_diff(source, target).agg(
        F.coalesce(F.sum(F.greatest(net, zero)), zero).cast("bigint").alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(-net, zero)), zero).cast("bigint").alias("extra_rows"),
        F.count(F.when(F.col("n_target") > F.col("n_source"), 1)).alias("distinct_extra"),
        F.count(F.when(F.col("n_source") > F.col("n_target"), 1)).alias("distinct_missing"),
    )


def assert_equal(
    spark: SparkSession, source: TableOrFrame, target: TableOrFrame, level: str = "fingerprint"
) -> tuple[int, int]:
    """Raise ``AssertionError`` unless the tables agree; returns both row counts.

    ``level`` is ``'count'`` (schema and count), ``'fingerprint'`` (also content, one
    scan per side) or ``'diff'`` (exact, with the numbers of differing rows).
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}")
    left, right = _frame(spark, source), _frame(spark, target)
    differences = schema_differences(left.schema, right.schema)
    if differences:
        raise AssertionError("the schemas differ: " + "; ".join(differences))
    if level == "fingerprint":
        first, second = take_fingerprint(left), take_fingerprint(right)
    else:
        first, second = (left.count(),), (right.count(),)
    require_equal(first, second)
    if level == "diff":
        require_no_difference(left, right)
    return first[0], second[0]


def require_no_difference(source: DataFrame, target: DataFrame) -> None:
    """Exact comparison; raises with the numbers of differing rows."""
    summary = diff_summary(source, target).first()
    if summary["missing_rows"] or summary["extra_rows"]:
        raise AssertionError(
            f"{summary['missing_rows']} rows are missing and {summary['extra_rows']} are extra"
        )


def require_equal(source: tuple[int, ...], target: tuple[int, ...]) -> None:
    """Compare two fingerprints (or two counts)."""
    if source[0] != target[0]:
        raise AssertionError(
            f"numbers of rows differ: {source[0]} rows in source, {target[0]} in target"
        )
    if source != target:
        raise AssertionError(f"contents differ in {source[0]} rows")
