"""Running numbers over a table that no single task has to sort."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablemove.llm.common import in_arrow, narrow, saved


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, last, place = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        places = []
        for value in batch.column("grp").to_pylist():
            place = place + 1 if value == last else 0
            last = value
            places.append(place)
        columns = [*batch.columns, pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "place"])


def numbered(frame: DataFrame, order: list[str], label: str) -> DataFrame:
    """Adds ``at``, the place of a row in its group ``grp`` from 0, and ``of``, the rows of the group.

    Rows are ordered by the columns ``order``, NULL first. They are sorted by ranges of group and
    order, so that a large group lies in many tasks, and counted inside each range; running sums over
    the counts, one row for each range and group, give the starts. Rows that agree in everything
    are dealt by a seeded random number, so that they don't make one range.
    """
    by = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    ranges = frame.withColumn("salt", F.rand(1)).repartitionByRange(*by, "salt").sortWithinPartitions(*by).drop("salt")
    schema = StructType([*ranges.schema.fields, StructField("part", LongType()), StructField("place", LongType())])
    rows = saved(in_arrow(ranges, _places, schema), label)
    group = Window.partitionBy("grp")
    counts = rows.groupBy("grp", "part").agg(F.count("*").alias("n"))
    starts = counts.select(
        F.col("grp").alias("own"),
        F.col("part").alias("in_part"),
        F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("start"),
        F.sum("n").over(group).alias("of"),
    )
    starts = narrow(saved(starts, f"{label}_starts"))
    joined = rows.join(starts, F.col("grp").eqNullSafe(F.col("own")) & (F.col("part") == F.col("in_part")))
    return joined.select(*frame.columns, (F.coalesce("start", F.lit(0)) + F.col("place")).alias("at"), "of")
