"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablemove.sources.workspace import new_area, remove

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` without arguments separates at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def document_key(*columns: str) -> list[Column]:
    """128 bits that tell rows apart by content, as ``k1`` and ``k2``.

    Rows that agree in all the columns share a key; NULLs count as values. Unlike a running
    number, the key is the same whenever a lost partition is computed again.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(7), *reversed(parts)).alias("k2")]


#: Folders written inside each open ``scratch``, the innermost last.
_OPEN: list[list[str]] = []


#: Whether Spark deletes the shuffle files of a query when it has ended, and not when the driver collects garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``saved`` writes inside is removed at the end, but for a result saved with ``outlives``.

    All steps inside are written and read again, so that shuffle files are of no use after the step that made them.
    """
    areas: list[str] = []
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    _OPEN.append(areas)
    try:
        yield
    finally:
        _OPEN.remove(areas)
        spark.conf.set(_CLEAN_UP, before)
        for area in areas:
            remove(spark, area)


def saved(frame: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write to the shared folder and read again: the plan starts anew and survives lost executors.

    The files go with the innermost open ``scratch``; if they have to outlive it, with the one around it.
    """
    spark = frame.sparkSession
    path = new_area(spark, label)
    scopes = _OPEN[:-1] if outlives else _OPEN
    if scopes:
        scopes[-1].append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Up to this many narrow rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def narrow(frame: DataFrame) -> DataFrame:
    """A saved frame of a few numbers a row as a join side: broadcast if its counted rows are few."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def in_arrow(frame: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package, as it is imported here, on their path.

    Executors of a cluster need it installed or sent along, as any Python package.
    """
    environment = frame.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return frame.mapInArrow(run, schema)
