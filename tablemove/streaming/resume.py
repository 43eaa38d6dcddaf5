"""Letting a stream that has read a table's files go on with the files of the table's incremental clone."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.functions.names import ObjectName
from tablemove.sources.inventory import describe
from tablemove.sources.workspace import children, copy_tree, is_missing, write_lines
from tablemove.streaming.incremental import current_state

_ENTRY = "path string, timestamp long, batchId long"
#: Parts of a checkpoint that hold no names of files.
_PLAIN_PARTS = ("metadata", "offsets", "commits", "state")


def _one_spelling(path: Column) -> Column:
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def seen_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``log, path, timestamp, batchId``: the files that a stream has taken up, by the log file that says so."""
    lines = spark.read.text(f"{checkpoint}/sources/{source}/*").select("value", F.col("_metadata.file_name").alias("log"))
    entries = lines.filter(F.col("value").startswith("{")).select("log", F.from_json("value", _ENTRY).alias("e"))
    return entries.select("log", "e.*")


def translated(spark: SparkSession, seen: DataFrame, files: DataFrame, location: str) -> DataFrame:
    """The same log with the clone's files in place of the source's; one of them may stand for several.

    A source file without rows has none in the clone, and one that is gone has none any more. A stream
    knows a file by the encoded form of its path, which Spark's own reader gives.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    base = re.sub("^file:/+", "file:/", location).rstrip("/")
    listed = listed.select(
        F.expr(f"substring(regexp_replace(path, '^file:/+', 'file:/'), {len(base) + 2})").alias("file"),
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///").alias("url"),
    )
    known = files.filter("file IS NOT NULL").select(F.regexp_replace("path", "^file:/+", "file:/").alias("own"), "file")
    joined = seen.join(known.join(listed, "file"), _one_spelling(F.col("path")) == F.col("own"))
    return joined.select("log", F.col("url").alias("path"), "timestamp", "batchId")


def continue_on_clone(spark: SparkSession, clone: str | ObjectName, checkpoint: str, new_checkpoint: str, source: int = 0) -> int:
    """Write a checkpoint with which a stopped file stream goes on with the clone; returns the number of files it has seen.

    The stream's query stays the same but for the folder it reads, which is the clone's. What it had read from the source
    it won't read again, and rows that came to the clone since then it will read once. The old checkpoint is left as
    it is; only one of the two may go on. As any file stream, it knows files by their names: a file that is rewritten in the
    source after it was read isn't read again if the checkpoint is made after the clone has taken it over.
    """
    clone = ObjectName.parse(clone)
    if not is_missing(spark, new_checkpoint):
        raise ValueError(f"{new_checkpoint} exists")
    if not children(spark, f"{checkpoint}/sources/{source}"):
        raise ValueError(f"{checkpoint} has no log of files for source {source}")
    state = current_state(spark, clone)
    if state is None:
        raise ValueError(f"{clone} does not exist")
    if state.broken_off(spark):
        raise ValueError(f"the last run of {clone} was broken off; run the clone again first")
    for part in _PLAIN_PARTS:
        if not is_missing(spark, f"{checkpoint}/{part}"):
            copy_tree(spark, f"{checkpoint}/{part}", f"{new_checkpoint}/{part}")
    location = describe(spark, clone)["location"]
    log = translated(spark, seen_files(spark, checkpoint, source), state.files(spark), location)
    rows = log.select("log", F.to_json(F.struct("path", "timestamp", "batchId")).alias("entry")).orderBy("log")

    def versioned(entries) -> Iterator[str]:
        yield "v1"
        yield from (entry for _, entry in entries)

    written = set()
    for name, entries in groupby(((r["log"], r["entry"]) for r in rows.toLocalIterator()), key=itemgetter(0)):
        written.add(name)
        write_lines(spark, f"{new_checkpoint}/sources/{source}/{name}", versioned(entries))
    # A batch all of whose files are gone still has its place in the log.
    for name in children(spark, f"{checkpoint}/sources/{source}"):
        if name not in written and not name.startswith("."):
            write_lines(spark, f"{new_checkpoint}/sources/{source}/{name}", versioned(()))
    return log.select("path").distinct().count()
