"""Shared storage areas for staging, checkpoints and registered queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import SparkSession

from tablemove.functions.names import literal, schema_sql

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a cluster
    without it is refused, because executors cannot share a machine-local folder.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache
def _local_root(application: str) -> str:
    """One folder per local application, outside of any cluster."""
    return tempfile.mkdtemp(prefix=f"tablemove-{application}-")


def unique(label: str) -> str:
    """``label`` with a suffix no other call has."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def new_area(spark: SparkSession, label: str) -> str:
    """Path of an unused folder below the shared root."""
    return f"{shared_root(spark)}/tablemove/{unique(label)}"


def new_schema(spark: SparkSession, catalog: str, label: str) -> str:
    """Create a schema with a unique name in the shared root; returns its name."""
    schema = unique(label)
    location = f"{shared_root(spark)}/tablemove/{catalog}/{schema}"
    spark.sql(f"CREATE SCHEMA {schema_sql(spark, catalog, schema)} LOCATION {literal(location)}")
    return schema


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def is_empty(spark: SparkSession, path: str) -> bool:
    """True when nothing is at ``path``, or an empty folder."""
    system, hadoop = _file_system(spark, path)
    return not system.exists(hadoop) or not system.listStatusIterator(hadoop).hasNext()


def is_missing(spark: SparkSession, path: str) -> bool:
    """True when nothing is at ``path``."""
    system, hadoop = _file_system(spark, path)
    return not system.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it doesn't exist."""
    system, hadoop = _file_system(spark, path)
    if not system.exists(hadoop):
        return []
    return [status.getPath().getName() for status in system.listStatus(hadoop)]


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file within its file system; the folder it goes to is made."""
    system, hadoop = _file_system(spark, old)
    place = spark._jvm.org.apache.hadoop.fs.Path(new)
    system.mkdirs(place.getParent())
    if not system.rename(hadoop, place):
        raise OSError(f"{old} could not be moved to {new}")


def copy_tree(spark: SparkSession, old: str, new: str) -> None:
    """Copy a small folder with all its files."""
    (from_system, source), (to_system, place) = _file_system(spark, old), _file_system(spark, new)
    to_system.mkdirs(place.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        from_system, source, to_system, place, False, spark._jsc.hadoopConfiguration()
    )


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """A text file of lines, the last of which has no end, as they come."""
    system, hadoop = _file_system(spark, path)
    stream = system.create(hadoop)
    try:
        for i, line in enumerate(lines):
            stream.write(bytearray((f"\n{line}" if i else line).encode()))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file with a text."""
    system, hadoop = _file_system(spark, path)
    stream = system.create(hadoop)
    try:
        stream.writeUTF(text)
    finally:
        stream.close()


def read_note(spark: SparkSession, path: str) -> str:
    system, hadoop = _file_system(spark, path)
    stream = system.open(hadoop)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all its files."""
    system, hadoop = _file_system(spark, path)
    system.delete(hadoop, True)
