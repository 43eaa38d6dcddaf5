"""Joins to a lookup side, safe for hot keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemove.functions.fingerprint import has_map

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


@dataclass(frozen=True)
class Lookup:
    """A side to join to, and whether it was measured small enough to broadcast."""

    frame: DataFrame
    small: bool


def fits_broadcast(
    side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a side with one partial aggregation: rows and bytes of its values."""
    size = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in side.columns), F.lit(16)
    )
    rows, total = side.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def prepare(side: DataFrame, small: bool | None = None) -> Lookup:
    """Persist a side that several joins read, and measure it unless told its size.

    Persisted partitions that are lost with an executor are computed again.
    """
    kept = side.persist(StorageLevel.MEMORY_AND_DISK)
    return Lookup(kept, fits_broadcast(kept) if small is None else small)


def lookup_join(
    rows: DataFrame, side: Lookup, on: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` to ``side`` on the columns ``on``.

    A side of measured small size is broadcast, so ``rows`` is not shuffled. Beyond
    that both sides are shuffled with a salt: ``side`` is repeated once per salt and
    a row's salt comes from its content and input partition, so a key or a group of
    copies that holds a third of all rows is spread over ``salts`` tasks. Both inputs
    of the salt are the same when a task is run again.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how}")
    if side.small:
        return rows.join(F.broadcast(side.frame), on, how)
    salt = "__salt"
    content = [F.col(f.name) for f in rows.schema if not has_map(f.dataType)]
    salted = rows.withColumn(
        salt, F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.lit(salts)).cast("int")
    )
    spread = side.frame.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*on, salt], how).drop(salt)
