"""Distributed union-find: connected components by repeated contraction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tablemove.llm.common import in_arrow, saved

#: Nodes whose edges a task holds at a time.
FOREST_NODES = 500_000


def _stars(kind: pa.DataType) -> Callable:
    """For each node of the edges that a task holds, one edge to the smallest node that they lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(node):
            while parent[node] != node:
                parent[node] = node = parent[parent[node]]
            return node

        def made() -> pa.RecordBatch:
            ends = [(node, least) for node in parent if (least := root(node)) != node]
            columns = list(zip(*ends, strict=True)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c in columns], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
            if len(parent) > FOREST_NODES:
                yield made()
                parent.clear()
        yield made()

    return run


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of the edges ``a, b``; the same root in each component.

    Tasks first replace the edges that they hold by stars, so that few rounds are left. In every round each node points at its smallest neighbour or itself, pointers are
    followed once more, and edges are drawn anew between what their ends point at. That keeps
    connected nodes connected, and the edges that remain are fewer each time: long chains
    shrink by pointer jumping, stars in one or two rounds. Every round is a few joins on
    narrow rows, written to the shared folder; nothing is gathered anywhere.
    """
    own = edges.schema["a"].dataType
    kind = pa.binary() if own.typeName() == "binary" else pa.int64()
    edges = edges.filter("a <> b").select("a", "b").repartition("a")
    edges = in_arrow(edges, _stars(kind), StructType([StructField("a", own), StructField("b", own)]))
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("edge"))
    both = saved(both.select("edge.*").distinct(), "edges")
    label = None
    while not both.isEmpty():
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        pointer = saved(least.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "pointers")
        onward = pointer.select(F.col("node").alias("root"), F.col("root").alias("next"))
        pointer = saved(pointer.join(onward, "root").select("node", F.col("next").alias("root")), "pointers")
        if label is None:
            label = pointer
        else:
            onward = pointer.select(F.col("node").alias("root"), F.col("root").alias("next"))
            label = label.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            label = saved(label, "labels")
        ends = [pointer.select(F.col("node").alias(e), F.col("root").alias(f"{e}_root")) for e in "ab"]
        moved = both.join(ends[0], "a").join(ends[1], "b")
        moved = moved.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        both = saved(moved.filter("a <> b").distinct(), "edges")
    if label is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label
