"""Merkle manifest of a table: a digest for every row, source and the whole, and proofs of change.

A tree of SHA-256 digests stands over the rows of each source, and one over the sources. A parent keeps
a copy of its hash state before each child's slot. Folding a changed row into the
root takes up the state of its slot and hashes the replacement and what is right of it; what is left of
it is never hashed again. A task builds the subtree over some consecutive nodes, three levels high,
with its states; the levels above come to it as one path for all of these nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.llm.common import in_arrow, saved
from tablemove.llm.numbering import numbered

#: Nodes that a parent has at most.
RUN = 16
#: Levels that a task builds at once, and the nodes below them.
LEVELS = 3
BLOCK = RUN**LEVELS
#: The columns of ``documents`` that a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER = [("left", pa.binary()), ("right", pa.binary())]
_PATH = "array<struct<left binary, right binary>>"
_NODE = "grp string, at long, of long, digest string"


class Parent:
    """Up to 16 digests in hexadecimal, their common digest, and the hash state before each of them."""

    def __init__(self, children: list[bytes]):
        self.joined = b"".join(children)
        self.states = []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def left(self, slot: int) -> bytes:
        return self.joined[: 64 * slot]

    def right(self, slot: int) -> bytes:
        return self.joined[64 * (slot + 1) :]

    def fold(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in a slot."""
        state = self.states[slot].copy()
        state.update(child + self.right(slot))
        return state.hexdigest().encode()


def subtree(nodes: list[bytes], of: int) -> list[list[Parent]]:
    """The levels over consecutive nodes of a level that has ``of`` nodes, from below.

    In a level too large for one task exactly three are built, else as many as leave one node.
    """
    levels: list[list[Parent]] = []
    while len(nodes) > 1 or (of > BLOCK and len(levels) < LEVELS):
        levels.append([Parent(nodes[i : i + RUN]) for i in range(0, len(nodes), RUN)])
        nodes = [p.digest for p in levels[-1]]
    return levels


def field(column: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def leaf(*columns: Column) -> Column:
    """The digest of a row: of its fields, one after another, in lower-case hexadecimal."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blocks(frame: DataFrame) -> DataFrame:
    """Rows of a block one after another, by place; a block is bounded, whatever its group is."""
    return frame.repartition("grp", "block").sortWithinPartitions("grp", "block", "at")


def _raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("grp", pa.string()), ("at", pa.int64()), ("of", pa.int64()), ("digest", pa.string())])
    made = []
    for (grp, block), rows in groupby(_rows(batches, ["grp", "block", "of", "digest"]), key=itemgetter(0, 1)):
        nodes = [(of, digest.encode()) for _, _, of, digest in rows]
        of = nodes[0][0]
        levels = subtree([d for _, d in nodes], of)
        top = levels[-1][0].digest if levels else nodes[0][1]
        made.append((grp, block, -(-of // BLOCK), top.decode()))
        if len(made) == BLOCK:
            yield _batch(made, schema)
            made = []
    yield _batch(made, schema)


def _rounds(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The nodes given, and those after each three levels, until every group has one."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("of")).first()[0] or 0) > 1:
        below = rounds[-1].select("grp", F.expr(f"at div {BLOCK}").alias("block"), "at", "of", "digest")
        rounds.append(saved(in_arrow(_blocks(below), _raised, _NODE), label))
    return rounds


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks of nodes, each led by the row of its path: what lies left and right of it, level by level."""
    led = paths.select("grp", "block", F.lit(-1).cast("long").alias("at"), "path", "subroot")
    return _blocks(
        nodes.withColumn("block", F.expr(f"at div {BLOCK}")).unionByName(led, allowMissingColumns=True)
    )


def _steps(levels: list[list[Parent]], at: int) -> list[tuple[bytes, bytes]]:
    steps = []
    for level in levels:
        parent, slot = level[at // RUN], at % RUN
        steps.append((parent.left(slot), parent.right(slot)))
        at //= RUN
    return steps


def _lowered(batches: Iterator[pa.RecordBatch], groups: bool = False) -> Iterator[pa.RecordBatch]:
    """The path of every node, which is that of a block in the round below.

    If the nodes are whole ``groups``, their digests are the subroots.
    """
    path_type = pa.list_(pa.struct(_UPPER))
    schema = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("path", path_type), ("subroot", pa.string())])
    names = ["grp", "block", "at", "of", "digest", "path", "subroot"]
    for (grp, _), rows in groupby(_rows(batches, names), key=itemgetter(0, 1)):
        lead, *nodes = rows
        if not nodes:
            continue
        upper = [(s["left"], s["right"]) for s in lead[5]]
        levels = subtree([n[4].encode() for n in nodes], nodes[0][3])
        made = []
        for i, node in enumerate(nodes):
            path = [dict(left=a, right=b) for a, b in (*_steps(levels, i), *upper)]
            made.append((grp, node[2], path, node[4] if groups else lead[6]))
        yield _batch(made, schema)
    yield _batch([], schema)


def _descended(rounds: list[DataFrame], top: DataFrame, label: str) -> DataFrame:
    """From the path of each group to the paths of its blocks of leaves."""
    paths = top
    for nodes in reversed(rounds[1:-1]):
        paths = saved(in_arrow(_with_paths(nodes, paths), _lowered, f"grp string, block long, path {_PATH}, subroot string"), label)
    return paths


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["grp", "block", "of", "digest", "path", "subroot", "doc_id", "changed"]
    kinds = [pa.int64(), *[pa.string()] * 4]
    schema = pa.schema(list(zip(["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"], kinds, strict=True)))
    for _, rows in groupby(_rows(batches, names), key=itemgetter(0, 1)):
        lead, *nodes = rows
        # One state before the block's slot in every level above serves all of its leaves.
        upper = [(sha256(s["left"]), s["right"]) for s in lead[4]]
        beside = b"".join(s["left"] + s["right"] for s in lead[4])
        levels = subtree([n[3].encode() for n in nodes], nodes[0][2])
        made = []
        for i, (_, _, _, digest, _, _, doc_id, changed) in enumerate(nodes):
            now, place, proof = changed.encode(), i, sha256()
            for level in levels:
                parent, slot = level[place // RUN], place % RUN
                proof.update(parent.left(slot) + parent.right(slot))
                now = parent.fold(slot, now)
                place //= RUN
            proof.update(beside)
            for before, right in upper:
                state = before.copy()
                state.update(now + right)
                now = state.hexdigest().encode()
            made.append((doc_id, digest, lead[5], proof.hexdigest(), now.decode()))
        yield _batch(made, schema)
    yield _batch([], schema)


class Manifest:
    """The tree over ``grp, doc_id, leaf, changed``: a row's group, name, digest, and its digest after a change.

    In a group, rows ascend by ``doc_id`` (NULL first), then by digest; groups by their bytes, NULL first.
    ``nodes`` and ``tops`` are tables of ``grp, at, of, digest`` for each round of three levels, of the rows
    and of the groups; an empty table has the root NULL.
    """

    def __init__(self, rows: DataFrame):
        placed = numbered(rows.withColumnRenamed("leaf", "digest"), ["doc_id", "digest", "changed"], "manifest_rows")
        self.rows = saved(placed, "manifest_leaves")
        self.nodes = _rounds(self.rows, "manifest_nodes")
        self.subroots = self.nodes[-1].select("grp", "digest")
        named = self.subroots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), "digest")
        groups = numbered(named, ["name"], "manifest_groups")
        self.groups = saved(groups, "manifest_subroots")
        self.tops = _rounds(self.groups, "manifest_tops")
        top = self.tops[-1].first()
        self.root = top and top["digest"]

    def folded(self) -> DataFrame:
        """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

        ``folded_root`` is the root with the row's ``changed`` digest in place of its leaf, all other
        rows as they are; ``proof_sha256`` is the digest of the siblings that this takes, from below.
        """
        spark = self.rows.sparkSession
        start = f"grp string, block long, path {_PATH}, subroot string"
        paths = _descended(self.tops, spark.createDataFrame([(None, 0, [], None)], start), "manifest_paths")
        # The leaves of the upper tree name the groups, in whose trees their paths go on.
        named = in_arrow(_with_paths(self.groups.drop("name"), paths), partial(_lowered, groups=True), start)
        named = named.select(F.col("block").alias("place"), "path", "subroot")
        named = named.join(self.groups.select("name", F.col("at").alias("place")), "place")
        named = saved(named.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), "path", "subroot"), "manifest_paths")
        paths = _descended(self.nodes, named, "manifest_paths")
        made = in_arrow(
            _with_paths(self.rows, paths),
            _folded,
            "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string",
        )
        root = F.lit(self.root).cast("string")
        return made.select(
            "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
        )


def manifest(documents: DataFrame, tampered: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Manifest:
    """The manifest of ``documents``, by ``source``; ``tampered`` gives fields their changed values.

    Every row is a leaf, repeated ones and those with NULL anywhere included. Other columns have no part in it.
    """
    own = [F.col(f"`{f}`") for f in fields]
    other = [(tampered or {}).get(f, c) for f, c in zip(fields, own, strict=True)]
    changed = leaf(*other) if tampered else F.col("leaf")
    rows = documents.select(
        F.col("source").alias("grp"), "doc_id", leaf(*own).alias("leaf"), *([changed.alias("changed")] if tampered else [])
    )
    return Manifest(rows if tampered else rows.withColumn("changed", changed))


def every_fifth_lowered() -> dict[str, Column]:
    """Tampering as the query has it: the texts of a fifth of the ids, by CRC-32, lose their capitals A to Z."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return {"text": F.when(hit, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))}
