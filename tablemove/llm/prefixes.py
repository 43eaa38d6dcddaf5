"""Prefix trie of conversations: a z-fast trie over tables, and its nodes turn by turn.

A conversation is the sequence of hashes of its prefixes. The trie holds compacted nodes: an
edge covers the depths ``top + 1`` to ``depth``, and only nodes that branch or end a conversation are
kept. A node's handle is the prefix whose length has the most trailing zero bits among its edge's
depths. A table from handles to nodes lets each conversation find where it leaves
the trie by a fat binary search, in as many joins as its length has bits. Conversations
come in by batches: of all that leave the trie at one place by the same turn, one comes in,
and the others go on searching below. Which one is drawn by its hash, so that the
number of batches grows with the logarithm of the number of conversations, whatever their shape.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.llm.common import BROADCAST_ROWS, in_arrow, narrow, saved

#: Bytes of a prefix's hash.
HASH = 16
#: Up to this many hashes of edges are broadcast.
BROADCAST_HASHES = 2_000_000
#: Ids in one row of the lists that are hashed.
CHUNK = 4096


def turn_hash(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * HASH))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: a row for each conversation, its turns as ``hash, size`` in order.

    Turns come by number, NULL first; those of one number by role, then by the hash of
    role and text. Repeated rows are turns of their own; NULL roles and texts are empty. Rows without a ``conv_id``
    belong to no conversation. Texts are not moved, only 24 bytes for each turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    each = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.struct("turn", role.alias("role"), turn_hash(role, text).alias("hash"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    listed = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["hash"].alias("hash"), t["size"].alias("size"))).alias("turns"))


def branched(turns: DataFrame) -> DataFrame:
    """Conversations rebuilt as branches: the first turns of the one at the last multiple of five, then their own.

    How many are taken over, 0 to 8, is the CRC-32 of the id modulo 9. If there is no such conversation
    these turns are missing.
    """
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    base = turns.select(F.col("conv_id").alias("base_id"), F.slice("turns", 1, 8).alias("base"))
    own = turns.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % 5).withColumn("taken", taken)
    rest = F.expr("slice(turns, taken + 1, greatest(size(turns) - taken, 0))")
    head = F.expr("slice(base, 1, taken)")
    joined = own.join(base, "base_id", "left")
    return joined.select("conv_id", F.when(F.col("base").isNull(), rest).otherwise(F.concat(head, rest)).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the hashes of turns to those of prefixes."""
    for batch in batches:
        result, last = [], []
        for turns in batch.column("hashes").to_pylist():
            now, chain = b"", []
            for turn in turns:
                now = sha256(now + turn).digest()[:HASH]
                chain.append(now)
            result.append(chain)
            last.append(now)
        arrays = [batch.column("conv_id"), pa.array(last, pa.binary()), pa.array(result, pa.list_(pa.binary())), batch.column("sizes")]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "id", "hashes", "sizes"])


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, id, hashes, sizes``: hashes of all prefixes of a conversation, the last one as its ``id``."""
    lists = turns.select("conv_id", F.col("turns.hash").alias("hashes"), F.col("turns.size").alias("sizes"))
    return in_arrow(lists, _chained, "conv_id long, id binary, hashes array<binary>, sizes array<long>")


def two_fattest(low: str, high: str) -> str:
    """SQL: of the numbers above ``low`` up to ``high``, the one with the most trailing zero bits."""
    return f"{high} & shiftleft(-1, length(bin({low} ^ {high})) - 1)"


def _node(top: Column, depth: Column, hashes: Column, sizes: Column, parent: Column) -> list[Column]:
    """The columns of a node from its edge, given the hashes and sizes of all its depths."""
    handle = F.expr(two_fattest("top", "depth"))
    return [
        F.element_at(hashes, -1).alias("id"),
        parent.alias("parent"),
        top.alias("top"),
        depth.alias("depth"),
        F.element_at(hashes, 1).alias("first"),
        F.element_at(hashes, handle - top).alias("handle"),
        hashes.alias("hashes"),
        sizes.alias("sizes"),
    ]


def exits(pending: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """Where each sequence ``id, n, hashes, sizes`` leaves the trie: adds ``at``, and the ``edge`` it leaves in.

    ``at`` is the depth of the longest prefix that the trie has. ``edge`` is the node below it if that prefix
    lies inside an edge, NULL if it is a node. ``bits`` is that of the longest sequence.
    """
    held = nodes.agg(F.count("*").alias("rows"), F.sum(F.size("hashes")).alias("hashes")).first()
    side = F.broadcast if held["rows"] <= BROADCAST_ROWS else lambda frame: frame
    handles = side(nodes.select("handle", F.col("id").alias("hit"), F.col("depth").alias("hit_depth")))
    search = pending.select("*", F.lit(0).alias("low"), F.col("n").alias("high"), F.lit(None).cast("binary").alias("edge"))
    for _ in range(bits):
        probe = F.expr(f"CASE WHEN edge IS NULL AND low < high THEN get(hashes, ({two_fattest('low', 'high')}) - 1) END")
        joined = search.withColumn("handle", probe).join(handles, "handle", "left")
        fits = F.expr("hit_depth <= n AND get(hashes, hit_depth - 1) = hit")
        search = joined.select(
            *pending.columns,
            F.when(F.col("handle").isNull() | F.col("hit").isNull() | ~fits, F.col("low")).otherwise(F.col("hit_depth")).alias("low"),
            F.when(F.col("handle").isNotNull() & F.col("hit").isNull(), F.expr(two_fattest("low", "high")) - 1)
            .otherwise(F.col("high"))
            .alias("high"),
            F.when(~fits, F.col("hit")).otherwise(F.col("edge")).alias("edge"),
        )
    # Those that left no edge by its handle may leave the one below the last node they met, above its handle.
    firsts = side(nodes.select(F.col("first"), F.col("id").alias("below")))
    search = search.withColumn("first", F.expr("CASE WHEN edge IS NULL AND low < n THEN get(hashes, low) END")).join(firsts, "first", "left")
    search = search.select(*pending.columns, "low", F.coalesce("edge", "below").alias("edge"))
    edges = nodes.select(F.col("id").alias("edge"), "top", F.col("hashes").alias("along"))
    search = search.join(F.broadcast(edges) if (held["hashes"] or 0) <= BROADCAST_HASHES else edges, "edge", "left")
    shared = F.expr("size(filter(sequence(1, greatest(1, least(size(along), n - top))), i -> get(along, i - 1) = get(hashes, top + i - 1)))")
    return search.select(*pending.columns, F.when(F.col("edge").isNull(), F.col("low")).otherwise(F.col("top") + shared).alias("at"), "edge")


def _inserted(nodes: DataFrame, found: DataFrame, chosen: DataFrame) -> DataFrame:
    """The nodes with edges cut where sequences leave or end, and a new leaf for each of ``chosen``."""
    cuts = found.filter("edge IS NOT NULL").groupBy("edge").agg(F.collect_set("at").alias("cuts"))
    cut = nodes.join(cuts, nodes["id"] == cuts["edge"], "left")
    # An edge becomes as many as its cuts make, each from one bound to the next.
    bounds = F.when(F.col("cuts").isNull(), F.array("top", "depth")).otherwise(
        F.concat(F.array("top"), F.sort_array("cuts"), F.array("depth"))
    )
    pieces = cut.withColumn("bounds", bounds).select(
        "*", F.explode(F.expr("sequence(1, size(bounds) - 1)")).alias("piece")
    )
    pieces = pieces.select(
        F.expr("get(bounds, piece - 1)").alias("top"),
        F.expr("get(bounds, piece)").alias("depth"),
        F.expr("slice(hashes, get(bounds, piece - 1) - top + 1, get(bounds, piece) - get(bounds, piece - 1))").alias("hashes"),
        F.expr("slice(sizes, get(bounds, piece - 1) - top + 1, get(bounds, piece) - get(bounds, piece - 1))").alias("sizes"),
        F.expr("CASE WHEN piece = 1 THEN parent ELSE get(hashes, get(bounds, piece - 1) - top - 1) END").alias("parent"),
    )
    leaves = chosen.select(
        F.col("at").alias("top"),
        F.col("n").alias("depth"),
        F.expr("slice(hashes, at + 1, n - at)").alias("hashes"),
        F.expr("slice(sizes, at + 1, n - at)").alias("sizes"),
        F.expr("CASE WHEN at = 0 THEN CAST('' AS BINARY) ELSE get(hashes, at - 1) END").alias("parent"),
    )
    return pieces.unionByName(leaves).select(*_node(*(F.col(c) for c in ("top", "depth", "hashes", "sizes", "parent"))))


def z_fast_trie(distinct: DataFrame) -> DataFrame:
    """The compacted nodes over distinct sequences ``id, n, hashes, sizes``, but for the root.

    Per node: ``id`` (hash of its prefix), ``parent``, ``top, depth``, ``first`` and ``handle`` (hashes at its
    edge's first depth and at its handle's), ``hashes, sizes`` of all depths of its edge. Each prefix that ends a sequence
    is a node.
    """
    spark = distinct.sparkSession
    longest = distinct.agg(F.max("n")).first()[0] or 0
    kinds = "id binary, parent binary, top int, depth int, first binary, handle binary, hashes array<binary>, sizes array<long>"
    nodes = spark.createDataFrame([], kinds)
    # A conversation without turns is the root.
    pending = saved(distinct.filter("n > 0").select("id", "n", "hashes", "sizes"), "trie_pending")
    while not pending.isEmpty():
        found = saved(exits(pending, nodes, longest.bit_length()), "trie_exits")
        open_ = found.filter("at < n").withColumn("next", F.expr("get(hashes, at)"))
        drawn = saved(open_.groupBy("next").agg(F.min("id").alias("id")).select("id"), "trie_drawn")
        chosen = found.join(narrow(drawn), "id", "left_semi")
        nodes = saved(_inserted(nodes, found, chosen), "trie_nodes")
        pending = saved(found.filter("at < n").join(narrow(drawn), "id", "left_anti").drop("at", "edge"), "trie_pending")
    return nodes


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node as text, some thousands a row."""
    for batch in batches:
        rows = zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
        made = []
        for node, group in groupby(rows, key=itemgetter(0)):
            ids = [i for _, i in group]
            made += [(node, ids[i], ",".join(map(str, ids[i : i + CHUNK]))) for i in range(0, len(ids), CHUNK)]
        columns = list(zip(*made, strict=True)) if made else [[]] * 3
        kinds = (pa.binary(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "low", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), strict=True))
    made = []
    for node, group in groupby(rows, key=itemgetter(0)):
        state = sha256()
        for i, (_, ids) in enumerate(group):
            state.update((f",{ids}" if i else ids).encode())
        made.append((node, state.hexdigest()))
        if len(made) == CHUNK:
            yield _ends(made)
            made = []
    yield _ends(made)


def _ends(made: list[tuple[bytes, str]]) -> pa.RecordBatch:
    nodes, digests = zip(*made, strict=True) if made else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], ["id", "ends_sha256"])


def end_lists(members: DataFrame) -> DataFrame:
    """``id, ends_sha256``: the SHA-256 of the ids that end at a node, ascending and joined by commas.

    Ids are sorted by ranges, so that many copies of one conversation lie in many tasks; what is
    hashed in one stream are rows of thousands of ids.
    """
    sorted_ = members.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    packed = in_arrow(sorted_, _packed, "id binary, low long, ids string")
    return in_arrow(packed.repartition("id").sortWithinPartitions("id", "low"), _hashed, "id binary, ends_sha256 string")


def _gathered(values: DataFrame, jumps: list[DataFrame], sums: dict[str, Column], joined: dict[str, Column]) -> DataFrame:
    """Values of a node and all nodes below it, from those of each, by doubling the distance."""
    for jump in jumps:
        below = values.join(jump, "id").groupBy(F.col("jump").alias("id")).agg(*[v.alias(f"more_{c}") for c, v in sums.items()])
        values = values.join(narrow(saved(below, "trie_below")), "id", "left")
        values = saved(values.select("id", *[v.alias(c) for c, v in joined.items()]), "trie_sums")
    return values


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """For each power of two up to the height, from a node to the one so many nodes above it."""
    jumps = [nodes.select("id", F.col("parent").alias("jump"))]
    while True:
        onward = narrow(jumps[-1]).select(F.col("id").alias("jump"), F.col("jump").alias("next"))
        # The root is above nothing, so that what reaches it goes no further.
        further = jumps[-1].filter(F.length("jump") > 0).join(onward, "jump").select("id", F.col("next").alias("jump"))
        further = saved(further, "trie_jumps")
        if further.isEmpty():
            return jumps
        jumps.append(further)


def _added(names: tuple[str, ...]) -> tuple[dict[str, Column], dict[str, Column]]:
    return {c: F.sum(c) for c in names}, {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in names}


@dataclass
class Trie:
    """The compacted nodes, and how many conversations, and the smallest one, end at each."""

    nodes: DataFrame
    ends: DataFrame
    members: DataFrame

    def expanded(self) -> DataFrame:
        """A row for each distinct prefix: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
        saved_tokens, ends_sha256``.

        ``conv_id`` is the smallest conversation that starts with the prefix. All depths of an edge have
        the same conversations and, but for its last one, one child.
        """
        nodes, edges = self.nodes, saved(_jumps_from(self.nodes), "trie_parents")
        jumps = _jumps(edges)
        children = edges.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
        root = self.nodes.sparkSession.createDataFrame([(b"",)], "id binary")
        every = edges.select("id").union(root)
        start = every.join(narrow(self.ends), "id", "left").join(narrow(saved(children, "trie_children")), "id", "left")
        start = saved(
            start.select(
                "id",
                F.coalesce("n_ends", F.lit(0)).alias("n_convs"),
                F.col("conv_id").alias("conv_id"),
                F.when(F.coalesce("n_children", F.lit(0)) == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                F.coalesce("n_children", F.lit(0)).alias("n_children"),
            ),
            "trie_start",
        )
        sums, joined = _added(("n_convs", "n_leaves"))
        sums["conv_id"], joined["conv_id"] = F.min("conv_id"), F.least("conv_id", "more_conv_id")
        totals = _gathered(start.drop("n_children"), jumps, sums, joined)
        totals = saved(totals.join(narrow(start.select("id", "n_children")), "id"), "trie_totals")
        # What an edge saves, then what all edges below a node save.
        weights = edges.select("id", "bytes").join(narrow(totals.select("id", "n_convs")), "id")
        own = saved(weights.select("id", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")).union(root.select("id", F.lit(0).cast("long"))), "trie_saved")
        whole = _gathered(own, jumps, *_added(("saved",)))
        below = whole.join(own.withColumnRenamed("saved", "own"), "id").select("id", (F.col("saved") - F.col("own")).alias("below"))
        marked = totals.join(narrow(saved(below, "trie_saved_below")), "id").join(narrow(saved(end_lists(self.members), "trie_ends")), "id", "left")
        marked = saved(marked.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))), "trie_marked")
        return self._turn_by_turn(nodes, marked)

    def _turn_by_turn(self, nodes: DataFrame, marked: DataFrame) -> DataFrame:
        names = narrow(marked.select(F.col("id").alias("parent"), F.col("conv_id").alias("above")))
        edges = nodes.select("id", "parent", "top", "depth", "sizes").join(narrow(marked), "id").join(names, "parent")
        saved_ = F.expr("(n_convs - 1) * aggregate(slice(sizes, at - top, depth - at + 1), 0L, (a, b) -> a + b) + below")
        each = edges.withColumn("at", F.explode(F.expr("sequence(top + 1, depth)")))
        inner = F.col("at") < F.col("depth")
        turns = each.select(
            "conv_id",
            F.col("at").cast("long").alias("depth"),
            F.when(F.col("at") == F.col("top") + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.when(inner, 1).otherwise(F.col("n_children")).cast("long").alias("n_children"),
            "n_leaves",
            saved_.alias("saved_tokens"),
            F.when(inner, F.sha2(F.lit(""), 256)).otherwise(F.col("ends_sha256")).alias("ends_sha256"),
        )
        none = F.lit(None).cast("long")
        root = marked.filter((F.length("id") == 0) & (F.col("n_convs") > 0)).select(
            "conv_id", F.lit(0).cast("long").alias("depth"), none.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            F.col("below").alias("saved_tokens"), "ends_sha256",
        )
        return turns.unionByName(root)


def _jumps_from(nodes: DataFrame) -> DataFrame:
    """The narrow side of the nodes: who is above, and the bytes along the edge."""
    return nodes.select("id", "parent", F.expr("aggregate(sizes, 0L, (a, b) -> a + b)").alias("bytes"))


def trie(turns: DataFrame) -> Trie:
    """The trie over all conversations ``conv_id, turns``. Equal conversations are merged before."""
    members = saved(sequences(turns), "trie_sequences")
    # One conversation stands for all equal ones; their lists are equal too.
    ends = members.groupBy("id").agg(F.count("*").alias("n_ends"), F.min("conv_id").alias("conv_id"))
    ends = saved(ends, "trie_ends")
    chosen = members.join(narrow(ends.select("id", "conv_id")), ["id", "conv_id"], "left_semi")
    distinct = saved(chosen.select("id", F.size("hashes").alias("n"), "hashes", "sizes"), "trie_distinct")
    return Trie(z_fast_trie(distinct), ends, members.select("id", "conv_id"))
