"""From bands to classes: verified links inside buckets, and their components.

Items are distinct texts with a 128-bit id. Each bucket first compares its members with
its smallest one, which is not looked at again there. Members of large buckets that still span several classes are
dealt anew, by shingles: of two texts that are close, the rarest shingles of each have one in common, as many of them as leave
too few others. Each of these smaller buckets is compared with its smallest member again. What buckets of
either kind leave apart is compared inside tasks, a bucket at a time, of which each member is one row; only buckets that are
still large are cut in blocks. So no two texts in a bucket with enough in common end up in different classes, and no
pairs are ever written but those to be compared with a smallest member, and those that are linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemove.llm.common import in_arrow, narrow, saved, scratch
from tablemove.llm.components import components

#: Buckets of more members are dealt anew by shingles; others are one block.
CROWDED = 4000
#: Sizes of the two sides of a block, when a bucket is compared in several.
MEMBER_BLOCK, STRAGGLER_BLOCK = 2000, 500
#: Shingle hashes of the texts of a block that a task compares at a time.
PART_HASHES = 2_000_000
#: Shingle hashes that a task remembers.
FEATURE_HASHES = 4_000_000
#: Pairs whose shingles are made at a time.
PAIRS = 100
#: Pairs of rows of a block that are looked at together, if one row doesn't have more.
ROW_PAIRS = 1 << 15
#: Rows that a task passes on together.
PASSED_ROWS = 2000
#: Words of 64 bits in the sketch of a text's shingles.
SKETCH = 16
#: Numbers by which shingles are ordered from rare to frequent; any order would do.
SLOTS = 1 << 16
#: Up to this many sketches are broadcast.
BROADCAST_SKETCHES = 150_000


def _sorted_once(values: np.ndarray) -> np.ndarray:
    """What ``np.unique`` gives, which takes several times as long for some hundred values."""
    values = np.sort(values)
    first = np.ones(values.size, bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def _distinct(values: np.ndarray) -> int:
    values = np.sort(values)
    return np.count_nonzero(values[1:] != values[:-1]) + (values.size > 0)


@dataclass(frozen=True)
class Similarity:
    """``features`` gives the hashes of the shingles of each of some texts; links need ``percent`` of Jaccard.

    A sketch has a bit for each shingle, by its hash. Bits that only one of two texts has tell how many shingles,
    at least, the other one doesn't have, so that most pairs are refused without a look at their texts, and
    none that is close is.
    """

    features: Callable[[list[str]], list[np.ndarray]]
    percent: int = 80

    def distinct(self, texts: list[str]) -> list[np.ndarray]:
        return [_sorted_once(f) for f in self.features(texts)]

    def close(self, x: np.ndarray, y: np.ndarray) -> bool:
        small, large = sorted((x.size, y.size))
        if not small or 100 * small < self.percent * large:
            return False
        both = np.concatenate([x, y])
        both.sort()
        common = np.count_nonzero(both[1:] == both[:-1])
        return 100 * common >= self.percent * (small + large - common)

    def possible(self, sizes: np.ndarray, bits: np.ndarray, size: np.ndarray | int, own: np.ndarray) -> np.ndarray:
        """Which of some texts may be close to another one, or each to its own, by sizes and sketches."""
        both = bits & own
        most = np.minimum(sizes - np.bitwise_count(bits ^ both).sum(1), size - np.bitwise_count(own ^ both).sum(1))
        return (most > 0) & (100 * most >= self.percent * (sizes + size - most))

    def possible_pair(self) -> Column:
        """The same for ``n_a, bits_a`` and ``n_b, bits_b``; what both may share is named once, as a filter computes it for each name."""

        def missing(x: str, y: str) -> Column:
            words = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
            return F.aggregate(words, F.lit(0), lambda p, q: p + q)

        most = F.least(F.col("n_a") - missing("bits_a", "bits_b"), F.col("n_b") - missing("bits_b", "bits_a"))
        both = F.col("n_a") + F.col("n_b")
        return (both > 0) & ((100 + self.percent) * most >= self.percent * both)

    def needed(self, size: int) -> int:
        """Of how many shingles, in an order that all texts share, a close text has to have one among its own."""
        return size - -(-self.percent * size // 100) + 1


class _Known:
    """Features of the texts that a task has met lately, by id; holds a bounded number of hashes."""

    def __init__(self, similarity: Similarity):
        self.similarity = similarity
        self.kept: dict[bytes, np.ndarray] = {}
        self.held = 0

    def __call__(self, node: bytes, text: pa.Scalar) -> np.ndarray:
        if node not in self.kept:
            self.learn({node: text.as_py()})
        return self.kept[node]

    def learn(self, texts: dict[bytes, str]) -> None:
        """Texts that are needed soon; shingles of many are made faster at a time."""
        new = {node: text for node, text in texts.items() if node not in self.kept}
        found = dict(zip(new, self.similarity.distinct(list(new.values())), strict=True))
        held = sum(f.size for f in found.values())
        self.held += held
        if self.held > FEATURE_HASHES:
            self.kept.clear()
            self.held = held
        self.kept |= found


def _links(frame: DataFrame, run: Callable) -> DataFrame:
    return in_arrow(frame, run, "a binary, b binary")


def _made(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*pairs, strict=True)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["a", "b"])


def _verify_pairs(similarity: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(similarity)
        for whole in batches:
            for at in range(0, whole.num_rows, PAIRS):
                batch = whole.slice(at, PAIRS)
                a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
                known.learn(dict(zip(a + b, x + y, strict=True)))
                rows = zip(a, b, *(batch.column(c) for c in ("text_a", "text_b")), strict=True)
                yield _made([(i, j) for i, j, p, q in rows if similarity.close(known(i, p), known(j, q))])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows come sorted by block; a block is small, and only one is held. With its sketches."""

    def whole(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        block = pa.Table.from_batches(parts)
        bits = np.concatenate([part.column("bits").flatten().to_numpy() for part in parts])
        return block, bits.view(np.uint64).reshape(-1, SKETCH)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("block").to_pylist()
        starts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        if held and held[0].column("block")[0].as_py() != names[0]:
            yield whole(held)
            held = []
        for start, end in pairwise(starts):
            if start:
                yield whole(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield whole(held)


def _partners(similarity: Similarity, block: pa.Table, bits: np.ndarray) -> dict[int, np.ndarray]:
    """For rows of stragglers, the rows of members of other classes that may be close to them; each pair once."""
    straggler, member = (block.column(c).to_numpy() for c in ("straggler", "member"))
    sizes, classes = block.column("n").to_numpy(), block.column("class").dictionary_encode().combine_chunks().indices.to_numpy()
    found = {}
    both, rows, place = straggler & member, np.flatnonzero(straggler), np.arange(straggler.size)
    step = max(1, ROW_PAIRS // place.size)
    for part in (rows[at : at + step] for at in range(0, rows.size, step)):
        others = member & (classes != classes[part, None])
        others &= ~both | (place >= part[:, None])
        # Close texts are near in size, which tells more cheaply than sketches.
        others &= 100 * np.minimum(sizes, sizes[part, None]) >= similarity.percent * np.maximum(sizes, sizes[part, None])
        row, other = np.nonzero(others)
        row = part[row]
        possible = similarity.possible(sizes[other], bits[other], sizes[row], bits[row])
        row, other = row[possible], other[possible]
        own, starts = np.unique(row, return_index=True)
        found |= zip(own.tolist(), np.split(other, starts[1:]), strict=own.size > 0)
    return found


def _rows_of(partners: dict[int, np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([list(partners), *partners.values()]))


def _parts(partners: dict[int, np.ndarray], sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of all pairs, if they have few shingles; else rows of some pairs at a time."""
    rows = _rows_of(partners)
    if sizes[rows].sum() <= PART_HASHES:
        yield rows
        return
    part, held = set(), 0
    for row, others in partners.items():
        for other in others.tolist():
            new = {row, other} - part
            held += int(sizes[[*new]].sum()) if new else 0
            if part and held > PART_HASHES:
                yield np.array(sorted(part))
                part, new = set(), {row, other}
                held = int(sizes[[*new]].sum())
            part |= new
    yield np.array(sorted(part))


def _possible_rows(similarity: Similarity):
    """Those rows of blocks that have a partner, in blocks whose shingles a task can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = ["id", "class", "straggler", "member"], [], 0
        for block, bits in _blocks(batches):
            if partners := _partners(similarity, block, bits):
                name = block.column("block")[0].as_py()
                for i, rows in enumerate(_parts(partners, block.column("n").to_numpy())):
                    part = block.select(names).take(pa.array(rows))
                    held.append(part.add_column(0, "block", pa.array([f"{name}:{i}"] * rows.size)))
                    size += rows.size
            if size > PASSED_ROWS:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return run


def _verify_blocks(similarity: Similarity):
    def linked(held: list[tuple[pa.Table, dict[int, np.ndarray]]], known: _Known) -> list[tuple[bytes, bytes]]:
        # Of the links in a block, those that join what isn't joined yet tell as much as all.
        nodes = [block.column("id").to_pylist() for block, _ in held]
        inside = [_rows_of(partners) for _, partners in held]
        features = {own[i]: known(own[i], block.column("text")[i]) for own, (block, _), rows in zip(nodes, held, inside, strict=True) for i in rows.tolist()}
        at = {node: i for i, node in enumerate(features)}
        sizes = np.array([f.size for f in features.values()])
        starts = np.cumsum(sizes) - sizes
        # Shingles of all these texts by numbers from 0.
        names, shingle = np.unique(np.concatenate(list(features.values())), return_inverse=True)
        shingle = np.split(shingle, starts[1:])
        mark, pairs = np.zeros(names.size, bool), []
        for own_nodes, (block, partners), rows in zip(nodes, held, inside, strict=True):
            label = block.column("class").dictionary_encode().combine_chunks().indices.to_numpy().copy()
            text = np.zeros(block.num_rows, np.int64)
            text[rows] = [at[own_nodes[i]] for i in rows.tolist()]
            for row, others in partners.items():
                others = others[label[others] != label[row]]
                if not others.size:
                    continue
                own, place = text[row], text[others]
                mark[shingle[own]] = True
                some = mark[np.concatenate([shingle[i] for i in place.tolist()])]
                common = np.add.reduceat(some, np.cumsum(sizes[place]) - sizes[place], dtype=np.int64)
                mark[shingle[own]] = False
                close = others[100 * common >= similarity.percent * (sizes[own] + sizes[place] - common)]
                if not close.size:
                    continue
                for other in close[np.unique(label[close], return_index=True)[1]].tolist():
                    label[label == label[other]] = label[row]
                    pairs.append((own_nodes[row], own_nodes[other]))
        return pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, texts, hashes = _Known(similarity), [], {}, 0

        def made() -> pa.RecordBatch:
            known.learn(texts)
            return _made(linked(held, known))

        for block, bits in _blocks(batches):
            if partners := _partners(similarity, block, bits):
                rows = _rows_of(partners)
                new = int(block.column("n").to_numpy()[rows].sum())
                if held and (len(texts) > 2 * PAIRS or hashes + new > PART_HASHES):
                    yield made()
                    held, texts, hashes = [], {}, 0
                texts |= zip(*(block.column(c).take(pa.array(rows)).to_pylist() for c in ("id", "text")), strict=True)
                held.append((block, partners))
                hashes += new
        if held:
            yield made()

    return run


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(48)).astype(np.int64) & (SLOTS - 1)


def _counted(similarity: Similarity):
    """How many shingles fall to each slot, for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for features in similarity.features(batch.column("text").to_pylist()):
                total += np.bincount(_slots(_sorted_once(features)), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], ["slot", "n"])

    return run


def _rarest(similarity: Similarity, often: np.ndarray):
    """The rarest shingles of each text, as buckets: as many as a close text has to have one of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, buckets = [], [np.empty(0, np.uint64)]
            texts = similarity.features(batch.column("text").to_pylist())
            for node, features in zip(batch.column("id").to_pylist(), texts, strict=True):
                distinct = _sorted_once(features)
                order = np.lexsort((distinct, often[_slots(distinct)]))
                first = distinct[order[: similarity.needed(distinct.size)]]
                ids += [node] * first.size
                buckets.append(first)
            columns = [pa.array(np.concatenate(buckets).view(np.int64)), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "id"])

    return run


def _shared(rows: DataFrame, label: str) -> DataFrame:
    """``bucket, id, low`` for the buckets that several ids share, ``low`` being the smallest."""
    bucket = Window.partitionBy("bucket")
    members = rows.select("bucket", "id", F.min("id").over(bucket).alias("low"), F.max("id").over(bucket).alias("high"))
    return saved(members.filter("low < high").select("bucket", "id", "low").distinct(), label)


def _named(members: DataFrame, classes: DataFrame) -> DataFrame:
    named = members.join(narrow(classes.withColumnRenamed("node", "id")), "id", "left")
    return named.withColumn("class", F.coalesce("root", "id"))


def _pivoted(members: DataFrame, known: DataFrame, classes: DataFrame | None, similarity: Similarity) -> DataFrame:
    """Links of members with the smallest ones of their buckets, where sketches allow one and none is known."""
    pairs = members.filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    if classes is not None:
        for end in "ab":
            named = classes.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
            pairs = pairs.join(narrow(named), end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
        pairs = pairs.filter("root_a <> root_b").select("a", "b")
    for end in "ab":
        pairs = pairs.join(narrow(known.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"))), end)
    near = 100 * F.least("n_a", "n_b") >= similarity.percent * F.greatest("n_a", "n_b")
    pairs = saved(pairs.filter(near), "pairs_near_in_size")
    inside = _inside(known, pairs, "a", "b")
    few = known.count() <= BROADCAST_SKETCHES
    for end in "ab":
        sketches = inside.select(F.col("id").alias(end), F.col("bits").alias(f"bits_{end}"))
        pairs = pairs.join(F.broadcast(sketches) if few else sketches, end)
    possible = saved(pairs.filter(similarity.possible_pair()).select("a", "b"), "possible_pairs")
    inside = _inside(known, possible, "a", "b")
    sides = [inside.select(F.col("id").alias(e), F.col("text").alias(f"text_{e}")) for e in "ab"]
    return saved(_links(possible.join(sides[0], "a").join(sides[1], "b"), _verify_pairs(similarity)), "links")


def _inside(known: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """What is known of the ids in some columns of saved rows, so that no other texts are moved."""
    ids = reduce(DataFrame.union, [rows.select(F.col(c).alias("id")) for c in columns]).distinct()
    return known.join(narrow(saved(ids, "ids_inside")), "id", "left_semi")


def _apart(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``bucket, n`` of the buckets that span classes.

    ``members`` has no member that all others of its bucket were compared with; if the others are in one class, they
    need no more comparing.
    """
    spans = _named(members, classes).groupBy("bucket").agg(F.count("*").alias("n"), F.count_distinct("class").alias("classes"))
    return saved(spans.filter("classes > 1").select("bucket", "n"), "apart_buckets")


def _unresolved(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``block, id, class, straggler, member``: for buckets that span classes, who is to be compared with whom.

    Members outside a bucket's largest class are its stragglers; each of them meets
    every member in one block, and blocks have a bounded size: a bucket is one block, in which nobody is
    repeated, unless it is crowded. Buckets of the same members count once.
    """
    named = _named(members, classes).select("bucket", "id", "class")
    groups = named.groupBy("bucket", "class").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("x2")
    )
    buckets = (
        groups.groupBy("bucket")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "class")).alias("most"),
            F.count("*").alias("classes"),
            F.bit_xor("x1").alias("x1"),
            F.bit_xor("x2").alias("x2"),
        )
        .filter("classes > 1")
        .groupBy("x1", "x2", "n", "most")
        .agg(F.min("bucket").alias("bucket"))
        .select(
            "bucket",
            F.col("most.class").alias("largest"),
            (F.col("n") <= CROWDED).alias("whole"),
            F.ceil(F.col("n") / MEMBER_BLOCK).alias("blocks"),
            F.ceil((F.col("n") - F.col("most.n")) / STRAGGLER_BLOCK).alias("straggler_blocks"),
        )
    )
    rows = named.join(narrow(saved(buckets, "block_buckets")), "bucket")
    names = ["block", "id", "class", "straggler", "member"]
    outside = F.col("class") != F.col("largest")
    whole = rows.filter("whole").withColumn("block", F.col("bucket").cast("string"))
    whole = whole.withColumn("straggler", outside).withColumn("member", F.lit(True)).select(names)
    rows = rows.filter("NOT whole")
    part = lambda blocks: F.pmod(F.xxhash64("id"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    as_member = rows.select("*", part("blocks").alias("m"), every("straggler_blocks").alias("s"), F.lit(False).alias("straggler"))
    as_straggler = rows.filter(outside).select("*", every("blocks").alias("m"), part("straggler_blocks").alias("s"), F.lit(True).alias("straggler"))
    both = as_member.unionByName(as_straggler).withColumn("member", ~F.col("straggler"))
    return whole.unionByName(both.withColumn("block", F.concat_ws(":", "bucket", "m", "s")).select(names))


def _sketched(similarity: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bits = [], [np.empty(0, np.int64)]
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), PAIRS):
                found = similarity.features(texts[at : at + PAIRS])
                own = np.array([_distinct(f) for f in found], np.int64)
                table = np.zeros((own.size, 64 * SKETCH), bool)
                rows = np.repeat(np.arange(own.size) * 64 * SKETCH, [f.size for f in found])
                table.ravel()[rows + (np.concatenate(found) % np.uint64(64 * SKETCH)).astype(np.int64)] = True
                sizes.append(own)
                bits.append(np.packbits(table).view(np.int64))
            words = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(bits)), SKETCH).cast(pa.list_(pa.int64()))
            columns = [batch.column("id"), batch.column("text"), pa.array(np.concatenate([[], *sizes]).astype(np.int64)), words]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text", "n", "bits"])

    return run


def near_classes(bands: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: Similarity) -> DataFrame:
    """``node, root`` for the items that are close to another one; all others are alone.

    ``bands`` has ``bucket, id``, one row per band of an item; repeated rows are harmless.
    ``texts`` gets a frame of ids and gives their ``id, text``.
    """
    with scratch(bands.sparkSession):
        members = _shared(bands, "bucket_members")
        # The smallest member is in the table too, so these are all ids there are.
        wanted = texts(saved(members.select("id").distinct(), "bucket_ids"))
        known = saved(in_arrow(wanted, _sketched(similarity), "id binary, text string, n long, bits array<long>"), "bucket_texts")
        first = _pivoted(members, known, None, similarity)
        classes = components(first)

        # Who was compared with its whole bucket is left out of it.
        others = members.filter("id <> low")
        apart = _apart(others, classes)
        rest = others.join(narrow(apart.filter(F.col("n") <= CROWDED)), "bucket", "left_semi").select("bucket", "id")
        crowded = apart.filter(F.col("n") > CROWDED)
        if not crowded.isEmpty():
            ids = others.join(narrow(crowded), "bucket", "left_semi").select("id").distinct()
            inside = known.select("id", "text").join(narrow(saved(ids, "crowded_ids")), "id", "left_semi")
            counts = in_arrow(inside.select("text"), _counted(similarity), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
            often = np.zeros(SLOTS, np.int64)
            for row in counts.collect():  # at most SLOTS rows
                often[row["slot"]] = row["n"]
            dealt = in_arrow(inside, _rarest(similarity, often), "bucket long, id binary")
            smaller = _shared(dealt, "shingle_members")
            first = first.unionByName(_pivoted(smaller, known, classes, similarity))
            classes = components(first)
            rest = rest.unionByName(smaller.filter("id <> low").select("bucket", "id"))

        blocks = saved(_unresolved(rest, classes), "blocks")
        # Texts are moved only for rows that sketches leave a partner in their block.
        schema = "block string, id binary, class binary, straggler boolean, member boolean"
        blocks = blocks.join(_inside(known.drop("text"), blocks, "id"), "id").repartition("block").sortWithinPartitions("block")
        blocks = saved(in_arrow(blocks, _possible_rows(similarity), schema), "possible_rows")
        blocks = blocks.join(_inside(known, blocks, "id"), "id").repartition("block").sortWithinPartitions("block")
        third = saved(_links(blocks, _verify_blocks(similarity)), "links")
        return saved(components(first.unionByName(third)), "classes", outlives=True)
