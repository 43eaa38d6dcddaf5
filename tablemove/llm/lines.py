"""Fuzzy line deduplication: one line of each class of similar lines stays in the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from tablemove.llm.common import document_key, in_arrow, narrow, saved, scratch, text_of
from tablemove.llm.documents_near import MEMO, mixed
from tablemove.llm.near import Similarity, near_classes
from tablemove.llm.numbering import numbered

_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNEVEN = (b"  ", b"\t", b"\r", b"\x0b", b"\x0c")
#: Characters that are hashed at a time.
_CHUNK = 1 << 18
#: Characters whose signatures are made at a time, so that their hashes stay in a core's cache.
_SIGNED = 1 << 16
#: Bits of a band's key that hold the size of a line; larger sizes count as the largest.
_SIZE_BITS = 20
_SIZES = (1 << _SIZE_BITS) - 1
#: Lines whose bands are dealt together, and to how many parts.
_DEALT_LINES, _BAND_PARTS = 1 << 16, 1024
#: Rows of bands that a task sorts in memory; Spark sorts those of tasks that get more.
TASK_BANDS = 1 << 22
_KINDS = {"long": LongType(), "binary": BinaryType(), "string": StringType(), "boolean": BooleanType()}


@dataclass(frozen=True)
class Fuzzy:
    """Shingles of ``chars`` characters; at Jaccard 0.8, all but 0.0013 of the pairs share a band."""

    chars: int = 7
    percent: int = 80
    bands: int = 10
    rows: int = 3


def shingles(texts: list[str], chars: int) -> list[np.ndarray]:
    """Hashes of the shingles of each line; a shorter line is one shingle."""
    found, part, size = [], [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > _CHUNK:
            found += np.split(*_split_at(part, chars))
            part, size = [], 0
    return found + (np.split(*_split_at(part, chars)) if part else [])


def _split_at(texts: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
    values, starts = _rolled(texts, chars)
    return values, starts[1:]


def _rolled(texts: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, one after another, and where each text starts."""
    padded = [t if len(t) >= chars else t.ljust(chars, "\x00") for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in padded], np.int64)
    ends = np.cumsum(sizes)
    count = points.size - chars + 1
    total = _windows(points, chars)
    inside = np.ones(points.size, bool)
    for i in range(1, chars):
        inside[ends - i] = False
    numbers = sizes - chars + 1
    return mixed(total[inside[:count]]), np.cumsum(numbers) - numbers


def _windows(points: np.ndarray, chars: int) -> np.ndarray:
    """Polynomials of all runs of some points, put together from those of half as many."""
    done, total = 1, points
    for bit in f"{chars:b}"[1:]:
        total = total[:-done] * _power(done) + total[done:]
        done *= 2
        if bit == "1":
            total = total[:-1] * _ODD + points[done : done + total.size - 1]
            done += 1
    return total * _ODD


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), exponent, 1 << 64))


def line_bands(texts: list[str], fuzzy: Fuzzy) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct shingles each line has, and MinHash signatures: a row of band hashes for each line."""
    values, starts = _rolled(texts, fuzzy.chars)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    result = np.empty((len(texts), fuzzy.bands), np.int64)
    turned = np.empty_like(low)
    seeds = iter(mixed(np.arange(1, fuzzy.bands * fuzzy.rows + 1, dtype=np.uint64)).tolist())
    for band in range(fuzzy.bands):
        total = np.full(len(texts), band + 1, np.uint64) * _ODD
        for _ in range(fuzzy.rows):
            seed = next(seeds)
            np.bitwise_xor(low, np.uint32(seed >> 32), out=turned)
            np.multiply(turned, np.uint32(seed & 0xFFFFFFFF | 1), out=turned)
            total = mixed(total + _ODD) ^ np.minimum.reduceat(turned, starts).astype(np.uint64)
        result[:, band] = mixed(total).view(np.int64)
    return _distinct_sizes(values, starts), result


def _distinct_sizes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Lines are fewer than 4,096, so that their number and 52 bits of a hash are sorted as one word."""
    both = np.repeat(np.arange(starts.size, dtype=np.uint64) << np.uint64(52), np.diff(starts, append=values.size))
    both |= values >> np.uint64(12)
    both.sort()
    # A line's first shingle differs from the last one of the line before.
    first = np.flatnonzero(both[1:] != both[:-1]) + 1
    return np.diff(np.searchsorted(first, starts[1:]), prepend=-1, append=first.size)


def _keys(texts: list[str], fuzzy: Fuzzy) -> np.ndarray:
    """A row of keys for each line: a band's hash, whose lowest bits are the size, so that they sort by both."""
    sizes, bands = line_bands(texts, fuzzy)
    return bands & ~np.int64(_SIZES) | np.minimum(sizes, _SIZES)[:, None]


def _cut(fuzzy: Fuzzy):
    """The lines with a word of each text: where they are and 128 bits of them.

    Lines are compared by their words with one space between them; ``line`` and ``keys`` are there once for all
    copies that a task meets, as far as it remembers them. ``keys`` are the bytes of as many numbers as there are bands.
    """
    names = ["doc_id", "k1", "k2", "at", "first", "id", "half", "line", "keys"]

    def keyed(lines: list[bytes | None]) -> pa.Array:
        made, part, size = [np.empty((0, fuzzy.bands), np.int64)], [], 0
        for line in lines:
            if line is None:
                continue
            part.append(line.decode())
            size += len(part[-1])
            if size > _SIGNED or len(part) == 1000:
                made.append(_keys(part, fuzzy))
                part, size = [], 0
        if part:
            made.append(_keys(part, fuzzy))
        there = np.array([line is not None for line in lines], bool)
        valid = pa.py_buffer(np.packbits(there, bitorder="little"))
        return _packed(np.concatenate(made), np.concatenate([[0], np.cumsum(there) * fuzzy.bands]), valid)

    def made(rows: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        of, at, first, ids, lines = zip(*rows, strict=True) if rows else ([], [], [], [], [])
        of = pa.array(of, pa.int64())
        halves = np.frombuffer(b"".join(ids), np.int64)[::2]
        own = [pa.array(at, pa.int64()), pa.array(first, pa.bool_()), pa.array(ids, pa.binary()), pa.array(halves)]
        own.append(pa.array(lines, pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays([*[batch.column(c).take(of) for c in names[:3]], *own, keyed(lines)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows, size = [], 0
            for of, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                # In most texts the words of a line have one space between them.
                even = not any(space in text for space in _UNEVEN)
                first = True
                for at, raw in enumerate(text.split(b"\n")):
                    line = raw.strip(b" ") if even else b" ".join(raw.split())
                    if not line:
                        continue
                    node = xxhash.xxh3_128_digest(line)
                    if node in seen:
                        rows.append((of, at, first, node, None))
                        first = False
                        continue
                    if len(seen) >= MEMO:
                        seen.clear()
                    seen.add(node)
                    rows.append((of, at, first, node, line))
                    first = False
                    size += len(line)
                    if size > 16 * _CHUNK:
                        yield made(rows, batch)
                        rows, size = [], 0
            yield made(rows, batch)

    return run


def occurrences(documents: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> DataFrame:
    """``doc_id, k1, k2, at, first, id, half, line, keys`` for every line with a word; ``at`` counts all lines from 0.

    Of lines with one ``id`` at least one has its ``line`` and ``keys``. ``half`` is half of the ``id``; ``first``
    marks one line of each row of ``documents``.
    """
    keyed = documents.select("doc_id", *document_key("doc_id", "text"), text_of().alias("text"))
    kinds = {"k1": "long", "k2": "long", "at": "long", "first": "boolean", "id": "binary", "half": "long", "line": "string", "keys": "binary"}
    own = documents.schema["doc_id"]
    return in_arrow(keyed, _cut(fuzzy), StructType([own, *[StructField(n, _KINDS[k]) for n, k in kinds.items()]]))


def _packed(numbers: np.ndarray, bounds: np.ndarray, valid: pa.Buffer | None = None) -> pa.Array:
    """The bytes of the numbers between each two bounds."""
    buffers = [valid, pa.py_buffer((8 * bounds).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))]
    return pa.Array.from_buffers(pa.binary(), bounds.size - 1, buffers)


def _unpacked(column: pa.Array) -> np.ndarray:
    """The numbers of all rows of a column, of lists or of packed bytes."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy()
    if not len(column):
        return np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[1]].view(np.int64)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of lines with their halves, those of a part in one row; a band is in one part."""

    def made(keys: list[np.ndarray], halves: list[np.ndarray]) -> pa.RecordBatch:
        key, half = np.concatenate(keys), np.concatenate(halves)
        part = (key >> _SIZE_BITS & _BAND_PARTS - 1).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        present, starts = np.unique(part[order], return_index=True)
        bounds = np.append(starts, part.size)
        columns = [pa.array(present.astype(np.int64)), _packed(key[order], bounds), _packed(half[order], bounds)]
        return pa.RecordBatch.from_arrays(columns, ["part", "keys", "halves"])

    keys, halves, held = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = _unpacked(batch.column("keys"))
        keys.append(key)
        halves.append(np.repeat(batch.column("half").to_numpy(), key.size // batch.num_rows))
        held += batch.num_rows
        if held >= _DEALT_LINES:
            yield made(keys, halves)
            keys, halves, held = [], [], 0
    if held:
        yield made(keys, halves)


def _sorted_runs(percent: int, most: int):
    """What ``_runs`` makes of all rows of a task, each once; a task with more than ``most`` passes them on as they are."""
    names = ["bucket", "half", "raw"]

    def marked(bucket: np.ndarray, half: np.ndarray, raw: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(half), pa.array(np.full(half.size, raw))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append((_unpacked(batch.column("keys")), _unpacked(batch.column("halves"))))
            rows += held[-1][0].size
            if rows > most:
                yield from (marked(*part, raw=True) for part in held)
                held = []
        if not held or rows > most:
            return
        key, half = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(key)
        for made in _runs(percent)(iter([pa.RecordBatch.from_arrays([pa.array(key[order]), pa.array(half[order])], ["key", "half"])])):
            bucket, half = (made.column(c).to_numpy() for c in ("bucket", "half"))
            order = np.lexsort((half, bucket))
            bucket, half = bucket[order], half[order]
            once = np.ones(half.size, bool)
            once[1:] = (bucket[1:] != bucket[:-1]) | (half[1:] != half[:-1])
            yield marked(bucket[once], half[once], raw=False)

    return run


def _runs(percent: int):
    """Rows come sorted by key: of a band's lines, those stay that have others near their size.

    Sorted by size, neighbours whose sizes are further apart than close lines' can be part a band into runs, of which each
    is a bucket of its own. A run that has begun is known by its last row, since rows of a run either are
    passed on or all are of one line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, begun, passed = None, 0, False
        for batch in batches:
            key, half = (batch.column(c).to_numpy() for c in ("key", "half"))
            if not key.size:
                continue
            if last is not None:
                key, half = np.append(last[0], key), np.append(last[1], half)
            band, size = key >> _SIZE_BITS, key & _SIZES
            new = (band[1:] != band[:-1]) | (100 * size[:-1] < percent * size[1:])
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            other = np.concatenate([[False], (half[1:] != half[:-1]) & ~new])
            several = np.logical_or.reduceat(other, starts)
            bucket = key[starts]
            if last is not None:
                several[0] |= passed
                bucket[0] = begun
            lengths = np.diff(starts, append=key.size)
            stay = np.repeat(several, lengths)
            if last is not None and passed:
                stay[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(bucket, lengths)[stay]), pa.array(half[stay])], ["bucket", "half"])
            last, begun, passed = (key[-1], half[-1]), bucket[-1], bool(several[-1])

    return run


def _buckets(cut: DataFrame, percent: int, most: int = TASK_BANDS) -> DataFrame:
    """``bucket, half``: lines that share a band and are near in size, with the halves of their ids; saved.

    Tasks sort their bands in memory. Those of a task that gets more than ``most`` rows, as when most lines share a
    band, are sorted by Spark, which spills.
    """
    dealt = in_arrow(cut.filter("keys IS NOT NULL").select("keys", "half"), _dealt, "part long, keys binary, halves binary")
    found = in_arrow(dealt.repartition("part").drop("part"), _sorted_runs(percent, most), "bucket long, half long, raw boolean")
    found = saved(found, "near_in_size")
    pairs, raw = found.filter("NOT raw").drop("raw"), found.filter("raw").select(F.col("bucket").alias("key"), "half")
    if raw.isEmpty():
        return pairs
    rows = raw.repartition(F.shiftright("key", _SIZE_BITS)).sortWithinPartitions("key")
    return saved(pairs.unionByName(in_arrow(rows, _runs(percent), "bucket long, half long")), "near_in_size")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key: ``gone`` has the different places of each."""

    def made(keys: list[tuple[int, int]], lists: list[list[int]]) -> pa.RecordBatch:
        columns = [pa.array([key[i] for key in keys], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(lists, pa.list_(pa.int64()))], ["k1", "k2", "gone"])

    keys, lists = [], []
    for batch in batches:
        for k1, k2, at in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "at")), strict=True):
            if not keys or keys[-1] != (k1, k2):
                keys.append((k1, k2))
                lists.append([])
            if not lists[-1] or lists[-1][-1] != at:
                lists[-1].append(at)
        if len(keys) > 1:
            yield made(keys[:-1], lists[:-1])
            keys, lists = keys[-1:], lists[-1:]
    yield made(keys, lists)


def removals(documents: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> tuple[DataFrame, DataFrame]:
    """``k1, k2, gone``: places of the lines to remove from each document, by the key of its id and text.

    And ``k1, k2`` of the documents with lines that several rows repeat.

    Lines are in one class if they are equal but for white space, or linked by a chain of lines
    of which each two neighbours share ``percent`` of their distinct shingles. Of a
    class, the occurrence with the smallest ``doc_id`` stays, then the smallest key and place.
    """
    with scratch(documents.sparkSession):
        cut = saved(occurrences(documents, fuzzy), "lines")
        shared = _buckets(cut, fuzzy.percent)
        wanted = narrow(saved(shared.select("half").distinct(), "near_halves"))
        written = cut.filter("line IS NOT NULL").select("id", "half", "line").join(wanted, "half", "left_semi")
        # Tasks pass on few lines twice, so that there is little to merge before the shuffle.
        written = written.repartition("id", "half")
        written = saved(written.groupBy("id", "half").agg(F.any_value("line").alias("text")), "near_lines")
        bands = shared.join(narrow(written.select("id", "half")), "half").select("bucket", "id")

        def texts(ids: DataFrame) -> DataFrame:
            return written.select("id", "text").join(narrow(ids), "id", "left_semi")

        similarity = Similarity(partial(shingles, chars=fuzzy.chars), fuzzy.percent)
        classes = near_classes(bands, texts, similarity).withColumnRenamed("node", "id")
        # Most lines are alone: in no class, and there once. Halves that two lines share make no difference.
        again = cut.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half", F.lit(True).alias("again"))
        named = cut.select("doc_id", "k1", "k2", "at", "id", "half").join(narrow(classes), "id", "left")
        named = named.join(narrow(saved(again, "repeated_lines")), "half", "left").filter("root IS NOT NULL OR again")
        several = named.select("doc_id", "k1", "k2", "at", F.coalesce("root", "id").alias("root"))
        several = saved(several, "shared_places")
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2", "at").alias("place")
        keep = several.groupBy("root").agg(F.min(order).alias("keep"))
        keep = keep.select("root", F.col("keep.k1").alias("keep_1"), F.col("keep.k2").alias("keep_2"), F.col("keep.at").alias("keep_at"))
        kept = (F.col("k1") == F.col("keep_1")) & (F.col("k2") == F.col("keep_2")) & (F.col("at") == F.col("keep_at"))
        gone = several.join(narrow(saved(keep, "kept_places")), "root").filter(~kept).select("k1", "k2", "at")
        gone = gone.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at")
        gone = in_arrow(gone, _listed, "k1 long, k2 long, gone array<long>")
        repeated = cut.filter("first").groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2")
        return saved(gone, "gone_lines", outlives=True), saved(repeated, "repeated_documents", outlives=True)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, removed = [], [], []
        given = batch.column("row").field("text").cast(pa.binary()).to_pylist()
        for text, gone, copy in zip(given, batch.column("gone").to_pylist(), batch.column("copy").to_pylist(), strict=True):
            drop = set(gone or ())
            lines = [] if text is None else text.split(b"\n")
            worded = [i for i, line in enumerate(lines) if line.strip()]
            if copy:
                drop = set(worded)
            counts.append(len(worded))
            removed.append(len(drop))
            texts.append(b"\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else text)
        made = pa.array(texts, pa.binary()).cast(pa.string())
        columns = [batch.column("row"), made, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_lines", "n_removed"])


def _numbered_copies(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds ``copy``, which counts the rows with one of the repeated keys from 0; only those are moved for it."""
    keys = ["k1", "k2"]
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    repeated = narrow(repeated)
    group = F.concat_ws(":", *keys)
    again = rows.join(repeated, keys, "left_semi").withColumn("grp", group)
    again = numbered(again, [], "repeated_documents").withColumnRenamed("at", "copy").drop("grp", "of")
    return rows.join(repeated, keys, "left_anti").withColumn("copy", F.lit(0).cast("long")).unionByName(again)


def deduplicated(documents: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> DataFrame:
    """``row`` (all columns of a document), ``text`` without the lines to remove, ``n_lines, n_removed``.

    Every document stays, if need be with an empty text. Lines without words and NULL
    texts are left as they are. Of rows that agree in ``doc_id`` and text only one keeps lines with words,
    so that one line of each class stays. Lines are those that line feeds separate.
    """
    gone, repeated = removals(documents, fuzzy)
    rows = documents.select(*document_key("doc_id", "text"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = _numbered_copies(rows, repeated).join(gone.hint("shuffle_hash"), ["k1", "k2"], "left").select("row", "gone", "copy")
    schema = StructType(
        [
            joined.schema["row"],
            StructField("text", StringType()),
            StructField("n_lines", LongType()),
            StructField("n_removed", LongType()),
        ]
    )
    return in_arrow(joined, _rebuilt, schema)


def deduplicate(documents: DataFrame, fuzzy: Fuzzy = Fuzzy(), lengths: str | None = None) -> DataFrame:
    """The documents with all their columns, and the lines removed from their texts.

    ``lengths`` names a column that holds the length of the text in characters, if there is one.
    """
    rows = deduplicated(documents, fuzzy)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == lengths:
            own = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col(f"row.`{name}`"))
            return own.cast(documents.schema[name].dataType).alias(name)
        return F.col(f"row.`{name}`")

    return rows.select(*[column(name) for name in documents.columns])
