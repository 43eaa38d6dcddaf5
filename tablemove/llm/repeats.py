"""Exact repeats: every byte covered by a string of some length that also starts elsewhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tablemove.llm.common import document_key, in_arrow, saved, text_of
from tablemove.llm.documents_near import mixed
from tablemove.llm.suffixes import equal_windows

LENGTH = 400
#: Bytes of the strings that anchors are chosen among. Longer ones are shared less often by texts that
#: only have a line in common, but make more anchors.
GRAM = 128
#: Window starts of a long text that are looked at together; positions fit in 20 bits.
_BLOCK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
#: Distinct segments of an anchor that are ordered together, those whose windows are counted
#: together, windows that are ordered in one call, and digests a task remembers.
SALT_SEGMENTS, BUCKET_SEGMENTS, CALL_WINDOWS, MEMO = 500, 100, 60_000, 200_000
#: Window digests in a row, so that a batch of rows stays small.
PACKED_WINDOWS = 256

_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, kept for the task."""
    if "up" not in _powers or _powers["up"].size < size:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(max(size, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = _power_table(data.size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: data.size])])
    count = data.size - gram + 1
    return mixed((sums[gram:] - sums[:count]) * down[:count])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of ``length`` bytes: runs ``(begin, anchor, hash)`` that share an anchor.

    A window's anchor is the leftmost of its strings of some bytes with the smallest hash, so equal
    windows have theirs at the same place, and a window can only be repeated where its anchor
    is. The last run ends with the last window. ``data`` holds one window at least.
    """
    gram = min(GRAM, length // 2)
    hashes = _gram_hashes(data, gram)
    width = length - gram + 1
    keyed = (hashes & ~_PLACE) | np.arange(hashes.size, dtype=np.uint64)
    rows = -(-hashes.size // width)
    table = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    table[: hashes.size] = keyed
    table = table.reshape(rows, width)
    ahead = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(table, axis=1).ravel()
    windows = hashes.size - width + 1
    place = (np.minimum(ahead[:windows], behind[width - 1 : width - 1 + windows]) & _PLACE).astype(np.int64)
    begin = np.flatnonzero(np.diff(place, prepend=-1))
    return begin, place[begin], hashes[place[begin]].view(np.int64)


def _blocks(text: str, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A text's bytes in blocks that together have each window once, with their offsets."""
    data = np.frombuffer(text.encode(), np.uint8)
    for start in range(0, data.size - length + 1, _BLOCK):
        yield start, data[start : start + _BLOCK + length - 1]


def _anchor_rows(length: int):
    """``h, n, k1, k2``: the anchors of each document and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            out: list[list[np.ndarray]] = [[], [], [], []]
            for i, text in enumerate(batch.column("text")):
                found = [anchors(data, length)[2] for _, data in _blocks(text.as_py(), length)]
                if not found:
                    continue
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                for column, value in zip(
                    out, (values, counts, np.full(values.size, k1[i]), np.full(values.size, k2[i])), strict=True
                ):
                    column.append(value)
            columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
            yield pa.RecordBatch.from_arrays(columns, ["h", "n", "k1", "k2"])

    return run


_SEGMENTS = "h long, g1 long, g2 long, k1 long, k2 long, begin long, windows int, anchor int, data binary"
_SEGMENT_KINDS = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()]


def _segment_rows(length: int):
    """The runs of windows whose anchors occur elsewhere, with the bytes of each distinct one."""
    names = [c.split()[0] for c in _SEGMENTS.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, _SEGMENT_KINDS, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            rows, size = [], 0
            k1, k2 = (batch.column(c).to_pylist() for c in ("k1", "k2"))
            for i, (text, shared) in enumerate(zip(batch.column("text"), batch.column("shared"), strict=True)):
                known = np.array(shared.as_py(), np.int64)
                for offset, data in _blocks(text.as_py(), length):
                    begin, place, hashes = anchors(data, length)
                    end = np.append(begin[1:], data.size - length + 1)
                    raw = data.tobytes()
                    for r in np.flatnonzero(np.isin(hashes, known)):
                        first, last, h = int(begin[r]), int(end[r]), int(hashes[r])
                        piece = raw[first : last + length - 1]
                        digest = hashlib.blake2b(piece, digest_size=16).digest()
                        g1, g2 = (int.from_bytes(digest[j : j + 8], "little", signed=True) for j in (0, 8))
                        new = (h, g1, g2) not in seen
                        if new:
                            if len(seen) >= MEMO:
                                seen.clear()
                            seen.add((h, g1, g2))
                            size += len(piece)
                        rows.append(
                            (h, g1, g2, k1[i], k2[i], offset + first, last - first, int(place[r]) - first)
                            + (piece if new else None,)
                        )
                    if size > 8 << 20 or len(rows) > 100_000:
                        yield made(rows)
                        rows, size = [], 0
            yield made(rows)

    return run


_ORDERED = "h long, g1 long, g2 long, runs array<int>, bucket long, packed binary"
_PACKED = np.dtype([("w1", "<u8"), ("w2", "<u8"), ("g1", "<i8"), ("g2", "<i8"), ("at", "<i4")])


def _runs(marks: np.ndarray) -> list[int]:
    """Begin and length of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return np.stack([edges[::2], edges[1::2] - edges[::2]], 1).ravel().tolist()


def _ordered_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int32()), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _ORDERED.split(", ")]
    )


def _order(length: int):
    """Orders the windows of the segments of an anchor; rows come sorted by anchor and salt."""

    def ordered(groups: list[list[dict]]) -> list[tuple]:
        segments = [(number, s) for number, group in enumerate(groups) for s in group]
        data = np.frombuffer(b"".join(s["data"] for _, s in segments), np.uint8)
        sizes = np.array([s["windows"] for _, s in segments], np.int64)
        offsets = np.cumsum([0] + [len(s["data"]) for _, s in segments][:-1])
        owner = np.repeat(np.arange(len(segments)), sizes)
        firsts = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) - firsts[owner]
        # Equal windows lie alike to their anchor.
        lie = at - np.array([s["anchor"] for _, s in segments], np.int64)[owner]
        group_of = np.array([number for number, _ in segments], np.int64)[owner]
        same = equal_windows(data, offsets[owner] + at, group_of * (1 << 32) + lie + (1 << 21), length)
        several = np.bincount(same)[same] > 1
        rows: list[tuple] = []
        for (_, s), first, size in zip(segments, firsts, sizes, strict=True):
            marks = several[first : first + size]
            if s["copies"] == 1 and marks.any():
                rows.append((s["h"], s["g1"], s["g2"], _runs(marks), None, None))
        # Windows of an anchor that other tasks order too go on, once for each distinct one.
        buckets = np.array([s["buckets"] if s["salts"] > 1 else 0 for _, s in segments], np.int64)[owner]
        passed = np.flatnonzero(buckets > 0)
        if passed.size:
            passed = passed[np.unique(same[passed], return_index=True)[1]]
            answered = several | np.array([s["copies"] > 1 for _, s in segments])[owner]
            packed = np.empty(passed.size, _PACKED)
            raw = data.tobytes()
            for k, w in enumerate(passed):
                start = int(offsets[owner[w]] + at[w])
                digest = hashlib.blake2b(raw[start : start + length], digest_size=16).digest()
                s = segments[owner[w]][1]
                packed[k] = (*np.frombuffer(digest, "<u8"), s["g1"], s["g2"], -1 if answered[w] else at[w])
            anchor = np.array([s["h"] for _, s in segments], np.int64)[owner[passed]]
            bucket = (packed["w1"] % buckets[passed].astype(np.uint64)).astype(np.int64)
            turn = np.lexsort((bucket, anchor))
            cuts = np.flatnonzero((np.diff(anchor[turn]) != 0) | (np.diff(bucket[turn]) != 0)) + 1
            for part in np.split(turn, cuts):
                own = int(anchor[part[0]]), None, None, None, int(bucket[part[0]])
                for i in range(0, part.size, PACKED_WINDOWS):
                    rows.append((*own, packed[part[i : i + PACKED_WINDOWS]].tobytes()))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[dict]] = []
        windows, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["h"], row["salt"])
                if key != last:
                    if windows > CALL_WINDOWS:
                        yield _ordered_batch(ordered(groups))
                        groups, windows = [], 0
                    groups.append([])
                    last = key
                groups[-1].append(row)
                windows += row["windows"]
        yield _ordered_batch(ordered(groups) if groups else [])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that two tasks have reported; rows come sorted by anchor and bucket."""

    def met(rows: list[dict]) -> list[tuple]:
        found = np.concatenate([np.frombuffer(r["packed"], _PACKED) for r in rows])
        found = found[np.lexsort((found["w2"], found["w1"]))]
        new = np.ones(found.size, bool)
        new[1:] = (found["w1"][1:] != found["w1"][:-1]) | (found["w2"][1:] != found["w2"][:-1])
        group = np.cumsum(new) - 1
        hit = found[(np.bincount(group)[group] > 1) & (found["at"] >= 0)]
        hit = hit[np.lexsort((hit["at"], hit["g2"], hit["g1"]))]
        cuts = np.flatnonzero((np.diff(hit["g1"]) != 0) | (np.diff(hit["g2"]) != 0)) + 1
        out = []
        for part in np.split(hit, cuts) if hit.size else []:
            marks = np.zeros(int(part["at"].max()) + 1, bool)
            marks[part["at"]] = True
            out.append((rows[0]["h"], int(part["g1"][0]), int(part["g2"][0]), _runs(marks), None, None))
        return out

    held: list[dict] = []
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            if held and (held[0]["h"], held[0]["bucket"]) != (row["h"], row["bucket"]):
                out += met(held)
                held = []
            held.append(row)
        yield _ordered_batch(out)
    yield _ordered_batch(met(held) if held else [])


def repeated_starts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k1, k2, begin, runs``: where repeated strings of ``length`` bytes start, by document key.

    ``runs`` has begin and length of runs of starts, relative to ``begin``. Anchors thin the windows out
    first: only runs of windows whose anchor occurs twice are kept, with their bytes. Equal
    runs are counted; only anchors that have different runs need their windows ordered. An anchor with very many
    different runs is dealt to several tasks, which pass the digest of each distinct window on.
    """
    texts = documents.select(*document_key("doc_id", "text"), text_of().alias("text"))
    rows = in_arrow(texts, _anchor_rows(length), "h long, n long, k1 long, k2 long")
    rows = saved(rows, "anchors")
    shared = rows.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    shared = rows.join(shared, "h", "left_semi").select("k1", "k2", "h").distinct()
    shared = shared.groupBy("k1", "k2").agg(F.collect_list("h").alias("shared"))
    segments = saved(in_arrow(texts.join(shared, ["k1", "k2"]), _segment_rows(length), _SEGMENTS), "segments")

    own = ["h", "g1", "g2"]
    counts = saved(segments.groupBy(*own).agg(F.count("*").alias("copies")), "segment_counts")
    kinds = counts.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    mixed_anchors = (
        counts.join(kinds, "h")
        .withColumn("salts", F.ceil(F.col("kinds") / SALT_SEGMENTS))
        .withColumn("buckets", F.ceil(F.col("kinds") / BUCKET_SEGMENTS))
        .withColumn("salt", F.pmod("g1", "salts"))
        .drop("kinds")
    )
    pieces = segments.filter("data IS NOT NULL").select(*own, "windows", "anchor", "data").dropDuplicates(own)
    pieces = pieces.join(mixed_anchors, own).repartition("h", "salt").sortWithinPartitions("h", "salt")
    ordered = saved(in_arrow(pieces, _order(length), _ORDERED), "ordered_windows")
    passed = ordered.filter("bucket IS NOT NULL").select("h", "bucket", "packed")
    passed = passed.repartition("h", "bucket").sortWithinPartitions("h", "bucket")
    passed = in_arrow(passed, _meet, _ORDERED)
    partly = ordered.filter("bucket IS NULL").unionByName(passed).select(*own, "runs")

    # Runs that occur twice as a whole repeat in all their windows, others in those that were found.
    whole = counts.filter("copies > 1").select(*own, F.lit(None).cast("array<int>").alias("runs"))
    places = segments.select(*own, "k1", "k2", "begin", "windows").join(whole.unionByName(partly), own)
    return places.select("k1", "k2", "begin", F.coalesce("runs", F.array(F.lit(0), "windows")).alias("runs"))


def covered(found: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal spans of bytes that the strings starting at the given places cover."""
    spans = sorted(
        (f["begin"] + f["runs"][i], f["begin"] + f["runs"][i] + f["runs"][i + 1] - 1 + length)
        for f in found
        for i in range(0, len(f["runs"]), 2)
    )
    result: list[tuple[int, int]] = []
    for start, end in spans:
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``row`` (its columns), ``spans`` (start and end of removed bytes), ``kept`` (bytes).

    A byte goes if any string of ``length`` bytes that covers it also starts at another place,
    in this document or another one; all strings are those of the input, and of its copies no
    string is spared. Texts are UTF-8 bytes, so ``kept`` may begin or end inside a
    character. NULL texts are empty; texts below ``length`` bytes stay; rows that
    repeat a document are copies of it.
    """
    found = repeated_starts(documents, length).groupBy("k1", "k2")
    found = found.agg(F.collect_list(F.struct("begin", "runs")).alias("found"))
    rows = documents.select(
        *document_key("doc_id", "text"), text_of().alias("text"), F.struct(*documents.columns).alias("row")
    )
    rows = rows.join(found, ["k1", "k2"], "left").select("row", "text", "found")
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([rows.schema["row"], StructField("spans", ArrayType(span)), StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for text, starts in zip(batch.column("text"), batch.column("found"), strict=True):
                data = text.as_py().encode()
                own = covered(starts.as_py() or [], length)
                edges = [0, *(edge for pair in own for edge in pair), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in own])
            columns = [batch.column("row"), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "spans", "kept"])

    return in_arrow(rows, run, schema)
