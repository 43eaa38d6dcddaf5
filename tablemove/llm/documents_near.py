"""Near-duplicate documents by ProbMinHash over weighted word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.llm.common import in_arrow, narrow, saved, text_of
from tablemove.llm.near import Similarity, near_classes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Word hashes and item ids that a task remembers.
MEMO = 200_000


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads its input evenly."""
    values = values ^ (values >> np.uint64(30))
    values *= _MIX[0]
    values ^= values >> np.uint64(27)
    values *= _MIX[1]
    values ^= values >> np.uint64(31)
    return values


@dataclass(frozen=True)
class Near:
    """``bands`` of ``rows`` registers: at Jaccard 0.8 of the distinct shingles, all but about 0.0002 of
    the pairs share a band, however often a shingle is repeated."""

    words: int = 5
    percent: int = 80
    bands: int = 16
    rows: int = 4

    @property
    def registers(self) -> int:
        return self.bands * self.rows


class Shingler:
    """Hashes of a text's shingles of some words, with a memory of word hashes."""

    def __init__(self, words: int):
        self.words = words
        self.memo: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """In order and with repetitions. A shorter text is one shingle, a text without words none."""
        tokens = text.encode().split()
        if not tokens:
            return np.empty(0, np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        known = []
        for token in tokens:
            value = memo.get(token)
            if value is None:
                value = memo[token] = xxhash.xxh64_intdigest(token)
            known.append(value)
        values = np.array(known, np.uint64)
        width = min(self.words, values.size)
        total = np.zeros(values.size - width + 1, np.uint64)
        for i in range(width):
            total = mixed(total + _ODD) ^ values[i : values.size - width + 1 + i]
        return mixed(total)


def features(texts: list[str], words: int) -> list[np.ndarray]:
    shingler = Shingler(words)
    return [shingler.hashes(t) for t in texts]


def prob_minhash(items: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """The item that each register keeps.

    Every item is a Poisson process whose rate is its weight: its arrivals, at times that only the item
    and the number of the arrival decide, fall into registers at random, and a register keeps the
    item that arrives first. Two texts keep the same item with the probability
    Jaccard similarity of their weights. All items go on to their next arrival together,
    and an item stops once it is later than the latest register.
    """
    times = np.full(registers, np.inf)
    kept = np.zeros(registers, np.uint64)
    active, scale, now = items, 1.0 / weights, np.zeros(items.size)
    number = np.zeros(1, np.uint64)
    while active.size:
        number += _ODD
        draw = mixed(active + number)
        now = now - scale * np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        place = (mixed(draw + _ODD) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(times, place, now)
        first = now == times[place]
        kept[place[first]] = active[first]
        alive = now < times.max()
        active, scale, now = active[alive], scale[alive], now[alive]
    return kept


def band_hashes(kept: np.ndarray, near: Near) -> np.ndarray:
    table = kept.reshape(near.bands, near.rows)
    total = np.arange(1, near.bands + 1, dtype=np.uint64) * _ODD
    for i in range(near.rows):
        total = mixed(total + _ODD) ^ table[:, i]
    return mixed(total).view(np.int64)


def text_bands(hashes: np.ndarray, near: Near) -> np.ndarray:
    """Bands of a text's shingles by equal weights, and by one and the logarithm of their counts.

    Links are defined on distinct shingles, so that equal weights decide which pairs are surely looked
    at. Without repetitions both are the same; then there is one set of bands, which meets both.
    """
    items, counts = np.unique(hashes, return_counts=True)
    weights = [np.ones(items.size)]
    if counts.max() > 1:
        weights.append(1.0 + np.log(counts))
    return np.concatenate([band_hashes(prob_minhash(items, w, near.registers), near) for w in weights])


def _bands(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(near.words), set()
        for batch in batches:
            texts = batch.column("text")
            out_ids, out_bands = [], [np.empty(0, np.int64)]
            for i, node in enumerate(batch.column("id").to_pylist()):
                if node in seen:  # copies inside a task need no second signature
                    continue
                if len(seen) >= MEMO:
                    seen.clear()
                seen.add(node)
                hashes = shingler.hashes(texts[i].as_py())
                if not hashes.size:
                    continue
                found = text_bands(hashes, near)
                out_bands.append(found)
                out_ids += [node] * found.size
            columns = [pa.array(np.concatenate(out_bands)), pa.array(out_ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "id"])

    return run


def _text_id() -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text_of().cast("binary"))).alias("id")


def _identified(documents: DataFrame) -> DataFrame:
    return documents.select(_text_id(), text_of().alias("text"))


def classes(documents: DataFrame, near: Near = Near()) -> DataFrame:
    """``node, root`` for ids of texts that are close to another text; ids are 128 bits of the text."""
    bands = in_arrow(_identified(documents), _bands(near), "bucket long, id binary")

    def texts(ids: DataFrame) -> DataFrame:
        found = _identified(documents).join(narrow(ids), "id", "left_semi")
        return found.groupBy("id").agg(F.any_value("text").alias("text"))

    return near_classes(bands, texts, Similarity(partial(features, words=near.words), near.percent))


def duplicate_classes(documents: DataFrame, near: Near = Near()) -> DataFrame:
    """Per row: ``doc_id, class_id, class_size``, the class being its smallest ``doc_id``.

    Documents are in one class if their texts are equal, or linked by a chain of texts of which
    each two neighbours share ``percent`` of their distinct shingles of ``words`` words. Weights (all one, and
    one and the logarithm of a shingle's count) only steer which pairs are looked at. NULL is the
    empty text; texts without words are close to nothing but equal ones; NULL ids are larger
    than others; repeated rows are documents of their own.
    """
    found = classes(documents, near).withColumnRenamed("node", "id")
    named = documents.select("doc_id", _text_id()).join(found, "id", "left")
    named = saved(named.select("doc_id", F.coalesce("root", "id").alias("root")), "document_classes")
    sizes = named.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return named.join(sizes, "root").select("doc_id", "class_id", "class_size")


def keep_one(documents: DataFrame, near: Near = Near()) -> DataFrame:
    """One document of each class, with all its columns: that with the smallest id, then text.

    Only narrow rows are compared; of rows that repeat a document one is kept.
    """
    found = classes(documents, near).withColumnRenamed("node", "id")
    named = documents.select("doc_id", _text_id()).distinct().join(found, "id", "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "id")
    best = named.groupBy(F.coalesce("root", "id").alias("root")).agg(F.min(order).alias("best"))
    best = best.select(F.col("best.doc_id").alias("best_doc"), F.col("best.id").alias("best_id"))
    rows = documents.select("doc_id", _text_id(), F.struct(*documents.columns).alias("row"))
    rows = rows.join(best, (F.col("id") == F.col("best_id")) & F.col("doc_id").eqNullSafe(F.col("best_doc")), "left_semi")
    first = rows.groupBy("id", "doc_id").agg(F.any_value("row").alias("row"))
    return first.select("row.*")
