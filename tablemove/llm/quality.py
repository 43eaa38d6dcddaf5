"""Quality rules: a ledger of failure bits and measurements, and policies applied to it afterwards."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablemove.llm.common import in_arrow

#: Measurements of a text; each is taken once and stored.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_long_words",
    "longest_word",
)
_SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_LONG_WORD_BYTES = 100


def _code_points(data: bytes) -> int:
    """Code points of valid UTF-8: all bytes but the continuation bytes 0x80 to 0xBF."""
    return len(data.decode("utf-8", "surrogatepass"))


def _repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of ``width`` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + width - max(start, end)
            end = start + width
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text; NULL counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split()]
    sizes = [len(w) for w in words]
    return (
        len(words),
        _code_points(b"".join(words)),
        sum(data.count(s) for s in _SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        sum(size > _LONG_WORD_BYTES for size in sizes),
        max(sizes, default=0),
    )


@dataclass(frozen=True)
class Rule:
    """A rule fails where its condition over the measurements holds; ``bit`` is its place for ever."""

    bit: int
    name: str
    fails: str


#: Bits are never given to another rule, so that old ledgers keep their meaning.
RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule(5, "long_words", "100 * n_long_words > 5 * n_words"),
    Rule(6, "few_lines_many_words", "n_lines <= 1 AND n_words > 2000"),
)
BASE_RULES = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version of the decision: documents that fail any of the named rules are rejected."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {rule.name: rule.bit for rule in RULES}
        return sum(1 << bits[name] for name in self.rules)


POLICIES = {
    "v1": Policy("v1", BASE_RULES),
    "v2": Policy("v2", (*BASE_RULES, "symbols", "duplicate_lines", "word_length", "long_words")),
}
CURRENT = POLICIES["v2"]


def _measured(columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            rows = [measure(texts[i].as_py()) for i in range(len(texts))]
            kept = [batch.column(c) for c in columns]
            values = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*kept, *values], [*columns, *MEASURES])

    return run


def ledger(documents: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns``, the measurements, and ``failures`` with one bit per failed rule.

    Every rule is evaluated once for every document, whatever policies say. ``columns`` are
    carried along; other columns are not read. NULL texts measure as empty ones. A document
    is measured as a whole, and rows are independent, so there is no shuffle.
    """
    source = documents.select(*columns, F.col("text").alias("text"))
    carried = [source.schema[c] for c in columns]
    schema = StructType([*carried, *(StructField(m, LongType()) for m in MEASURES)])
    measured = in_arrow(source, _measured(columns), schema)
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)) for rule in RULES]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured.withColumn("failures", failures.cast("long"))


def accepts(policy: Policy = CURRENT, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that only it rejects.

    From the ledger alone: failure bits are first counted by their combination, so what is
    shuffled is one row per combination and task.
    """
    combined = rows.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(F.count("*").alias("n"))
    named = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in RULES if r.name in policy.rules]
    each = combined.select("mask", "n", F.inline(F.array(*named)))
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.bit_or("mask").alias("seen_with"),
    )


def filter_documents(documents: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that the policy accepts, with all their columns."""
    rows = documents.select("text", F.struct(*documents.columns).alias("row"))
    return ledger(rows, ("row",)).filter(accepts(policy)).select("row.*")
