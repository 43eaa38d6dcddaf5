"""Benchmark decontamination: windows of canonical templates joined by hash, then slots compared."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.llm.common import document_key, narrow, saved, text_of

_NAME, _NUMBER, _UNIT = "⟨name⟩", "⟨number⟩", "⟨unit⟩"
#: Units that may follow a number.
UNITS = (
    *("mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "ms", "s", "min", "h", "mph", "kmh"),
    *("inch", "inches", "feet", "miles", "pounds", "ounces", "dollars", "euros", "cents", "percent"),
    *("seconds", "minutes", "hours", "days", "weeks", "months", "years", "meters", "metres", "kilometers", "liters"),
)
_SPACE = r"[\s\x{85}\p{Z}]+"
#: A capitalised word that doesn't begin a sentence; the mark put before it makes it a name.
_NAMED = r"(?<=[\p{L}\p{N},;] [\p{Ps}\p{Pi}\"'`]{0,3})(?=\p{Lu}\p{Ll})"
_CAPITALISED = r"^⟨?\p{Lu}\p{Ll}"
#: Readings of a text: no names, those that don't begin a sentence, all capitalised words.
PLAIN, INNER, EVERY = READINGS = ("plain", "inner", "every")
_TOKEN = r"⟨?\p{L}[\p{L}\p{M}\p{N}]*|\p{N}+(?:[.,:/]\p{N}+)*"


@dataclass(frozen=True)
class Match:
    """``window`` words make a window; ``least_words`` in the same alignment make a leak.

    Items shorter than either have to match as a whole.
    """

    window: int = 8
    least_words: int = 13


def tokens_of(text: Column, marked: bool = True) -> Column:
    """Words and numbers of a text; names that don't begin a sentence carry a mark, unless nobody asks for it."""
    spaced = F.regexp_replace(text, _SPACE, " ")
    named = F.regexp_replace(spaced, _NAMED, "⟨") if marked else spaced
    return F.regexp_extract_all(named, F.lit(_TOKEN), F.lit(0))


def template_of(tokens: Column) -> Column:
    """Tokens with numbers and units behind numbers as placeholders, others in lower case."""

    def canonical(token: Column, at: Column) -> Column:
        word = F.lower(F.ltrim(token, F.lit("⟨")))
        is_unit = word.isin(*UNITS) & F.coalesce(F.get(tokens, at - 1).rlike(r"^\p{N}"), F.lit(False))
        return F.when(token.rlike(r"^\p{N}"), _NUMBER).when(is_unit, _UNIT).otherwise(word)

    return F.transform(tokens, canonical)


def _named(tokens: Column, plain: Column, every: bool) -> Column:
    """A template with the marked, or all capitalised, words as placeholders too."""

    def canonical(token: Column, word: Column) -> Column:
        is_name = token.rlike(_CAPITALISED) if every else token.startswith("⟨")
        return F.when(is_name, _NAME).otherwise(word)

    return F.zip_with(tokens, plain, canonical)


def _starts(size: Column, length: int) -> Column:
    """Starts of all windows; none in shorter texts."""
    none = F.array().cast("array<int>")
    return F.when(size >= length, F.sequence(F.lit(1), size - (length - 1))).otherwise(none)


def _slice(array: Column, start: Column, length: int) -> list[Column]:
    # Inside a lambda, slice() copies the whole array for each window; get() doesn't.
    return [F.get(array, start + (j - 1)) for j in range(length)]


def _slots(tokens: Column, template: Column, start: Column, length: int) -> Column:
    """The values at the placeholders of a window, in order."""
    values, kinds = _slice(tokens, start, length), _slice(template, start, length)
    pairs = F.array(*[F.struct(v.alias("value"), k.alias("kind")) for v, k in zip(values, kinds, strict=True)])
    return F.transform(F.filter(pairs, lambda p: p["kind"].isin(_NAME, _NUMBER, _UNIT)), lambda p: F.lower(F.ltrim(p["value"], F.lit("⟨"))))


def _windows(frame: DataFrame, length: int, *keep: str, starts: Column | None = None) -> DataFrame:
    """Rows of ``keep, at, words, hash, slots`` for each window, or those at ``starts``, of a frame with tokens and template."""
    tokens, template = F.col("tokens"), F.col("template")
    window = lambda start: F.struct(
        start.alias("at"),
        F.array(*_slice(template, start, length)).alias("words"),
        F.xxhash64(*[F.xxhash64(w) for w in _slice(template, start, length)]).alias("hash"),
        _slots(tokens, template, start, length).alias("slots"),
    )
    at = _starts(F.size("template"), length) if starts is None else starts
    return frame.select(*keep, F.inline(F.transform(at, window)))


def _canonical(frame: DataFrame, *keep: str, readings: tuple[str, ...] = READINGS) -> DataFrame:
    """``keep, tokens`` and a template for each reading; the plain one is always there."""
    tokens = frame.select(*keep, tokens_of(text_of(), INNER in readings).alias("tokens"))
    plain = tokens.withColumn(PLAIN, template_of(F.col("tokens")))
    return plain.select("*", *[_named(F.col("tokens"), F.col(PLAIN), r == EVERY).alias(r) for r in readings if r != PLAIN])


def _readings(canonical: DataFrame, *keep: str, readings: tuple[str, ...] = READINGS) -> DataFrame:
    """``keep, tokens, reading, template``, a row for each reading."""
    each = F.array(*[F.struct(F.lit(r).alias("reading"), F.col(r).alias("template")) for r in readings])
    return canonical.select(*keep, "tokens", F.inline(each))


def _item_readings(canonical: DataFrame) -> DataFrame:
    """Readings of the items; one with names adds nothing to an item without.

    Where all words but numbers would be names, nothing is left to tell the item by.
    """
    rows = _readings(canonical, "item_id", PLAIN)
    literal = F.exists("template", lambda w: ~w.isin(_NAME, _NUMBER, _UNIT))
    named = F.col("template") != F.col(PLAIN)
    wanted = F.when(F.col("reading") == EVERY, named & literal).when(F.col("reading") == INNER, named).otherwise(True)
    return rows.filter(wanted & (F.size("template") > 0)).drop(PLAIN)


def _hashed_words(frame: DataFrame, readings: tuple[str, ...], *keep: str) -> DataFrame:
    """Each reading as the hashes of its words, so that a word is hashed once for all windows that hold it."""
    return frame.select(*keep, *[F.transform(r, lambda w: F.xxhash64(w)).alias(r) for r in readings])


def _window_hashes(frame: DataFrame, words: str, length: int, found: str) -> DataFrame:
    """Adds ``found``: the hashes of all windows of the hashed words.

    The hash of a window is that of its halves, and so on, so that it takes few steps for a window of many words. Each step is
    a projection of its own, as it uses the one before twice.
    """

    def joined(one: str, two: str, width: int) -> Column:
        behind = F.slice(two, width + 1, F.size(two))
        return F.zip_with(one, behind, lambda x, y: F.xxhash64(x, y))

    frame, width = frame.withColumn(found, F.col(words)), 1
    for bit in bin(length)[3:]:
        frame, width = frame.withColumn(found, joined(found, found, width)), 2 * width
        if bit == "1":
            frame, width = frame.withColumn(found, joined(found, words, width)), width + 1
    # The last ones reach beyond the end.
    return frame.withColumn(found, F.slice(found, 1, F.greatest(F.size(words) - (length - 1), F.lit(0))))


def _hits(hashed: DataFrame, hashes: DataFrame, readings: tuple[str, ...], length: int) -> DataFrame:
    """``k1, k2, reading, length, at``: windows of documents whose hash is one of the benchmark's, in any reading."""
    names = [f"{r}_windows" for r in readings]
    for reading, name in zip(readings, names, strict=True):
        hashed = _window_hashes(hashed, reading, length, name)
    rows = hashed.select("k1", "k2", F.size(names[0]).alias("n"), F.posexplode(F.concat(*names)).alias("pos", "hash"))
    # All readings of a document have as many windows.
    rows = rows.join(hashes, "hash", "left_semi")
    reading = F.element_at(F.array(*[F.lit(r) for r in readings]), F.floor(F.col("pos") / F.col("n")).cast("int") + 1)
    return rows.select("k1", "k2", reading.alias("reading"), F.lit(length).alias("length"), (F.col("pos") % F.col("n") + 1).alias("at"))


def leaks(documents: DataFrame, benchmark: DataFrame, match: Match = Match()) -> DataFrame:
    """``doc_id, k1, k2, item_id, at, windows, of_windows, same_values`` for each item a document holds.

    Numbers, names and units become typed placeholders. A text is read three times: without names,
    with the capitalised words that don't begin a sentence as names, and with all
    capitalised words as names; an item is found if one reading of it is. White space counts as one
    space. Windows of a document meet equal
    template windows of the benchmark by an equality join; those in the same alignment (equal
    distance of their starts) have to cover ``least_words`` words, or the whole of a shorter item, and
    every value of the item has to stand for one value of the document throughout.
    ``same_values`` tells a verbatim copy from a re-parameterised one. An item is reported
    once for a document, with its longest alignment.

    NULL texts and items without words have no windows; rows that repeat a document or an
    item count once. Extra columns are ignored.
    """
    docs = documents.select("doc_id", "text").select("doc_id", "text", *document_key("doc_id", "text"))
    items = _item_readings(_canonical(benchmark.select("item_id", "text").distinct(), "item_id"))
    items = items.withColumn("length", F.least(F.size("template"), F.lit(match.window)))
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most match.window
    parts = [_windows(items.filter(F.col("length") == n), n, "item_id", "reading", "template") for n in lengths]
    if not parts:
        parts = [_windows(items, match.window, "item_id", "reading", "template")]
        lengths = [match.window]
    known = parts[0].withColumn("length", F.lit(lengths[0]))
    for part, n in zip(parts[1:], lengths[1:], strict=True):
        known = known.unionByName(part.withColumn("length", F.lit(n)))
    known = saved(
        known.select(
            "item_id",
            "reading",
            F.size("template").alias("item_words"),
            F.col("at").alias("item_at"),
            F.col("words").alias("item_window"),
            F.col("slots").alias("item_slots"),
            "length",
            F.col("hash"),
        ),
        "benchmark_windows",
    )

    # Readings in which the benchmark has no item can't be found.
    present = {r["reading"] for r in known.select("reading").distinct().collect()}
    readings = tuple(r for r in READINGS if r in present or r == PLAIN)

    # First only hashes: which windows of documents are windows of the benchmark at all?
    hashed = _hashed_words(_canonical(docs, "k1", "k2", readings=readings), readings, "k1", "k2")
    hits = None
    for n in lengths:
        theirs = _hashed_words(items.filter(F.col("length") == n), ("template",))
        theirs = _window_hashes(theirs, "template", n, "hash").select(F.explode("hash").alias("hash")).distinct()
        own = _hits(hashed, narrow(saved(theirs, "benchmark_hashes")), readings, n)
        hits = own if hits is None else hits.unionByName(own)
    hits = hits.groupBy("k1", "k2", "reading", "length").agg(F.collect_set("at").alias("starts"))
    hits = saved(hits, "touched_windows")
    touched = saved(hits.select("k1", "k2").distinct(), "touched_documents")

    # Then these windows with their words and values.
    keys = ("doc_id", "k1", "k2")
    chosen = _canonical(docs.join(touched, ["k1", "k2"], "left_semi"), *keys, readings=readings)
    chosen = _readings(chosen, *keys, readings=readings).join(hits, ["k1", "k2", "reading"])
    found = None
    for n in lengths:
        own = _windows(chosen.filter(F.col("length") == n), n, *keys, "reading", starts=F.col("starts"))
        own = own.join(known.filter(F.col("length") == n), ["reading", "hash"]).filter(F.col("words") == F.col("item_window"))
        found = own if found is None else found.unionByName(own)
    pairs = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    # What stands for a value where names are known also has to hold where they aren't.
    inner = F.array(F.lit(INNER), F.lit(PLAIN))
    judged = F.explode(F.when(F.col("reading") == INNER, inner).otherwise(F.array("reading"))).alias("judged")
    own = F.col("reading") == F.col("judged")
    aligned = (
        found.select("*", judged)
        .withColumn("shift", F.col("at") - F.col("item_at"))
        .groupBy(*keys, "item_id", "shift", "item_words", "length", "judged")
        .agg(
            F.count_distinct(F.when(own, F.col("item_at"))).alias("windows"),
            F.min(F.when(own, F.col("at"))).alias("at"),
            # As long as the item, not as the document: one alignment has each window once.
            F.array_distinct(F.flatten(F.collect_set(pairs))).alias("values"),
        )
    )
    of_windows = F.col("item_words") - F.col("length") + 1
    wanted = F.least(of_windows, F.greatest(F.lit(1), F.lit(match.least_words) - F.col("length") + 1))
    one_to_one = F.size(F.array_distinct(F.transform("values", lambda v: v["item"]))) == F.size("values")
    same = F.forall("values", lambda v: v["item"] == v["doc"]).alias("same_values")
    longest = F.struct("windows", (-F.col("at")).alias("at"), same)
    best = (
        aligned.filter((F.col("windows") >= wanted) & one_to_one)
        .withColumn("of_windows", of_windows)
        .groupBy("doc_id", "k1", "k2", "item_id", "of_windows")
        .agg(F.max(longest).alias("best"))
    )
    return best.select(
        "doc_id",
        "k1",
        "k2",
        "item_id",
        (-F.col("best.at")).cast("long").alias("at"),
        F.col("best.windows").alias("windows"),
        F.col("of_windows").cast("long").alias("of_windows"),
        "best.same_values",
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, match: Match = Match()) -> DataFrame:
    """The documents without a leak, with all their columns."""
    bad = leaks(documents, benchmark, match).select("k1", "k2").distinct()
    rows = documents.select(F.struct(*documents.columns).alias("row"), *document_key("doc_id", "text"))
    return rows.join(bad, ["k1", "k2"], "left_anti").select("row.*")
