"""Scans for secrets: fixed patterns, and a conditional random field for what they miss."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablemove.llm.common import in_arrow, text_of
from tablemove.llm.crf import B, Field, I, O, fit

# The base patterns. Letters of the first are in either case, ASCII ones only; a match
# has to have as many characters as stated, group 2 of the first and the whole of the others.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24

# A match of at least so many characters is the whole of a run, so that the others need not be looked at.
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_CHARS - 4))
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_CHARS)

#: A word, with signs inside that secrets and paths have, or a sign.
TOKEN = re.compile(r"\w(?:[\w+/.-]*\w)?|[^\w\s]")
_PARTS = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s")
#: Characters of a text that are tagged at a time; longer ones go on where tags are sure to be O.
SLICE = 200_000
#: Tokens that a task remembers.
MEMO = 200_000
#: Tokens before and after a token that its score depends on.
LEFT, RIGHT = 3, 1
_EDGE = "\x00"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Training:
    """The field is fitted on windows of ``texts`` texts, those with the smallest hashes, and on ``lines`` made ones.

    A window has ``window`` tokens; a text has one, or up to ``hits`` around what the base patterns find.
    Tokens are cut to ``chars`` characters for it. What the patterns find, and what was made, is tagged as secret.
    """

    texts: int = 600
    lines: int = 1500
    window: int = 48
    hits: int = 3
    chars: int = 200
    seed: int = 13


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``start, kind, end, value start`` of what the patterns find, in order; kinds by number."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_CHARS]
    for kind, pattern in ((1, _LONG_ACCESS), (2, _LONG_HEX)):
        found += [(m.start(), kind, m.end(), m.start()) for m in pattern.finditer(text)]
    return sorted(found)


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


_LENGTHS = [_bucket(n, (2, 3, 6, 8, 12, 16, 20, 32, 48)) for n in range(49)]
_KINDS = [("a", frozenset(_LETTERS)), ("A", frozenset(_LETTERS.upper())), ("0", frozenset("0123456789"))]
_KINDS += [(c[0], frozenset(c)) for c in ("_", ".", "/", "+-")]
_HEX_DIGITS = frozenset("0123456789abcdef")


def signature(token: str, known: frozenset[str] | None = None) -> tuple:
    """All that the features of a token are made of, so that few signatures stand for many tokens.

    Its length, kinds of characters, how they mix, how many differ, itself if it is short, and the words of
    letters in it, of which only the ``known`` ones count if given.
    """
    size = len(token)
    if size == 1 and not token.isalnum():
        return (token,)
    letters = set(token)
    kinds = "".join(name for name, of in _KINDS if not letters.isdisjoint(of))
    turns = cases = 0
    if "0" in kinds and kinds != "0":
        turns = _bucket(sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False)), (1, 2, 4, 8))
    if not token.islower() and not token.isdigit():
        pairs = zip(token, token[1:], strict=False)
        cases = _bucket(sum(a.islower() != b.islower() for a, b in pairs if a.isalpha() and b.isalpha()), (1, 2, 4, 8))
    if not token.isascii():
        kinds += "é"
    length = _LENGTHS[min(size, 48)]
    parts = [p for p in _PARTS.findall(token.lower()) if len(p) > 2] if size <= 32 else []
    if known is not None and parts:
        parts = [p for p in parts if p in known]
    is_hex = size >= 8 and turns > 0 and letters <= _HEX_DIGITS
    return (length, kinds, turns, cases, min(4 * len(letters) // size, 3), is_hex, token if size <= 2 else "", *parts)


def views(signed: tuple) -> list[list[str]]:
    """Features of a token for itself, for the three after it, and for the one before it."""
    if len(signed) == 1:
        seen, own = ["kind sign", f"is {signed[0]}"], [f"sign {signed[0]}", "one sign"]
    else:
        length, kinds, turns, cases, differ, is_hex, short, *parts = signed
        seen = [f"kind {'digits' if kinds == '0' else 'word'}", *([f"is {short}"] if short else []), *[f"part {p}" for p in parts]]
        own = [f"length {length}", f"kinds {kinds}", f"kinds {kinds} {length}", f"turns {turns} {length}", f"cases {cases}"]
        own += [f"differ {differ} {length}", *([f"hex {length}"] if is_hex else [])]
    return [
        ["own", *own, *[f"own {f}" for f in seen]],
        *[[f"{-d} {f}" for f in seen] for d in range(1, LEFT + 1)],
        [f"+1 {f}" for f in seen],
    ]


def file_features(text: str, lang: str | None, hits: int) -> list[str]:
    """What holds for a whole text: its language, size, share of signs, and whether the patterns found something."""
    size = max(len(text), 1)
    signs = 1000 * (text.count("=") + text.count(":") + text.count('"')) / size
    return [
        f"file lang {lang}",
        f"file size {_bucket(size, (200, 2_000, 20_000))}",
        f"file signs {_bucket(signs, (0.5, 5, 20))}",
        f"file hits {min(hits, 2)}",
    ]


class Tagger:
    """Finds spans in texts by the field; remembers the scores of tokens within a bound."""

    def __init__(self, field: Field):
        self.field = field
        self.margins = field.margins()
        self.known = frozenset(f.rsplit(" ", 1)[1] for f in field.weights if " part " in f)
        self.memo: dict[str, int] = {}
        self.signed: dict[tuple, int] = {}
        self.scores = np.empty((1024, LEFT + RIGHT + 1, 3))

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        memo, signed = self.memo, self.signed
        if len(memo) > MEMO:
            memo.clear()
        if len(signed) > MEMO:
            memo.clear()
            signed.clear()
        for token in set(tokens).difference(memo):
            mark = signature(token, self.known)
            at = signed.get(mark)
            if at is None:
                at = signed[mark] = len(signed)
                if at == len(self.scores):
                    self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
                self.scores[at] = [self.field.score(v) for v in views(mark)]
            memo[token] = at
        return np.array(list(map(memo.__getitem__, tokens)), np.int64)

    def _scores(self, tokens: list[str], file: np.ndarray) -> np.ndarray:
        """Scores of all tokens but the first three and the last, which are only neighbours."""
        numbers = self._numbers(tokens)
        count = numbers.size - LEFT - RIGHT
        result = np.broadcast_to(file, (count, 3)).copy()
        for view, shift in enumerate((0, -1, -2, -3, 1)):
            result += self.scores[numbers[LEFT + shift : LEFT + shift + count], view]
        return result

    def spans(self, text: str, lang: str | None, hits: int) -> list[tuple[int, int]]:
        file = self.field.score(file_features(text, lang, hits))
        found, position, size, left = [], 0, SLICE, [_EDGE] * LEFT
        while position < len(text):
            end = position + size
            cut = _WHITE.search(text, end) if end < len(text) else None
            end = cut.end() if cut else len(text)
            tokens = TOKEN.findall(text, position, end)
            following = TOKEN.search(text, end)
            scores = self._scores([*left, *tokens, following.group() if following else _EDGE], file)
            sure = (scores[:, :1] - scores[:, 1:] > self.margins).all(1)
            # Between tokens that are O in any case, the rest is decoded on its own, exactly.
            stop = len(tokens)
            if end < len(text):
                last = np.flatnonzero(sure)
                if not last.size:
                    size *= 2
                    continue
                stop = int(last[-1]) + 1
            places = None
            if not sure[:stop].all():
                places = [m.span() for m in TOKEN.finditer(text, position, end)]
                found += self._decoded(scores[:stop], sure[:stop], places)
            if end == len(text):
                break
            if stop < len(tokens):
                places = places or [m.span() for m in TOKEN.finditer(text, position, end)]
                position = places[stop][0]
            else:
                position = end
            left, size = [*left, *tokens[:stop]][-LEFT:], SLICE
        return found

    def _decoded(self, scores: np.ndarray, sure: np.ndarray, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
        edges = np.flatnonzero(np.diff(np.concatenate([[True], sure, [True]]).astype(np.int8)))
        found: list[tuple[int, int]] = []
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            tags = self.field.best(scores[low:high], closed=high < len(sure))
            previous = O
            for i, tag in enumerate(tags, low):
                if tag == B or (tag == I and previous == O):
                    found.append(places[i])
                elif tag == I:
                    found[-1] = (found[-1][0], places[i][1])
                previous = tag
        return found


def _windows(batches: Iterator[pa.RecordBatch], training: Training) -> Iterator[pa.RecordBatch]:
    """Tokens, tags and features of the file, for windows of the sampled texts."""
    for batch in batches:
        rows = []
        for text, lang, mark in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "mark")), strict=True):
            spans = base_spans(text)
            places = [m.span() for m in TOKEN.finditer(text)]
            if not places:
                continue
            tags, starts = [O] * len(places), np.array([p[0] for p in places])
            for _, _, end, value in spans:
                low, high = np.searchsorted(starts, value), np.searchsorted(starts, end)
                for i in range(low, high):
                    tags[i] = B if i == low else I
            middles = [int(np.searchsorted(starts, s[3])) for s in spans[: training.hits]] or [abs(mark) % len(places)]
            for middle in middles:
                low = max(0, middle - training.window // 2)
                part = places[low : low + training.window]
                tokens = [text[a:b][: training.chars] for a, b in part]
                before = [text[a:b][: training.chars] for a, b in places[max(0, low - LEFT) : low]]
                rows.append((mark, before, tokens, tags[low : low + len(part)], file_features(text, lang, len(spans))))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        strings = pa.list_(pa.string())
        kinds = [pa.int64(), strings, strings, pa.list_(pa.int32()), strings]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["mark", "before", "tokens", "tags", "file"])


# Names that secrets are given, and names and words that are none.
_NAMES = (
    "password passwd pwd passphrase secret client_secret token access_token auth_token refresh_token api_key apikey "
    "access_key secret_key private_key signing_key auth credential credentials bearer"
).split()
_PLAIN_NAMES = "name title count size version page date color width user email path url host port mode level lang id".split()
_PLAIN_VALUES = "large small true false none default main 2024 1.2.3 10:30 12345678 8080 localhost utf 100% v2".split()


def made_lines(count: int, seed: int) -> list[tuple[list[str], list[int]]]:
    """Tokens and tags of lines as configuration and code hold them, half of them with a secret."""
    rng = random.Random(seed)
    alphabets = ["0123456789abcdef", _LETTERS + _LETTERS.upper() + "0123456789", _LETTERS + "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]

    def prose(most: int) -> str:
        words = ["".join(rng.choice(_LETTERS) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, most))]
        if words and rng.random() < 0.4:
            words[rng.randrange(len(words))] = str(rng.randrange(10 ** rng.randint(1, 14)))
        return " ".join(words)

    def value() -> str:
        kind = rng.random()
        if kind < 0.1:
            return "AKIA" + "".join(rng.choice(alphabets[3]) for _ in range(16))
        text = "".join(rng.choice(rng.choice(alphabets[:1] if kind < 0.5 else alphabets[1:3])) for _ in range(rng.randint(10, 64)))
        if kind > 0.8:
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(1, len(text))
                text = text[:at] + rng.choice("+/-._") + text[at:]
            text += rng.choice(["", "", "=", "=="])
        return text

    lines = []
    for i in range(count):
        secret = i % 2 == 0
        name = rng.choice(_NAMES if secret or rng.random() < 0.3 else _PLAIN_NAMES)
        name = rng.choice([name, name.upper(), name.title(), f"my_{name}"])
        if secret:
            what = value()
        else:
            what = rng.choice([rng.choice(_PLAIN_VALUES), prose(3), str(rng.randrange(10**9)), "www.example.com/a/b", "me@example.com"])
        form = rng.choice(['{0} = "{1}"', "{0}: {1}", "{0}={1}", '"{0}": "{1}"', "{0} => '{1}'", "export {0}={1}", "--{0} {1}", "{0} {1}"])
        if not secret and rng.random() < 0.3:
            form = "{1}"
        before, after = prose(12), prose(12)
        line = form.format(name, _EDGE)
        head, tail = (f"{before} {line}").split(_EDGE)
        tags = [O] * len(TOKEN.findall(head))
        inner = TOKEN.findall(what)
        tags += [(B if j == 0 else I) if secret else O for j in range(len(inner))]
        rest = TOKEN.findall(f"{tail} {after}")
        lines.append(([*TOKEN.findall(head), *inner, *rest], tags + [O] * len(rest)))
    return lines


def _features(before: list[str], tokens: list[str], file: list[str]) -> list[list[str]]:
    seen = [views(signature(t)) for t in [_EDGE] * (LEFT - len(before)) + before + tokens + [_EDGE]]
    return [
        [*seen[i][0], *(f for d in range(1, LEFT + 1) for f in seen[i - d][d]), *seen[i + 1][-1], *file]
        for i in range(LEFT, LEFT + len(tokens))
    ]


def train(documents: DataFrame, training: Training = Training()) -> Field:
    """Fit the field on a bounded sample: only hashes, and windows of the sampled texts, come to the driver.

    Copies of a text count once. An empty table leaves the made lines.
    """
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.select(text_of().alias("text"), lang.alias("lang"), F.xxhash64(text_of()).alias("mark"))
    marks = [r["mark"] for r in texts.select("mark").distinct().orderBy("mark").limit(training.texts).collect()]
    sequences, files = [], [[]]
    if marks:
        chosen = texts.filter(F.col("mark") <= marks[-1]).groupBy("mark").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
        made = in_arrow(
            chosen,
            partial(_windows, training=training),
            "mark long, before array<string>, tokens array<string>, tags array<int>, file array<string>",
        )
        rows = sorted(made.collect())
        files = [r["file"] for r in rows] or files
        sequences = [(_features(r["before"], r["tokens"], r["file"]), r["tags"]) for r in rows]
    for tokens, tags in made_lines(training.lines, training.seed):
        file = files[crc32(" ".join(tokens).encode()) % len(files)]
        sequences.append((_features([], tokens, [f for f in file if "hits" not in f]), tags))
    return fit(sequences)


def _scanned(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    tagger = Tagger(field)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        result = []
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            text = text.as_py()
            base = base_spans(text)
            own = [(start, len(KINDS), end) for start, end in tagger.spans(text, lang, len(base))]
            merged = sorted([*(s[:3] for s in base), *_apart(own, base)])
            result.append([dict(kind=(*KINDS, "crf")[k], start=a, end=b) for a, k, b in merged])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(result, pa.list_(span))], ["row", "spans"])


def _apart(own: list[tuple[int, int, int]], base: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of the field's spans that share no character with one of the patterns."""
    # Both come by start. Starts and furthest ends so far tell whether any pattern's span reaches in.
    kept, at, reach = [], 0, 0
    for start, kind, end in own:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            kept.append((start, kind, end))
    return kept


def scan(documents: DataFrame, field: Field) -> DataFrame:
    """``row`` (all columns of a document) and ``spans`` (kind, start and end in code points) of its secrets.

    Kinds are those of the patterns, leftmost and without overlap within a kind, and ``crf`` for what the field finds
    that none of them touches. Spans come by start, then by kind in the order ``KINDS``, ``crf``. NULL is the
    empty text and has none. Every row is scanned on its own; the whole text is read, in slices.
    """
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), text_of().alias("text"), lang.alias("lang"))
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([rows.schema["row"], StructField("spans", ArrayType(span))])
    return in_arrow(rows, partial(_scanned, field=field), schema)
