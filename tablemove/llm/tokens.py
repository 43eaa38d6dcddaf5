"""Token counts: best segmentation into vocabulary pieces, without building the pieces."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tablemove.llm.common import in_arrow

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: How far an unknown character scores below the worst piece, as unigram tokenizers have it.
UNKNOWN_PENALTY = 10.0
#: Words longer than this aren't remembered, and the memory is emptied at so many words.
MEMO_CHARS, MEMO_WORDS = 48, 300_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores. With ``bytes_fallback``, an unknown character costs one piece a byte."""

    pieces: tuple[tuple[str, float], ...]
    bytes_fallback: bool = True


@lru_cache
def load(path: str = VOCABULARY) -> Vocabulary:
    """The pieces of a sentencepiece model file, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    pieces = tuple(
        (model.id_to_piece(i), float(model.get_score(i))) for i in range(model.vocab_size()) if not special(i)
    )
    return Vocabulary(pieces, any(model.is_byte(i) for i in range(model.vocab_size())))


class Counter:
    """Counts pieces of the best path through a text.

    The automaton reports every piece that ends at a position; the best score and the number
    of pieces on its path are carried from position to position. Ties go as in the tokenizer's
    forward pass, which replaces a path only by a better one and tries earlier starts first:
    of equal paths to a position, that with the longest last piece stays. A character without
    a piece of its own may be taken as unknown, at a penalty; runs of unknown characters
    are one piece, or with byte fallback one piece for each of their bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary.pieces if len(piece) == 1}
        self.unknown = min((score for _, score in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.fallback = vocabulary.bytes_fallback
        self.memo: dict[str, tuple[float, int]] = {}
        pieces = [piece for piece, _ in vocabulary.pieces]
        # A text falls apart where no piece can reach across: before a space mark that follows
        # another character, and with byte fallback around line ends.
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        lines = self.fallback and not any("\n" in p for p in pieces)
        pattern = r"\n+| +[^ \n]*|[^ \n]+" if lines else r" +[^ ]*|[^ ]+"
        self.parts: Callable[[str], list[str]] = re.compile(pattern).findall if apart else lambda text: [text]

    def path(self, text: str) -> tuple[float, int]:
        """Score and pieces of the best path; ``text`` has space marks for spaces."""
        size = len(text)
        best, count, fresh = [-math.inf] * (size + 1), [0] * (size + 1), [True] * (size + 1)
        best[0] = 0.0
        done = 0

        def settle(upto: int) -> None:
            # All pieces that end at these positions are known: now try the unknown character.
            for end in range(done + 1, upto + 1):
                char = text[end - 1]
                if char not in self.single and (score := best[end - 1] + self.unknown) > best[end]:
                    best[end] = score
                    if self.fallback:
                        count[end] = count[end - 1] + len(char.encode())
                    else:
                        count[end] = count[end - 1] + fresh[end - 1]
                        fresh[end] = False

        for last, (length, score) in self.automaton.iter(text):
            # Matches come by their end, and for one end from the longest to the shortest.
            if last > done:
                settle(last)
                done = last
            end, start = last + 1, last + 1 - length
            if (total := best[start] + score) > best[end]:
                best[end], count[end], fresh[end] = total, count[start] + 1, True
        settle(size)
        return best[size], count[size]

    def __call__(self, text: str) -> tuple[float, int]:
        memo, score, pieces = self.memo, 0.0, 0
        for part in self.parts(f" {text}"):
            found = memo.get(part)
            if found is None:
                found = self.path(part.replace(" ", SPACE))
                if len(part) <= MEMO_CHARS:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[part] = found
            score += found[0]
            pieces += found[1]
        return score, pieces


@lru_cache(maxsize=2)
def _counter(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def count_tokens(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: ``doc_id, n_chars, n_tokens, score``.

    A text is read with a space before it and space marks for its spaces. NULL texts have 0
    tokens, empty ones those of the leading space mark. Rows are independent and texts whole, so there
    is no shuffle; tasks get the vocabulary, which doesn't grow with the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            values = [texts[i].as_py() for i in range(len(texts))]
            found = [(0.0, 0) if v is None else counter(v) for v in values]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(v or "") for v in values], pa.int64()),
                    pa.array([n for _, n in found], pa.int64()),
                    pa.array([s for s, _ in found], pa.float64()),
                ],
                ["doc_id", "n_chars", "n_tokens", "score"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars bigint, n_tokens bigint, score double"
    return in_arrow(documents.select("doc_id", "text"), run, schema)
