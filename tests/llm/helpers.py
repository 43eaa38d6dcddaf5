"""Small tables for the tests of the llm operators."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Names that the operators use inside; tables may have columns of these names.
CLASHING = ("k1", "k2", "id", "row", "root", "band", "h", "n_words", "failures", "size", "target", "template", "lang")
DOCUMENT = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType())]
    + [StructField(c, StringType()) for c in CLASHING]
)


def documents(spark, rows):
    """Rows of ``(doc_id, text)`` or ``(doc_id, text, source)``."""
    filled = [(*r, *([None] if len(r) == 2 else []), *CLASHING) for r in rows]
    return spark.createDataFrame(filled, DOCUMENT)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edited(text, seed, changes):
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)
