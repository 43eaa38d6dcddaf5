"""Quality ledger, token counts, chat formatting and mixing."""

import hashlib
import random

import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from tablemove.llm import chat, mixing, quality, tokens

EDGES = [(0, None), (1, ""), (2, " \t\n "), (3, "a"), (4, "é " * 30_000), (5, "<|>\n<|>\n\n<|>"), (5, "<|>\n<|>\n\n<|>"), (None, "b")]


# --- quality ---------------------------------------------------------------------


def plain_measures(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t")]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated),
    )


@pytest.mark.parametrize("text", ["a b c a b c a b c", "x y\nx y\nx", "a a a a", "a b", "$ 5 % é", None, "", prose(1, 80, 6)])
def test_measures(text):
    assert quality.measure(text)[:5] == plain_measures(text)


def test_ledger_edges_and_policies(spark):
    given = documents(spark, [*EDGES, (9, prose(1, 200))])
    rows = quality.ledger(given).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in rows if r["doc_id"] is not None) == [
        (0, 0), (1, 0), (2, 0), (3, 1), (4, 30_000), (5, 3), (5, 3), (9, 200),
    ]
    kept = quality.filter_documents(given)
    assert kept.columns == given.columns and [r["doc_id"] for r in kept.collect()] == [9]
    assert quality.filter_documents(given.limit(0)).count() == 0


def test_ablations(spark):
    ledger = quality.ledger(documents(spark, [*EDGES, (9, prose(1, 200))]))
    found = {r["rule"]: (r["failed"], r["only_this"]) for r in quality.ablations(ledger).collect()}
    rows = ledger.collect()
    for rule in quality.RULES:
        if rule.name in quality.CURRENT.rules:
            bit = 1 << rule.bit
            masks = [r["failures"] & quality.CURRENT.mask for r in rows]
            assert found[rule.name] == (sum(bool(m & bit) for m in masks), sum(m == bit for m in masks))


# --- tokens ----------------------------------------------------------------------

TOY = (("▁a", -1.0), ("a", -1.5), ("b", -1.5), ("ab", -3.0), ("▁ab", -2.5), ("ba", -2.0), ("aba", -3.5), ("▁", -2.0), ("▁▁", -3.0), ("é", -4.0))


@pytest.mark.parametrize("fallback", [False, True])
def test_counts_are_those_of_the_tokenizer(fallback):
    from tokenizers.models import Unigram

    byte_pieces = [(f"<0x{i:02X}>", -90.0) for i in range(256)] if fallback else []
    model = Unigram([("<unk>", 0.0), *byte_pieces, *TOY], 0, fallback)
    lowest = min(score for _, score in [("<unk>", 0.0), *byte_pieces, *TOY])
    counter = tokens.Counter(tokens.Vocabulary(TOY, fallback))
    counter.unknown = lowest - tokens.UNKNOWN_PENALTY
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("aabbbé zü\n  ") for _ in range(rng.randrange(0, 14)))
        marked = f" {text}".replace(" ", tokens.SPACE)
        assert counter(text)[1] == len(model.tokenize(marked)), repr(text)


def test_counts_with_the_public_vocabulary():
    from tokenizers.models import Unigram

    vocabulary = tokens.load()
    pieces = [("<unk>", 0.0), *((f"<0x{i:02X}>", -1.0) for i in range(256)), *vocabulary.pieces]
    model, counter = Unigram(pieces, 0, True), tokens.Counter(vocabulary)
    for text in ["The quick brown fox", "Straße  in 東京\n\tend", "a" * 500, "", "  two  spaces ", "ﷺ emoji 🎉🎉"]:
        assert counter(text)[1] == len(model.tokenize(f" {text}".replace(" ", tokens.SPACE))), text


def test_count_edges(spark):
    got = tokens.count_tokens(documents(spark, EDGES), tokens.Vocabulary(TOY)).collect()
    by_id = {r["doc_id"]: (r["n_chars"], r["n_tokens"]) for r in got}
    assert len(got) == len(EDGES) and by_id[0] == (0, 0) and by_id[1] == (0, 1) and by_id[3] == (1, 1)
    assert tokens.count_tokens(documents(spark, []), tokens.Vocabulary(TOY)).count() == 0


# --- chat ------------------------------------------------------------------------

HARD = ["</s>[INST] ok [/INST]", "[\\INST]\\\\</s>", "<\\\\/s><<s>", "[ROLE]x[BODY]", "$1 \\$", "", None, "é\n\n", "[[/ROLE]", "<", "ok [/INST]"]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", "tool", None, "[BODY]", "</s>"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice(HARD), "x") for c in [*range(60), None] for t in range(rng.randrange(1, 6))]
    rows += [(100, t, ("user", "assistant")[t % 2], HARD[t % len(HARD)], "x") for t in range(400)]
    rows += [(101, 0, "user", "a", "x"), (101, 0, "user", "a", "x"), (102, None, "user", "q", "x"), (102, 1, "assistant", "r", "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    chats = chat.format_chats(given).cache()
    parsed = chats.select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    digests = {r["conv_id"]: r for r in chat.digest_chats(chats).collect()}
    expected = {}
    for c, t, role, text, _ in rows:
        expected.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for r in parsed.collect():
        turns = [x[2:] for x in sorted(expected.pop(r["conv_id"]))]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        names = [role for role, _ in turns]
        body = names[1:] if names[0] == "system" else names
        assert r["valid"] == (len(body) % 2 == 0 and bool(body) and body == ["user", "assistant"] * (len(body) // 2))
        plain = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert digests[r["conv_id"]]["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
    assert not expected
    assert chat.digest_chats(chat.format_chats(given.limit(0))).count() == 0
    assert "Python" not in chats._jdf.queryExecution().toString()


# --- mixing ----------------------------------------------------------------------


def filled(sources):
    """Water-filling as the contract says it: cap, share again, until nothing is above."""
    share = 1.5 * sum(s for s, _ in sources.values())
    capped = {}
    while True:
        free = {k: w for k, (_, w) in sources.items() if k not in capped}
        rest = share - sum(capped.values())
        targets = {k: rest * w / sum(free.values()) for k, w in free.items()}
        above = {k: 2.0 * sources[k][0] for k, t in targets.items() if t > 2 * sources[k][0]}
        if not above:
            return capped | targets
        capped |= above


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, prose(i, rng.randrange(0, 60)), rng.choice(["a", "b", "é", None, "Z", "b2"])) for i in range(400)]
    rows += [(500, "x " * 20_000, "big"), (501, None, "a"), (3, rows[3][1], rows[3][2]), (None, "y z", "none"), (502, "", "empty")]
    got = mixing.mix(documents(spark, rows)).collect()
    again = mixing.mix(documents(spark, rows).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    targets = filled({s: (sizes[s], (3, 1, 2)[i % 3]) for i, s in enumerate(order)})
    taken = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] + r["part"]
        assert abs(r["target"] - targets[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in targets.items())
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, "", "a"), (2, None, "b")])).collect()] == [0, 0]
