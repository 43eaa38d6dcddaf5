"""Secret scans: patterns against a plain search, decoding against the whole chain, and held-out lines."""

import random
import re

import numpy as np
import pytest
from helpers import documents, prose

from tablemove.llm import credentials, crf
from tablemove.llm.credentials import Tagger, base_spans, file_features, made_lines, signature, views


@pytest.fixture(scope="module")
def field(spark, testdata):
    return credentials.train(spark.read.parquet(f"{testdata}/documents.parquet"))


def plain_spans(text):
    """Every kind on its own: the leftmost whole match, then on from its end."""
    found = []
    for kind, pattern in enumerate((credentials.ASSIGN, credentials.ACCESS, credentials.HEX)):
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            if len(m.group(2 if kind == 0 else 0)) >= (6, 20, 24)[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_patterns_against_plain_search():
    pieces = ["token", "SECRET", "api_key", "apikey", "=", ":", " ", "\t", '"', "'", "abcdef", "ab", "AKIA", "A1B2C3D4E5F6G7H8", "é", "ſecret", "\n"]
    pieces += ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "0123456789abcdef", "/+=", "x"]
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in base_spans(text)] == plain_spans(text), text
    assert [s[:3] for s in base_spans("api_key=token: abcdefgh")] == []
    assert [s[:3] for s in base_spans("PassWord' : 'abcdef'")] == [(0, 0, 19)]


def whole_chain(field, text, lang, hits):
    """The best tags over all tokens of a text at once."""
    tokens = [m.group() for m in credentials.TOKEN.finditer(text)]
    places = [m.span() for m in credentials.TOKEN.finditer(text)]
    if not tokens:
        return []
    padded = ["\x00"] * 3 + tokens + ["\x00"]
    file = field.score(file_features(text, lang, hits))
    rows = [
        file + sum(field.score(views(signature(padded[i - d]))[d]) for d in range(4)) + field.score(views(signature(padded[i + 1]))[-1])
        for i in range(3, 3 + len(tokens))
    ]
    found, previous = [], crf.O
    for place, tag in zip(places, field.best(np.array(rows), closed=False), strict=True):
        if tag == crf.B or (tag == crf.I and previous == crf.O):
            found.append(place)
        elif tag == crf.I:
            found[-1] = (found[-1][0], place[1])
        previous = tag
    return found


@pytest.mark.parametrize("size", [7, 200, 200_000])
def test_slices_and_sure_tokens_change_nothing(field, monkeypatch, size):
    monkeypatch.setattr(credentials, "SLICE", size)
    tagger, rng = Tagger(field), random.Random(size)
    for i in range(25):
        parts = [" ".join(t) for t, _ in made_lines(4, 50 + i)] + [prose(i, 20), "密码 é = x", "\n", "=" * rng.randint(0, 9)]
        text = rng.choice(["\n", " "]).join(rng.sample(parts, len(parts)))
        assert tagger.spans(text, "en", 1) == whole_chain(field, text, "en", 1)


def test_margins_are_safe():
    """A tag that the margins rule out is in no best chain, whatever the transitions are."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        field = crf.Field({}, rng.normal(0, 2, (3, 3)))
        scores = rng.normal(0, 3, (8, 3))
        sure = (scores[:, :1] - scores[:, 1:] > field.margins()).all(1)
        assert all(t == crf.O for t, s in zip(field.best(scores, False), sure, strict=True) if s)


def test_held_out_lines(field):
    tagger, good, wrong, missed = Tagger(field), 0, 0, 0
    for tokens, tags in made_lines(400, 4711):
        text, places, at = " ".join(tokens), [], 0
        for token in tokens:
            places.append((at, at + len(token)))
            at += len(token) + 1
        wanted = []
        for place, tag in zip(places, tags, strict=True):
            if tag == crf.B:
                wanted.append(place)
            elif tag == crf.I:
                wanted[-1] = (wanted[-1][0], place[1])
        got = tagger.spans(text, "en", 0)
        good += len(set(got) & set(wanted))
        wrong += len(set(got) - set(wanted))
        missed += len(set(wanted) - set(got))
    assert good > 0.9 * (good + missed) and good > 0.9 * (good + wrong)


def test_what_the_patterns_miss(field):
    tagger = Tagger(field)
    for text, secret in [
        ('auth_key = "Zm9vYmFyYmF6cXV4MTIzNDU2Nzg5MA=="', "Zm9vYmFyYmF6cXV4MTIzNDU2Nzg5MA=="),
        ("then credential: 9fK2mQ8xL0pR7tV3 was set", "9fK2mQ8xL0pR7tV3"),
    ]:
        assert base_spans(text) == []
        assert [text[a:b] for a, b in tagger.spans(text, "en", 0)] == [secret]
    for text in ("version = 1.2.3", "phone 47853805923 call", prose(3, 300), "", "size: large"):
        assert tagger.spans(text, "en", 0) == []


def test_clean_documents_stay_clean(spark, testdata, field):
    rows = credentials.scan(spark.read.parquet(f"{testdata}/documents.parquet"), field).collect()
    assert sum(any(s["kind"] == "crf" for s in r["spans"]) for r in rows) <= 0.01 * len(rows)


def test_edges(spark, field):
    hexes = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    token = f'token = "{hexes}"'
    rows = [(1, None), (2, ""), (None, token), (3, token), (3, token), (4, "w " * 400_000 + token), (5, "é" * 3 + " " + token)]
    got = {}
    for r in credentials.scan(documents(spark, rows), field).collect():
        got.setdefault(r["row"]["doc_id"], []).append([(s["kind"], s["start"], s["end"]) for s in r["spans"]])
    both = lambda at: [("assign", at, at + 49), ("hex", at + 9, at + 49)]
    assert got == {1: [[]], 2: [[]], None: [both(0)], 3: [both(0)] * 2, 4: [both(800_000)], 5: [both(4)]}
    assert credentials.scan(documents(spark, []), field).collect() == []


def test_training_is_repeatable_and_bounded(spark):
    some = documents(spark, [(i, f"{prose(i, 40)} token = {i:040x}") for i in range(30)] + [(None, None)])
    small = credentials.Training(texts=5, lines=40)
    first, again = (credentials.train(some, small) for _ in range(2))
    assert first.weights == again.weights and (first.follow == again.follow).all()
    empty = credentials.train(documents(spark, []), small)
    assert empty.weights and not any(re.match("file", f) for f in empty.weights)
