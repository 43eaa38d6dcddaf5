"""Exact repeats against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, prose

from tablemove.llm import repeats
from tablemove.llm.repeats import LENGTH, anchors, remove_repeats
from tablemove.llm.suffixes import equal_windows


def brute(rows, length):
    """Spans and kept digest of each row."""
    places = defaultdict(int)
    data = [(d, (t or "").encode()) for d, t, *_ in rows]
    for _, b in data:
        for i in range(len(b) - length + 1):
            places[b[i : i + length]] += 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if places[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answer(spark, rows, length=LENGTH):
    found = remove_repeats(documents(spark, rows), length).collect()
    out = []
    for r in found:
        n = len((r["row"]["text"] or "").encode())
        gone = sum(s["end"] - s["start"] for s in r["spans"])
        out.append((r["row"]["doc_id"], n, gone, len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()))
    return sorted(out, key=str)


def sample():
    rng = random.Random(5)
    passages = [prose(100 + i, 90) for i in range(3)]
    rows = [(None, None), (0, ""), (1, "kurz"), (2, "ä" * 450), (3, "ab" * 600)]
    for i in range(4, 40):
        parts = [prose(i, rng.randrange(0, 120))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            cut = rng.randrange(0, 80)
            parts += [p[cut:], prose(i + 1000, rng.randrange(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [(50, prose(1, 300)), (51, prose(1, 300)), (52, prose(1, 300) + " end"), (4, rows[5][1])]
    rows += [rows[7], (60, passages[0] + "é" + passages[0]), (61, None)]
    return rows


@pytest.mark.parametrize("length", [LENGTH, 64])
def test_brute_force(spark, length):
    rows = sample()
    assert answer(spark, rows, length) == brute(rows, length)


def test_hot_anchor_is_dealt_out(spark, monkeypatch):
    # So many different surroundings of one passage that it needs several salts and buckets.
    monkeypatch.setattr(repeats, "SALT_SEGMENTS", 5)
    monkeypatch.setattr(repeats, "BUCKET_SEGMENTS", 10)
    passage = prose(7, 100)
    rows = [(i, f"{prose(i, 30)} {passage} {prose(i + 500 if i % 3 else 500, 30)}") for i in range(40)]
    assert answer(spark, rows) == brute(rows, LENGTH)


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    rows = [(1, prose(1, 900)), (2, "x " + prose(1, 900)), (3, prose(2, 500) + prose(1, 700))]
    text, length = rows[0][1], LENGTH
    blocks = list(repeats._blocks(text, length))
    assert sum(b.size - length + 1 for _, b in blocks) == len(text) - length + 1
    assert answer(spark, rows) == brute(rows, length)


def test_empty_table(spark):
    assert answer(spark, []) == []


def test_anchors_follow_the_content():
    text = prose(3, 400).encode()
    runs = {}
    for shift in (0, 37):
        data = np.frombuffer(b"z" * shift + text, np.uint8)
        begin, place, _ = anchors(data, LENGTH)
        which = np.searchsorted(begin, np.arange(shift, data.size - LENGTH + 1), "right") - 1
        runs[shift] = place[which] - shift
    assert (runs[0] == runs[37]).all()


def test_equal_windows():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[1000:1300], data[2000:2300] = data[:300], data[:300]
    length = 70
    starts = rng.permutation(data.size - length + 1)
    keys = starts % 2
    got = equal_windows(data, starts, keys, length)
    seen = {}
    for s, k, c in zip(starts, keys, got, strict=True):
        assert seen.setdefault((k, data[s : s + length].tobytes()), c) == c
    assert len(set(got)) == len(seen)
