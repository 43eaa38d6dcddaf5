"""The prefix trie against prefixes listed one by one."""

import random
from hashlib import sha256
from zlib import crc32

from helpers import CLASHING
from pyspark.sql import functions as F

from tablemove.llm import prefixes

NAMES = (*CLASHING, "turns", "hashes", "at", "edge", "depth", "parent")
SCHEMA = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in NAMES)


def table(spark, rows):
    return spark.createDataFrame([(*r, *NAMES) for r in rows], SCHEMA)


def listed(conversations):
    """``conv_id -> turns`` to the expected rows, from all prefixes."""
    starts = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            starts.setdefault(tuple(turns[:d]), []).append(conv)
    children = {p: 0 for p in starts}
    for p in starts:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(starts, 0), dict.fromkeys(starts, 0)
    for p, convs in starts.items():
        spared = (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += spared
    rows = []
    for p, convs in starts.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(p))
        parent = min(starts[p[:-1]]) if p else None
        rows.append((min(convs), len(p), parent, len(convs), children[p], leaves[p], saved[p], sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, rows))


def got(frame):
    return sorted(repr(tuple(r)) for r in frame.collect())


def rows_of(conversations):
    rows = [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return rows


def wandering(seed, count, most, choices):
    rng = random.Random(seed)
    return {c: [("user" if i % 2 else "bot", f"é{rng.randrange(choices)}") for i in range(rng.randint(1, most))] for c in range(count)}


def comb(size):
    """Conversation i leaves a common spine at depth i."""
    spine = [("user", f"s{i}") for i in range(size)]
    return {i: [*spine[:i], ("user", f"own {i}"), ("bot", "x")] for i in range(size)} | {size: spine}


CASES = {
    "bushy": wandering(1, 150, 9, 2),
    "wide": wandering(2, 120, 4, 30),
    "comb": comb(70),
    "deep": {c: [("user", "same")] * c for c in range(1, 40)},
    "copies": {c: [("user", "hi"), ("bot", "there")] for c in range(300)} | {500: [("user", "hi")], 501: [("bot", "hi")]},
    "one long": {7: [("user", str(i % 3)) for i in range(2000)], -3: [("user", "0"), ("user", "9")]},
    "empty texts": {1: [("", "")], 2: [("", ""), ("", "")], 3: [("", "a"), ("a", "")], 4: [("a", "")]},
}


def test_against_all_prefixes(spark):
    every = {1000 * i + c: turns for i, case in enumerate(CASES.values()) for c, turns in case.items()}
    assert got(prefixes.trie(prefixes.turns_of(table(spark, rows_of(every)))).expanded()) == listed(every)


def test_branched_conversations(spark):
    rng = random.Random(9)
    given = {c: [("user", f"{rng.randrange(3)}") for _ in range(rng.randint(1, 12))] for c in rng.sample(range(-20, 200), 120)}
    rebuilt = {}
    for c, turns in given.items():
        base, taken = int(c / 5) * 5, crc32(str(c).encode()) % 9
        rebuilt[c] = given.get(base, [])[:taken] + turns[taken:]
    assert any(not t for t in rebuilt.values())
    made = prefixes.branched(prefixes.turns_of(table(spark, rows_of(given))))
    assert got(prefixes.trie(made).expanded()) == listed(rebuilt)


def test_nodes_are_compact(spark):
    """Handles are the two-fattest depths of their edges, and only branches and ends are nodes."""
    turns = prefixes.turns_of(table(spark, rows_of(CASES["bushy"])))
    made = prefixes.trie(turns)
    rows = made.nodes.collect()
    ends = {r["id"] for r in made.ends.collect()}
    for r in rows:
        fattest = max(range(r["top"] + 1, r["depth"] + 1), key=lambda d: d & -d)
        assert r["handle"] == r["hashes"][fattest - r["top"] - 1] and r["first"] == r["hashes"][0]
        assert sum(o["parent"] == r["id"] for o in rows) != 1 or r["id"] in ends


def test_exits_by_fat_search(spark):
    """Every sequence leaves the trie of the others at its longest prefix in it."""
    every = wandering(4, 80, 9, 2)
    frame = prefixes.sequences(prefixes.turns_of(table(spark, rows_of(every))))
    rows = frame.select("conv_id", "id", F.size("hashes").alias("n"), "hashes", "sizes")
    nodes = prefixes.z_fast_trie(rows.filter("conv_id < 40").drop("conv_id").dropDuplicates(["id"]))
    found = prefixes.exits(rows.filter("conv_id >= 40"), nodes, 4).collect()
    known = {tuple(t[:d]) for c, t in every.items() if c < 40 for d in range(len(t) + 1)}
    for r in found:
        turns = every[r["conv_id"]]
        assert r["at"] == max(d for d in range(len(turns) + 1) if tuple(turns[:d]) in known)


def test_few_batches(spark, monkeypatch):
    """A comb of depth 70 takes far fewer batches than it has branches."""
    calls = []
    whole = prefixes.exits
    monkeypatch.setattr(prefixes, "exits", lambda *a: calls.append(1) or whole(*a))
    prefixes.trie(prefixes.turns_of(table(spark, rows_of(comb(70)))))
    assert len(calls) <= 12


def test_edges(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "bot", "z"), (2, 5, "", "")]
    want = {1: [("", ""), ("bot", "z"), ("user", "b"), ("user", "b")], 2: [("", "")], 3: [("user", "x" * 3_000_000)]}
    rows.append((3, 0, "user", "x" * 3_000_000))
    assert got(prefixes.trie(prefixes.turns_of(table(spark, rows))).expanded()) == listed(want)
    assert prefixes.trie(prefixes.branched(prefixes.turns_of(table(spark, [])))).expanded().collect() == []
