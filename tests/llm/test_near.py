"""Near-duplicate documents and fuzzy lines against brute force; connected components."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import documents, edited, prose
from pyspark.sql import functions as F

from tablemove.llm import components as components_module
from tablemove.llm import documents_near, lines, near
from tablemove.llm.components import components
from tablemove.llm.documents_near import duplicate_classes, keep_one, prob_minhash


def classes_of(items, close):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(items)), 2):
        if close(items[i], items[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def word_close(a, b):
    if (a or "") == (b or ""):
        return True
    x, y = (
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((a or "").split(), (b or "").split())
    )
    return bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)


def sample():
    base = [prose(i, 150, 5000) for i in range(8)]
    texts = [*base, "", None, "one two", "one two", "one two three", "   ", prose(99, 6000, 9000)]
    for i in range(40):
        texts.append(edited(base[i % 5], i, 1 + i % 4))
    for i in range(30):
        texts.append(edited(texts[-1], 1000 + i, 1))  # a chain
    random.Random(1).shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5])]


def expected_classes(rows):
    roots = classes_of([t for _, t in rows], word_close)
    least = {}
    for (d, _), r in zip(rows, roots, strict=True):
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, least[r], roots.count(r)) for (d, _), r in zip(rows, roots, strict=True)), key=str)


@pytest.mark.parametrize("block", [200, 4])
def test_document_classes(spark, monkeypatch, block):
    monkeypatch.setattr(near, "MEMBER_BLOCK", block)
    monkeypatch.setattr(near, "STRAGGLER_BLOCK", max(2, block // 4))
    monkeypatch.setattr(near, "CROWDED", block)
    rows = sample()
    got = sorted((tuple(r) for r in duplicate_classes(documents(spark, rows)).collect()), key=str)
    assert got == expected_classes(rows)


def test_repeated_footers(spark):
    # 100 distinct shingles, and the same with 20 more that are held up to 1,000 times.
    rows = []
    for i in range(12):
        text, footer = prose(500 + i, 104, 10**6), prose(600 + i, 16, 10**6)
        rows += [(2 * i, text), (2 * i + 1, f"{text} " + " ".join([footer] * (50, 1000)[i % 2]))]
    expected = expected_classes(rows)
    assert {size for *_, size in expected} == {2}
    got = sorted((tuple(r) for r in duplicate_classes(documents(spark, rows)).collect()), key=str)
    assert got == expected
    assert sorted(r["doc_id"] for r in keep_one(documents(spark, rows)).collect()) == list(range(0, 24, 2))


def test_keep_one(spark):
    rows = sample()
    given = documents(spark, rows)
    kept = keep_one(given)
    assert kept.columns == given.columns
    expected = {c for _, c, _ in expected_classes(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert duplicate_classes(none).count() == 0 and keep_one(none).count() == 0
    assert lines.deduplicate(none).count() == 0


def test_registers_agree_as_often_as_weights_do():
    rng = np.random.default_rng(1)
    items = documents_near.mixed(np.arange(300, dtype=np.uint64))
    x, y = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300).astype(float)
    x[:40], y[-40:] = 0, 0
    both = [i for i in range(300) if x[i] and y[i]]
    truth = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in both)
    kept = [prob_minhash(items[w > 0], w[w > 0], 4000) for w in (x, y)]
    assert abs((kept[0] == kept[1]).mean() - truth) < 0.03


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    linked = {frozenset(e) for e in edges}
    roots = dict(zip(nodes, classes_of(nodes, lambda a, b: frozenset((a, b)) in linked), strict=True))
    assert set(got) == set(nodes)
    assert len(set(got.values())) == len(set(roots.values()))
    assert len({(got[n], roots[n]) for n in nodes}) == len(set(roots.values()))
    assert components(frame.filter("a = b")).count() == 0


def test_rarest_shingles_are_enough():
    """Of close texts, the rarest shingles meet, whatever order they are counted to have."""
    rng = random.Random(6)
    similarity = near.Similarity(lambda texts: [np.array([int(w) for w in t.split()], np.uint64) for t in texts])
    often = np.array([rng.randrange(50) for _ in range(near.SLOTS)])
    for _ in range(400):
        x = rng.sample(range(2**40), rng.randint(1, 60))
        y = x[: rng.randint(len(x) // 2, len(x))] + rng.sample(range(2**40), rng.randint(0, 12))
        texts = [" ".join(str(v << 24) for v in t) for t in (x, y)]
        batch = pa.RecordBatch.from_arrays([pa.array([b"x", b"y"]), pa.array(texts)], ["id", "text"])
        made = next(near._rarest(similarity, often)(iter([batch])))
        of = {b"x": set(), b"y": set()}
        for bucket, node in zip(*(made.column(c).to_pylist() for c in ("bucket", "id")), strict=True):
            of[node].add(bucket)
        if similarity.close(*similarity.distinct(texts)):
            assert of[b"x"] & of[b"y"]


def test_sketches_refuse_no_close_pair(spark):
    rng = random.Random(8)
    similarity = near.Similarity(lambda texts: [np.array([int(w) for w in t.split()], np.uint64) for t in texts])
    texts = []
    for _ in range(60):
        x = rng.sample(range(2**40), rng.randint(1, 3000) if rng.random() < 0.2 else rng.randint(1, 40))
        texts += [" ".join(map(str, x)), " ".join(map(str, x[: rng.randint(len(x) // 2, len(x))] + rng.sample(range(2**40), len(x) // 10)))]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%03d" % i for i in range(len(texts))]), pa.array(texts)], ["id", "text"])
    made = next(near._sketched(similarity)(iter([batch])))
    bits = np.array(made.column("bits").to_pylist(), np.int64).view(np.uint64)
    sizes, distinct = np.array(made.column("n").to_pylist()), similarity.distinct(texts)
    frame = spark.createDataFrame(pa.Table.from_batches([made]).select(["id", "n", "bits"]))
    left, right = (frame.select(*[F.col(c).alias(f"{c}_{e}") for c in frame.columns]) for e in "ab")
    by_spark = {(bytes(r["id_a"]), bytes(r["id_b"])) for r in left.crossJoin(right).filter(similarity.possible_pair()).collect()}
    refused = 0
    for i in range(len(texts)):
        possible = similarity.possible(sizes, bits, int(sizes[i]), bits[i])
        for j in range(len(texts)):
            assert possible[j] == ((b"%03d" % i, b"%03d" % j) in by_spark)
            assert possible[j] or not similarity.close(distinct[i], distinct[j])
            refused += not possible[j]
    assert refused > 0.9 * len(texts) * (len(texts) - 4)


def test_many_like_texts_that_are_not_close(spark):
    """A bucket of texts that share most shingles, but too few, makes no pairs of them all."""
    common, rng = prose(1, 60, 10**6).split(), random.Random(3)
    rows = []
    for i in range(5000):
        own = [f"o{i}x{rng.randrange(10**9)}" for _ in range(24)]
        rows.append((i, " ".join(common + own)))
    rows += [(6000 + i, f"{rows[10 * i][1]} end") for i in range(20)]
    ids = spark.createDataFrame([(1, t.encode()[-16:].ljust(16)) for _, t in rows], "bucket long, id binary")
    texts = spark.createDataFrame([(t.encode()[-16:].ljust(16), t) for _, t in rows], "id binary, text string")
    words = near.Similarity(lambda texts: [np.array([xxhash.xxh64_intdigest(w) for w in t.split()], np.uint64) for t in texts])
    sizes = []
    whole = near._unresolved
    near._unresolved = lambda *a: sizes.append((f := whole(*a)).count()) or f
    try:
        got = near.near_classes(ids, lambda wanted: texts.join(wanted, "id", "left_semi"), words)
        assert got.count() == 40 and got.select("root").distinct().count() == 20
    finally:
        near._unresolved = whole
    assert sizes[0] < 10_000


def line_close(a, b, chars=7):
    x, y = ({s.ljust(chars, "\0")[i : i + chars] for i in range(max(1, len(s) - chars + 1))} for s in (a, b))
    return 100 * len(x & y) >= 80 * len(x | y)


def test_lines(spark):
    base = [prose(i, 25) for i in range(6)]
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "ab\n\nab\n ab \nabc"), (9, "x" * 50_000 + "\nab")]
    for i in range(10, 40):
        own = [base[rng.randrange(6)] for _ in range(3)] + [prose(i + 50, 12)]
        own[0] = own[0].replace("w1", "v1", 1)
        own[1] = "  " + own[1].replace(" ", "  ", 2)
        rows.append((i, "\n".join(own)))
    rows += [rows[7], (None, base[0])]
    order = sorted({(d is None, d or 0, t or "") for d, t in rows})
    places = [(k, i, " ".join(s.split())) for k in order for i, s in enumerate(k[2].split("\n")) if s.split()]
    roots = classes_of([s for *_, s in places], line_close)
    keep = {}
    for (k, i, _), r in zip(places, roots, strict=True):
        # One key per document here, so doc_id and place decide.
        keep[r] = min(keep.get(r, (k, i)), (k, i))
    gone = {(k, i) for (k, i, _), r in zip(places, roots, strict=True) if keep[r] != (k, i)}

    def kept(d, t):
        key = (d is None, d or 0, t or "")
        return t if t is None else "\n".join(s for i, s in enumerate(t.split("\n")) if (key, i) not in gone)

    given = documents(spark, rows)
    result = lines.deduplicate(given)
    assert result.columns == given.columns
    got = sorted(((r["doc_id"], r["text"]) for r in result.collect()), key=str)
    met, expected = set(), []
    for d, t in rows:
        # A row that repeats another one keeps no line with words.
        bare = t if t is None else "\n".join(s for s in t.split("\n") if not s.split())
        expected.append((d, bare if (d, t) in met else kept(d, t)))
        met.add((d, t))
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("step", [1, 2, 3, 100])
def test_bands_are_parted_by_size(step):
    """Lines of a band whose sizes are too far apart make no bucket, wherever batches end."""
    band = lambda number, size: (number << 20) | size
    rows = [
        *[(band(-5, 100), 1), (band(-5, 124), 2), (band(-5, 200), 3)],
        *[(band(1, 50), 4), (band(1, 70), 5), (band(1, 100), 6)],
        *[(band(2, 80), 7), (band(2, 80), 7), (band(2, 100), 8), (band(2, 100), 8)],
        *[(band(3, 10), 9), (band(3, 10), 9), (band(3, 10), 9)],
        *[(band(4, 10), 10), (band(5, 10), 11), (band(6, 1), 12), (band(6, 2), 13), (band(6, 2), 14)],
    ]
    assert rows == sorted(rows)
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + step], strict=True)], ["key", "half"]) for i in range(0, len(rows), step)]
    got = set()
    for made in lines._runs(80)(iter(batches)):
        got |= set(zip(*(made.column(c).to_pylist() for c in ("bucket", "half")), strict=True))
    expected = {
        *[(band(-5, 100), 1), (band(-5, 100), 2)],
        *[(band(2, 80), 7), (band(2, 80), 8), (band(6, 2), 13), (band(6, 2), 14)],
    }
    assert got == expected


def test_sizes_of_lines():
    texts = ["a" * 40, "abcdefgh", "ab", prose(5, 300), "abcabcabcabc"]
    sizes, bands = lines.line_bands(texts, lines.Fuzzy())
    assert sizes.tolist() == [len({t.ljust(7, "\0")[i : i + 7] for i in range(max(1, len(t) - 6))}) for t in texts]
    assert bands.shape == (5, 10)


def test_band_rows_are_few(spark):
    """Lines of very different sizes that share all bands, as by a common shingle, give no candidate."""
    keys = [[(7 << 20) | 4 * 3**i] * 10 for i in range(6)] + [[(8 << 20) | 50] * 10, [(8 << 20) | 60] * 10]
    cut = spark.createDataFrame([(i, f"line {i}", k) for i, k in enumerate(keys)], "half long, line string, keys array<long>")
    assert {tuple(r) for r in lines._buckets(cut, 80).collect()} == {((8 << 20) | 50, 6), ((8 << 20) | 50, 7)}


def _line_batches(lines_of, step):
    names = ["doc_id", "k1", "k2", "text"]
    rows = [(i, i, -i, t) for i, t in enumerate(lines_of)]
    return [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + step], strict=True)], names) for i in range(0, len(rows), step)]


def test_bands_are_dealt_in_few_rows():
    """Spark moves one row for the bands of many lines, not one for each, and none is lost."""
    texts = ["\n".join(prose(20 * i + j, 9) for j in range(20)) for i in range(40)]
    cut = pa.Table.from_batches(list(lines._cut(lines.Fuzzy())(iter(_line_batches(texts, 7)))))
    assert cut.num_rows == 800 and sum(cut["first"].to_pylist()) == 40
    dealt = pa.Table.from_batches(list(lines._dealt(iter(cut.select(["keys", "half"]).to_batches(max_chunksize=50)))))
    assert dealt.num_rows <= lines._BAND_PARTS
    got = [(k, h) for a, b in zip(dealt["keys"], dealt["halves"], strict=True) for k, h in zip(*(np.frombuffer(x.as_py(), np.int64).tolist() for x in (a, b)), strict=True)]
    keys = [np.frombuffer(k, np.int64).tolist() for k in cut["keys"].to_pylist()]
    assert sorted(got) == sorted((k, h) for own, h in zip(keys, cut["half"].to_pylist(), strict=True) for k in own)
    part = [(p, k >> 20) for p, x in zip(dealt["part"].to_pylist(), dealt["keys"].to_pylist(), strict=True) for k in np.frombuffer(x, np.int64).tolist()]
    assert len({band for _, band in part}) == len(set(part))


@pytest.mark.parametrize("most", [lines.TASK_BANDS, 100, 1])
def test_buckets_of_tasks_with_many_bands(spark, most):
    """What tasks sort themselves and what they leave to Spark give the same buckets."""
    rng = random.Random(3)
    keys = [[(rng.choice([-9, 4, 5, 1 << 40]) << 20) | rng.choice([100, 110, 200, 230, 500]) for _ in range(10)] for _ in range(60)]
    rows = [(i, f"line {i}", k) for i, k in enumerate(keys)] * 2 + [(99, "alone", [(77 << 20) | 100] * 10)]
    cut = spark.createDataFrame(rows, "half long, line string, keys array<long>")
    bands = {}
    for half, _, own in rows:
        for k in own:
            bands.setdefault(k >> 20, set()).add((k & 0xFFFFF, half, k))
    expected = set()
    for members in bands.values():
        run = []
        for size, half, k in [*sorted(members), (1 << 30, -1, 0)]:
            if run and 100 * run[-1][0] < 80 * size:
                if len({h for _, h, _ in run}) > 1:
                    expected |= {(run[0][2], h) for _, h, _ in run}
                run = []
            run.append((size, half, k))
    assert {tuple(r) for r in lines._buckets(cut, 80, most).collect()} == expected


@pytest.mark.parametrize("chars", range(1, 10))
def test_hashes_of_runs(chars):
    points = np.random.default_rng(1).integers(0, 1 << 20, 50, np.uint64)
    odd = int(lines._ODD)
    expected = [sum(int(p) * pow(odd, chars - i, 1 << 64) for i, p in enumerate(points[at : at + chars])) % (1 << 64) for at in range(51 - chars)]
    assert lines._windows(points, chars).tolist() == expected


def test_white_space_of_lines():
    texts = ["a b\nc  d \n\n a b", " a b \n\u00a0\n \n", "a\tb\r\n\x0b\n\x0cc", "", "\x1ca"]
    cut = pa.Table.from_batches(list(lines._cut(lines.Fuzzy())(iter(_line_batches(texts, 2))))).to_pylist()
    expected = [(i, j, xxhash.xxh3_128_digest(b" ".join(s.split()))) for i, t in enumerate(texts) for j, s in enumerate(t.encode().split(b"\n")) if s.split()]
    assert [(r["doc_id"], r["at"], r["id"]) for r in cut] == expected
    assert [r["doc_id"] for r in cut if r["first"]] == [0, 1, 2, 4]


@pytest.mark.parametrize("step", [1, 2, 9])
def test_places_are_listed(step):
    rows = [(1, 1, 0), (1, 1, 0), (1, 1, 4), (1, 2, 3), (2, 1, 3), (2, 1, 3), (2, 1, 5)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + step], strict=True)], ["k1", "k2", "at"]) for i in range(0, len(rows), step)]
    made = [tuple(r.values()) for b in lines._listed(iter(batches)) for r in b.to_pylist()]
    assert made == [(1, 1, [0, 4]), (1, 2, [3]), (2, 1, [3, 5])]


def test_bucket_of_many_classes_is_one_block(spark):
    """The rows of a bucket that spans classes grow as its members do, whoever is apart in it."""
    ids = [(bucket, b"%015d" % i) for bucket, n in ((1, 1500), (2, 700)) for i in range(n)]
    members = spark.createDataFrame(ids, "bucket long, id binary")
    classes = spark.createDataFrame([(b"%015d" % i, b"%015d" % 0) for i in range(300)], "node binary, root binary")
    rows = near._unresolved(members, classes).collect()
    assert len(rows) == 2200
    assert all(r["member"] and r["straggler"] == (bytes(r["class"]) != b"%015d" % 0) for r in rows)


def test_parts_hold_all_pairs(monkeypatch):
    monkeypatch.setattr(near, "PART_HASHES", 40)
    rng = random.Random(5)
    sizes = np.array([rng.randint(1, 30) for _ in range(60)])
    partners = {i: np.array(sorted(rng.sample(range(30, 60), rng.randint(1, 12)))) for i in range(30)}
    parts = [set(part.tolist()) for part in near._parts(partners, sizes)]
    assert all(len(part) == 2 or sizes[[*part]].sum() <= 40 for part in parts)
    assert all(any({i, j} <= part for part in parts) for i, others in partners.items() for j in others.tolist())


@pytest.mark.parametrize("held", [2_000_000, 60])
@pytest.mark.parametrize("whole", [True, False])
def test_blocks_link_what_is_close(monkeypatch, held, whole):
    monkeypatch.setattr(near, "PART_HASHES", held)
    rng = random.Random(7)
    similarity = near.Similarity(lambda texts: [np.array([int(w) for w in t.split()], np.uint64) for t in texts])
    base = [rng.sample(range(2**40), 30) for _ in range(4)]
    texts = [" ".join(map(str, rng.choice(base)[: rng.randint(24, 30)] + rng.sample(range(2**40), rng.randint(0, 6)))) for _ in range(80)]
    ids = [b"%03d" % i for i in range(80)]
    made = next(near._sketched(similarity)(iter([pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], ["id", "text"])])))
    own = {"block": pa.array(["1"] * 80), "class": pa.array(ids), "straggler": pa.array([i > 0 for i in range(80)])}
    block = pa.Table.from_batches([made])
    for name, column in (own | {"member": pa.array([True] * 80)}).items():
        block = block.append_column(name, column)
    if not whole:  # stragglers are there a second time
        at = block.schema.get_field_index
        member = block.set_column(at("straggler"), "straggler", pa.array([False] * 80))
        block = pa.concat_tables([member, block.set_column(at("member"), "member", pa.array([False] * 80))])
    kept = pa.Table.from_batches(list(near._possible_rows(similarity)(iter(block.combine_chunks().to_batches()))))
    found = kept.select(["block", "id", "straggler", "member"]).to_pylist()
    rows = [block.filter(pa.array([i == r["id"] and m == r["member"] for i, m in zip(block["id"].to_pylist(), block["member"].to_pylist(), strict=True)])) for r in found]
    parts = pa.concat_tables([r.slice(0, 1).set_column(r.schema.get_field_index("block"), "block", pa.array([f["block"]])) for r, f in zip(rows, found, strict=True)])
    links = [x for b in near._verify_blocks(similarity)(iter(parts.combine_chunks().to_batches())) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    linked = {frozenset(x) for x in links}
    distinct = similarity.distinct(texts)
    assert all(similarity.close(distinct[int(a)], distinct[int(b)]) for a, b in links)
    got = classes_of(ids, lambda a, b: frozenset((a, b)) in linked)
    assert got == classes_of(ids, lambda a, b: similarity.close(distinct[int(a)], distinct[int(b)]))


@pytest.mark.parametrize("nodes", [10**6, 7])
def test_tasks_turn_edges_into_stars(monkeypatch, nodes):
    monkeypatch.setattr(components_module, "FOREST_NODES", nodes)
    edges = [(i + 1, i) for i in range(50)] + [(i, i + 1) for i in range(100, 120)]
    random.Random(1).shuffle(edges)
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*edges[i : i + 5], strict=True)], ["a", "b"]) for i in range(0, len(edges), 5)]
    made = [x for b in components_module._stars(pa.int64())(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert nodes == 7 or set(made) == {(i, 0) for i in range(1, 51)} | {(i, 100) for i in range(101, 121)}
    linked = {frozenset(x) for x in made}
    names = [*range(51), *range(100, 121)]
    got = classes_of(names, lambda a, b: frozenset((a, b)) in linked)
    assert got == [0] * 51 + [51] * 21
