"""The tree of path templates against a plain version, one level at a time; deep paths and numbers."""

import math
import random
import re
import time

from tablemove.llm import urls

HOST = "https://h.example.org"


def judged(spark, rows):
    """``path -> (verdict, template)`` for rows of ``(path, bad or None)``."""
    pages = spark.createDataFrame([(i, HOST + p) for i, (p, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "page_id long, bad boolean")
    return {r["path"]: (r["verdict"], r["template"]) for r in urls.filter_urls(pages, labels, rules=()).collect()}


def shape(segment):
    return re.sub("[0-9]+", "{n}", re.sub("(?i)(?=[0-9a-f]*[0-9])[0-9a-f]{8,}", "{x}", segment))


def told_apart(own, of, among, purity):
    if not own[1]:
        return False
    rate, share = of[2] / max(of[1], 1), own[2] / own[1]

    def part(p, q):
        return 0.0 if p == 0 else math.inf if q == 0 else p * math.log(p / q)

    return own[1] * (part(share, rate) + part(1 - share, 1 - rate)) >= math.log(2 * among / purity.risk)


def total(items):
    items = list(items)
    return [sum(i[k] for i in items) for k in range(3)]


def plain_tree(rows, purity):
    """One host's templates by path: ``rows`` of ``(path, n, labelled, bad)``."""
    state = {p: ("", [s for s in p.split("/") if s], (n, lab, bad)) for p, n, lab, bad in rows}
    level, settled = 0, {}
    longest = max((len(s) for _, s, _ in state.values()), default=0)
    while True:
        nodes = {}
        for p, (template, segments, sums) in state.items():
            nodes.setdefault(template, []).append((p, segments, sums))
        for template, members in nodes.items():
            if level < min(purity.levels, longest):
                go_on = True
            elif level < purity.levels:
                go_on = False
            else:
                deeper = [(s, v) for _, s, v in members if len(s) > level]
                _, lab, bad = total(v for _, v in deeper)
                go_on = len(deeper) > 1 and 0 < bad < lab
            if go_on:
                continue
            for p, segments, _ in members:
                settled[p] = template + ("/**" if len(segments) > level else "")
                del state[p]
        if not state:
            return settled
        named = {}
        for template, members in nodes.items():
            members = [m for m in members if m[0] in state]
            if not members:
                continue
            raw = {}
            for _, segments, sums in members:
                raw.setdefault(segments[level] if len(segments) > level else "", []).append(sums)
            raw = {r: total(v) for r, v in raw.items()}
            shapes = {}
            for r in raw:
                if shape(r) != r:
                    shapes.setdefault(shape(r), []).append(r)
            of = {}
            for r, sums in raw.items():
                same = shapes.get(shape(r), []) if shape(r) != r else []
                keep = not same or told_apart(sums, total(raw[x] for x in same), len(same), purity)
                of[r] = r if keep else shape(r)
            children = {}
            for r, s in of.items():
                children.setdefault(s, []).append(raw[r])
            children = {s: total(v) for s, v in children.items()}
            parent = total(children.values())
            rate = parent[2] / max(parent[1], 1)
            for p, segments, _ in members:
                segment = of[segments[level] if len(segments) > level else ""]
                n, lab, bad = own = children[segment]
                if segment == "":
                    label = ""
                elif n < purity.min_share * parent[0]:
                    label = f"/{segment}" if told_apart(own, parent, len(children), purity) else "/*"
                else:
                    error = math.sqrt(rate * (1 - rate) / max(lab, 1))
                    label = "/~" if abs(bad - rate * lab) <= purity.z * error * lab else f"/{segment}"
                named[p] = template + label
        state = {p: (named[p], s, v) for p, (_, s, v) in state.items()}
        level += 1


def test_against_a_plain_tree(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(1500):
        parts = [rng.choice(["news", "shop", "u1", "u2", "u3", "b0d1e2f3a4", "x"]) for _ in range(rng.randint(0, 7))]
        if len(parts) > 4 and rng.random() < 0.5:
            parts[4:5] = ["long", "way", "down", parts[4]]
        bad = "u2" in parts or parts[-1:] == ["shop"] or rng.random() < 0.1
        rows.append(("/" + "/".join(parts), rng.choice([None, bad, bad])))
    counted = {}
    for path, bad in rows:
        at = counted.setdefault(path, [0, 0, 0])
        at[0] += 1
        at[1] += bad is not None
        at[2] += bool(bad)
    purity = urls.Purity()
    templates = plain_tree([(p, *c) for p, c in counted.items()], purity)
    got = judged(spark, rows)
    assert {p: t for p, (_, t) in got.items()} == templates
    assert len(set(templates.values())) > 10 and any(t.count("/") > 6 for t in templates.values())
    sums = {t: total(counted[p] for p in counted if templates[p] == t) for t in set(templates.values())}
    _, lab, bad = total(counted.values())
    host = (bad + purity.prior * bad / lab) / (lab + purity.prior)
    for path, (verdict, template) in got.items():
        share = (sums[template][2] + purity.prior * host) / (sums[template][1] + purity.prior)
        assert verdict == ("block" if share > purity.limit else "allow")


def test_numbered_sections_are_told_apart(spark):
    rows = [(f"/secd{i}/page{j}", i == 0) for i in range(30) for j in range(40)]
    got = judged(spark, rows)
    assert all(verdict == ("block" if p.startswith("/secd0/") else "allow") for p, (verdict, _) in got.items())


def test_deep_paths_take_few_rounds(spark, monkeypatch):
    calls, whole = [], urls._with_level
    monkeypatch.setattr(urls, "_with_level", lambda *a: calls.append(1) or whole(*a))
    deep = "/" + "/".join(f"s{i % 7}" for i in range(1000))
    start = time.monotonic()
    got = judged(spark, [(f"{deep}/good/{i}", False) for i in range(20)] + [(f"{deep}/bad/{i}", True) for i in range(20)])
    assert len(calls) <= 7 and time.monotonic() - start < 300
    assert all(verdict == ("block" if "/bad/" in p else "allow") for p, (verdict, _) in got.items())
