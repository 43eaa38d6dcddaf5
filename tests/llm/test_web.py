"""URL filters and archives."""

import base64
import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import pytest
from helpers import prose

from tablemove.llm import urls, warc
from tablemove.sources.workspace import new_area

CLASH = "host string, digest string, template string, first string"


def test_hosts_paths_and_rules(spark):
    cases = [
        ("https://A.Example.NET/EN/1?x#y", "a.example.net", "/EN/1", "net/", "block"),
        ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        ("ftp://wexample.net/en/", "wexample.net", "/en/", "net/", "block"),
        ("x://example.com/de/?a=/b", "example.com", "/de/", "example.com/de/", "block"),
        ("x://example.com", "example.com", "", None, None),
        ("x://net", "net", "", None, None),
        ("no scheme/net/", "", "", None, None),
        (None, "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("http://ÄB.org/fr/é", "Äb.org", "/fr/é", "org/fr/", "allow"),
        ("http://u@h.org:80/fr/", "u@h.org:80", "/fr/", None, None),
    ]
    frame = spark.createDataFrame([(c[0],) for c in cases], "url string")
    host, path = urls.parsed(frame["url"])
    rows = frame.select("url", host.alias("host"), path.alias("path")).collect()
    assert [tuple(r) for r in rows] == [c[:3] for c in cases]
    parsed = spark.createDataFrame([c[:3] for c in cases], "url string, host string, path string")
    found = parsed.select(*urls.matched_rule(parsed["host"], parsed["path"])).collect()
    assert [tuple(r) for r in found] == [c[3:] for c in cases]


def test_impure_templates_are_blocked(spark):
    rows, labels = [], []
    for i in range(400):
        good = i % 2 == 0
        kind = "news" if good else "cheap"
        rows.append((i, f"https://h.example.com/{kind}/{i}.html", "c", "c", "c", "c"))
        if i % 5:
            labels.append((i, not good))
    rows += [(1000, "https://h.example.com/cheap/99999.html", *"cccc"), (1001, "https://h.example.com/news/1/2/3/4/5/6", *"cccc")]
    rows += [(1002, None, *"cccc"), (None, "x://h.example.com/news/7.html", *"cccc"), (2, rows[2][1], *"cccc")]
    pages = spark.createDataFrame(rows, f"page_id long, url string, {CLASH}")
    given = spark.createDataFrame([*labels, (5000, None), (3, None)], "page_id long, bad boolean")
    got = urls.filter_urls(pages, given).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["verdict"] == ("block" if r["path"].startswith("/cheap/") else "allow"), r
    templates = {r["template"] for r in got if r["path"].startswith("/cheap/")}
    assert len(templates) == 1 and "cheap" in templates.pop()
    assert urls.filter_urls(pages.limit(0), given).count() == 0
    assert urls.filter_urls(pages, given.limit(0)).filter("verdict = 'block'").count() == 0


def judged(spark, paths, labelled):
    """Verdict and template by path; ``labelled`` tells whether a path is bad, or None."""
    pages = spark.createDataFrame([(i, f"https://h.example.com{p}", *"cccc") for i, p in enumerate(paths)], f"page_id long, url string, {CLASH}")
    labels = spark.createDataFrame([(i, labelled(p)) for i, p in enumerate(paths)], "page_id long, bad boolean")
    return {r["path"]: (r["verdict"], r["template"]) for r in urls.filter_urls(pages, labels).collect()}


def test_small_sections_with_labels_stay(spark):
    names = [f"{a}{b}" for a in "qrstuvwxyz" for b in "klmnop"]  # 60 sections of 1.67% each
    paths = [f"/{name}/{word}" for name in names for word in ("one", "two", *(f"v{c}" for c in "abcdefghijklmnopqr"))]
    got = judged(spark, paths, lambda p: p.startswith("/qk/"))
    for path, (verdict, _) in got.items():
        assert verdict == ("block" if path.startswith("/qk/") else "allow"), path


def test_deep_branches_are_told_apart(spark):
    letters = "abcdefghijklmnopqrst"
    deep = "/a/b/c/d/e/f"
    paths = [f"{deep}/{kind}/{x}" for kind in ("casino", "news", "sport") for x in letters]
    paths += [f"/good/b/c/d/{x}/{y}" for x in letters for y in "klm"] + ["/", "/a", deep, "/a/b/c/d/e"]
    got = judged(spark, paths, lambda p: "/casino/" in p)
    assert len(got) == len(paths)
    for path, (verdict, template) in got.items():
        assert verdict == ("block" if "/casino/" in path else "allow"), (path, template)
        assert template.endswith("/**") or not path.startswith("/good/"), (path, template)


def test_single_labels_make_no_templates(spark):
    paths = [f"/{a}{b}{c}" for a in "qrstuvwxyz" for b in "klmnopqrst" for c in "ghijk"]
    got = judged(spark, paths, lambda p: p.endswith("g") and p[1] == "q")  # 10 of 500
    assert {t for _, t in got.values()} == {"/*"}


def pages(spark, rows):
    return spark.createDataFrame([(*r, *"cccc") for r in rows], f"page_id long, url string, html string, {CLASH}")


def test_round_trip(spark):
    rows = [(i, f"http://h/{i}", prose(i % 30, 40 + 700 * (i % 3))) for i in range(120)]
    rows += [(200, None, None), (201, "u", ""), (202, "a b\r\nc", "é" * 40_000), (203, "u", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rows += [(7, "http://h/7", rows[7][2]), (None, "u", rows[3][2]), (204, "u", "x" * 16_384), (205, "u", "日本" * 9000)]
    path = new_area(spark, "warc_test")
    warc.write_archives(pages(spark, rows), path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    first = defaultdict(list)
    for i, _, html in rows:
        if i is not None:
            first[html or ""].append(i)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        own = min(first[html or ""])
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        same = i == own
        expected.append((i, len(data), digest, "response" if same else "revisit", None if same else own))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)


def test_small_payloads_may_all_be_responses(spark):
    path = new_area(spark, "warc_test")
    warc.write_archives(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), path, 3)
    found = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, path).collect()}
    assert found == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    path = new_area(spark, "warc_test")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def test_lost_segments_are_noticed(spark, tmp_path):
    texts = list(warc.records_of(1, "u", prose(1, 20_000).encode(), None, "x"))
    assert len(texts) > 3
    for name, kept in (("last", texts[:-1]), ("middle", texts[:1] + texts[2:])):
        folder = Path(tmp_path, name)
        folder.mkdir()
        Path(folder, "a.gz").write_bytes(gzip.compress("".join(f"{t}\r\n" for t in kept).encode()))
        rows = warc.read_archives(spark, f"file://{folder}").collect()
        assert [r["verified"] for r in rows] == [False]


@pytest.mark.parametrize("size", [0, 1, 4096, 4097, 16_000, 100_000])
def test_framing(size):
    payload = ("ü" * size).encode()[:size].decode(errors="ignore").encode()
    assert warc.payload_of(warc._http(payload)) == payload
