"""The pipeline's stages, and every registered query on the smallest tables."""

import duckdb
import pytest
from helpers import edited, prose
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from check import rows_of
from registry import TABLES
from tablemove.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(testdata):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    return connection


def test_all_are_registered():
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, duck, testdata, name):
    frame = QUERIES[name](spark, testdata)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, answer.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_runs(spark, testdata, name):
    assert QUERIES[name](spark, testdata).count() > 0


def test_stages(spark, tmp_path):
    good = [prose(i, 120, 3000) for i in range(12)]
    item = prose(77, 30, 3000)
    shared = prose(88, 12, 3000)
    rows = [(i, f"{t}\n{shared}", "en", f"s{i % 3}", len(t)) for i, t in enumerate(good)]
    rows += [(20, "too short", "en", "s1", 9), (21, "a b c " * 60, "en", "s1", 360), (22, None, None, None, None)]
    rows += [(30, good[0] + "\nnew end of a copy", "en", "s0", 1), (31, edited(good[1], 1, 3), "en", "s0", 1)]
    rows += [(40, f"{good[3][:300]} {item}. {prose(90, 60, 3000)}", "en", "s2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, at, str(tmp_path))
        after.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
        seen[name] = {r["doc_id"]: r for r in at.collect()}
    assert set(seen["quality_rules"]) == {*range(12), 30, 31, 40}
    lined = seen["line_dedup"]
    assert set(lined) == set(seen["quality_rules"]) and lined[0]["text"].endswith(shared)
    assert all(shared not in lined[i]["text"] and lined[i]["n_chars"] == len(lined[i]["text"]) for i in range(1, 12))
    assert lined[30]["text"] == "new end of a copy"
    assert {*range(12), 30, 40} <= set(seen["near_dedup"])
    assert set(seen["near_dedup"]) - set(seen["benchmark_leaks"]) == {40}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in seen["mix_sources"].values())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, seen["mix_sources"].values()))
    assert whole.agg(F.sum("taken")).first()[0] > 0


def test_pipeline_on_odd_tables(spark, tmp_path):
    """NULLs in all columns, repeated rows, a very long text and clashing names; then no rows at all."""
    extra = ("row", "root", "id", "k1", "bucket", "template", "size", "copy", "grp", "at", "of")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    texts = [prose(i, 150, 3000) for i in range(6)] + [prose(50, 40_000, 9000)]
    rows = [(i, t, None, None if i % 2 else "s", None, *extra) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[3], "en", "s", 1, *extra), (None, None, None, None, None, *extra), (9, "", "", "", 0, *extra)]
    spark.createDataFrame([(1, None), (2, ""), (None, prose(99, 30, 9))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, given in (("some", rows), ("none", [])):
        docs = spark.createDataFrame(given, schema)
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = [(r["doc_id"], r["size"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()]
        # Of equal documents one keeps its lines, that with an id; of all that lose theirs, one stays without a text.
        assert sorted(got) == (sorted([(2, 0), *((i, len(t.split())) for i, t in enumerate(texts))]) if given else [])
