"""Empty tables, unusual names and types, and hot keys."""

import pytest
from pyspark.sql import functions as F

from registry import lifecycle
from tablemove.functions.names import table_sql
from tablemove.functions.viewtext import rewrite
from tablemove.operators import convert, copy, external, validate
from tablemove.operators.outcome import SUCCESS
from tablemove.plans import migrate
from tablemove.sources.inventory import describe
from tablemove.streaming import incremental

PARTS = "SELECT id, CAST(id % 3 AS INT) AS p FROM range(30)"


def ok(outcome):
    assert outcome.status_code == SUCCESS, outcome.description
    return outcome


@pytest.mark.parametrize("partition_by", [None, ["p"]])
@pytest.mark.parametrize("body", [PARTS + " WHERE id < 0", "SELECT id, CAST(1 AS INT) AS p FROM range(0)"])
def test_empty_tables(spark, pair, body, partition_by):
    source = pair.make(pair.src("t"), body)
    for _ in range(2):
        outcome = ok(copy.ctas(spark, source, pair.dst("t"), partition_by=partition_by))
    assert (outcome.source_rows, outcome.target_rows) == (0, 0)
    ok(copy.clone(spark, pair.dst("t"), pair.dst("u")))
    ok(convert.convert_format(spark, pair.dst("u"), "orc"))
    ok(external.sync(spark, source, pair.dst("x")))
    assert pair.read(pair.dst("u")).count() == 0


def test_projection_that_filters_nothing_in(spark, pair):
    source = pair.make(pair.src("t"), PARTS)
    spark.sql(f"CREATE VIEW {pair.sql(pair.src('v'))} AS SELECT * FROM {pair.sql(source)} WHERE false")
    assert ok(copy.ctas(spark, pair.src("v"), pair.dst("v"))).target_rows == 0


ODD = "SELECT id AS `a b`, CAST(id % 2 AS INT) AS `p.q`, CAST(id AS STRING) AS `t``x`, id AS `select` FROM range(9)"


def test_unusual_column_names(spark, pair):
    source = pair.make(pair.src("o"), ODD)
    ok(copy.ctas(spark, source, pair.dst("a"), partition_by=["p.q"]))
    ok(copy.clone(spark, pair.dst("a"), pair.dst("b")))
    ok(external.sync(spark, pair.dst("a"), pair.dst("c")))
    ok(incremental.clone_append(spark, pair.dst("a"), pair.dst("d"), level="diff"))
    for name in "abcd":
        validate.assert_equal(spark, source, pair.dst(name), "diff")


@pytest.mark.parametrize("name", ["a b", "p.q", "select", "t`x"])
def test_a_conversion_that_loses_values_is_refused(spark, pair, name):
    """ORC files do not give every column name back; the check notices, the table stays."""
    source = pair.make(pair.src("o"), f"SELECT id AS `{name.replace('`', '``')}` FROM range(9)")
    outcome = convert.convert_format(spark, source, "orc")
    assert sorted(r[0] for r in pair.read(source).collect()) == list(range(9))
    assert describe(spark, source)["provider"] == ("orc" if outcome.status_code == SUCCESS else "parquet")
    assert outcome.status_code == SUCCESS or "differ" in outcome.description


def test_unusual_object_names(spark, pair):
    names = ["select", "with space", "ünïcode", "quo`te"]
    made = []
    for name in names:
        try:
            made.append(pair.make(pair.src(name), "SELECT 1 AS x").name)
        except Exception:  # the catalog may not take the name at all
            continue
    assert "select" in made
    assert [o.status_code for o in migrate.clone_schema(spark, "src", pair.schema, "dst")] == [SUCCESS] * len(made)


NESTED = """
    SELECT id, array(named_struct('a', id, 'b', array(NULL, id))) AS s, map('k', map(id, 1.5F)) AS m,
           CAST(NULL AS ARRAY<DOUBLE>) AS n, CAST('x' AS BINARY) AS b, DATE'2024-02-29' AS d,
           TIMESTAMP'2024-01-01 00:00:00.123456Z' AS ts, INTERVAL '1' DAY AS i, CAST(id AS TINYINT) AS t
    FROM range(20)
"""


def test_nested_types_survive_every_copy(spark, pair):
    source = pair.make(pair.src("n"), NESTED)
    ok(copy.ctas(spark, source, pair.dst("a")))
    ok(copy.clone(spark, source, pair.dst("b"), level="diff"))
    ok(convert.convert_format(spark, pair.dst("b"), "orc"))
    validate.assert_equal(spark, source, pair.dst("a"), "diff")
    validate.assert_equal(spark, source, pair.dst("b"), "diff")


def test_long_texts_do_not_overflow(spark):
    quoted = " ".join(f"`c{i}`" for i in range(50_000))
    escaped = "'" + "\\\\'" * 50_000 + "'"
    text = f"SELECT {quoted}, {escaped} /* {'x*' * 50_000} */ FROM src.s.t"
    got = spark.range(1).select(rewrite(F.lit(text), "src", "dst")).first()[0]
    assert got == text.replace("FROM src.", "FROM dst.")


def test_a_third_of_all_rows_being_copies(spark):
    """Copies are merged before the shuffle, so no task receives the hot group."""
    rows = spark.range(0, 90_000, 1, 16).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))
    changed = rows.unionByName(spark.range(7).select(F.lit(-1).cast("bigint").alias("x")))
    diff = validate.content_diff(rows, changed)
    assert [tuple(r) for r in diff.collect()] == [(-1, 30_000, 30_007)]
    assert not validate.take_fingerprint(rows) == validate.take_fingerprint(changed)


def test_rolled_back_copy_keeps_partitions(spark, pair):
    """A target that was replaced and is replaced again reads the newest files only."""
    source = pair.make(pair.src("t"), PARTS)
    ok(copy.ctas(spark, source, pair.dst("t"), partition_by=["p"]))
    ok(copy.ctas(spark, source, pair.dst("t"), select=["id", "9 AS p"], partition_by=["p"]))
    assert {r["p"] for r in pair.read(pair.dst("t")).select("p").distinct().collect()} == {9}
    assert describe(spark, pair.dst("t"))["partition_cols"] == ["p"]


def test_sums_beyond_a_bigint(spark, tmp_path):
    """The contents of synced tables whose sum no BIGINT holds; NULL keys are left out."""
    big = 3_000_000_000
    tables = {
        "customer": ("c_custkey bigint", [(1 << 62,), (1 << 62,), (None,)]),
        "nation": ("n_nationkey int", [(1,), (2,)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(big, big), (big, big), (7, None)]),
        "part": ("p_partkey bigint, p_size int", [(-big, 2_000_000_000), (-big, 2_000_000_000)]),
        "region": ("r_regionkey int", [(None,)]),
        "supplier": ("s_suppkey bigint, s_nationkey int", [(5, 3)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = lifecycle.sync_external_batch(spark, str(tmp_path))
    assert dict(found.dtypes)["content"] == "bigint"
    wrapped = lambda n: (n + (1 << 63)) % (1 << 64) - (1 << 63)
    sums = {"customer": 1 << 63, "nation": 3, "orders": 2 * big * big, "part": -4_000_000_000 * big, "supplier": 15}
    expected = {name: wrapped(n) for name, n in sums.items()} | {"region": None}
    assert {(r["name"], r["content"]) for r in found.collect()} == set(expected.items())


def test_rows_of_one_flag_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """A flag with most rows doesn't meet in one task that sorts them and writes one file."""
    lines = spark.range(40_000).selectExpr(
        "id * 7919 AS l_orderkey", "1 AS l_linenumber", "CAST(xxhash64(id) % 1000 AS DOUBLE) AS l_quantity",
        "CASE WHEN id % 100 = 0 THEN 'N' WHEN id % 100 = 1 THEN 'R' ELSE 'A' END AS l_returnflag",
    )
    lines.repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    files, clone_append = [], incremental.clone_append

    def spied(session, source, *rest, **named):
        files.append([r[0] for r in session.table(table_sql(session, source)).select("_metadata.file_path").distinct().collect()])
        return clone_append(session, source, *rest, **named)

    monkeypatch.setattr(incremental, "clone_append", spied)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        found = lifecycle.clone_incremental_rewrite(spark, str(tmp_path))
        counted = {r["l_returnflag"]: (r["n"], r["touched"]) for r in found.groupBy("l_returnflag", "touched").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counted == {"A": (39_200, False), "N": (400, True)}
    assert sum("l_returnflag=A" in f for f in files[0]) > 1
