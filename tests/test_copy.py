import os

import pytest

from tablemove.operators import convert, copy
from tablemove.operators.outcome import FAILED, SUCCESS
from tablemove.operators.validate import assert_equal
from tablemove.sources.inventory import EXTERNAL, MANAGED, describe, exists

PARTS = "SELECT id, CAST(id % 3 AS INT) AS p, CAST(id AS STRING) AS s FROM range(90)"


def ok(outcome):
    assert outcome.status_code == SUCCESS, outcome.description
    return outcome


def leftovers(spark, pair, catalog):
    listed = spark.sql(f"SHOW TABLES IN `{catalog}__{pair.schema}`").collect()
    return [r["tableName"] for r in listed if "__staging_" in r["tableName"] or "__old_" in r["tableName"]]


def test_ctas_inherits_clauses(spark, pair):
    source = pair.make(
        pair.src("t"),
        PARTS,
        "USING parquet OPTIONS ('compression' = 'gzip') PARTITIONED BY (p) COMMENT 'it''s mine' "
        "TBLPROPERTIES ('team' = 'me', 'upgraded_to' = 'old.mark')",
    )
    outcome = ok(copy.ctas(spark, source, pair.dst("t")))
    about = describe(spark, pair.dst("t"))
    assert about["object_type"] == MANAGED
    assert about["partition_cols"] == ["p"]
    assert about["comment"] == "it's mine"
    assert about["properties"]["team"] == "me"
    assert "upgraded_to" not in about["properties"]
    assert about["options"]["compression"] == "gzip"
    assert (outcome.source_rows, outcome.target_rows) == (90, 90)
    marks = describe(spark, source)["properties"]
    assert marks["upgraded_to"] == str(pair.dst("t"))
    assert {"upgraded_by", "upgraded_at", "upgraded_type"} <= set(marks)


def test_ctas_inherits_clustering_and_buckets(spark, pair):
    clustered, bucketed = pair.src("c"), pair.src("b")
    spark.sql(f"CREATE TABLE {pair.sql(clustered)} (a BIGINT, b STRING) USING parquet CLUSTER BY (a)")
    spark.sql(f"INSERT INTO {pair.sql(clustered)} SELECT id, 'x' FROM range(9)")
    pair.make(bucketed, PARTS, "USING parquet CLUSTERED BY (id) SORTED BY (s) INTO 3 BUCKETS")
    for source in (clustered, bucketed):
        ok(copy.ctas(spark, source, pair.dst(source.name)))
        assert_equal(spark, source, pair.dst(source.name), "diff")
    assert describe(spark, pair.dst("c"))["cluster_cols"] == ["a"]
    about = describe(spark, pair.dst("b"))
    assert (about["n_buckets"], about["bucket_cols"], about["sort_cols"]) == (3, ["id"], ["s"])


def test_user_clauses_win(spark, pair):
    source = pair.make(pair.src("t"), PARTS, "USING parquet PARTITIONED BY (p) COMMENT 'old'")
    ok(
        copy.ctas(
            spark,
            source,
            pair.dst("t"),
            select=["id * 2 AS twice", "s"],
            partition_by=["s"],
            fmt="orc",
            options={"compression": "zlib"},
            properties={"a": "b"},
            comment="new",
        )
    )
    about = describe(spark, pair.dst("t"))
    assert (about["provider"], about["partition_cols"], about["comment"]) == ("orc", ["s"], "new")
    assert about["properties"]["a"] == "b" and about["options"]["compression"] == "zlib"
    assert pair.rows(pair.dst("t"))[1] == (2, "1")


def test_projection_without_the_partition_column(spark, pair):
    source = pair.make(pair.src("t"), PARTS, "USING parquet PARTITIONED BY (p)")
    ok(copy.ctas(spark, source, pair.dst("t"), select=["id"]))
    assert describe(spark, pair.dst("t"))["partition_cols"] == []


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("partition_by", [None, ["p"]])
@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_round_trip_twice(spark, pair, fmt, partition_by, external):
    source = pair.make(pair.src("t"), PARTS)
    location = pair.area("t") if external else None
    for _ in range(2):
        outcome = ok(copy.ctas(spark, source, pair.dst("t"), partition_by=partition_by, fmt=fmt, location=location))
    assert outcome.description == "target replaced"
    assert_equal(spark, source, pair.dst("t"), "diff")
    about = describe(spark, pair.dst("t"))
    assert about["object_type"] == (EXTERNAL if external else MANAGED)
    if external:
        assert about["location"].removeprefix("file:").startswith(location)
    assert leftovers(spark, pair, "dst") == []


def test_fresh_external_target_is_where_it_was_asked_for(spark, pair):
    source, location = pair.make(pair.src("t"), PARTS), pair.area("t")
    ok(copy.ctas(spark, source, pair.dst("t"), location=location))
    assert describe(spark, pair.dst("t"))["location"].removeprefix("file:") == location


def test_values_survive_text_formats(spark, pair):
    source = pair.make(
        pair.src("t"),
        """SELECT * FROM VALUES (1, ' lead', TIMESTAMP_NTZ'2024-01-01 01:02:03.000001', 0.1D),
           (2, 'a\\nb,"c" \\\\ d', NULL, CAST('NaN' AS DOUBLE)), (3, '', NULL, -1e300D), (4, NULL, NULL, NULL)
           AS v(i, s, ts, d)""",
    )
    for fmt in ("csv", "json"):
        ok(copy.ctas(spark, source, pair.dst(fmt), fmt=fmt))
        assert_equal(spark, source, pair.dst(fmt), "diff")


def test_a_format_that_cannot_hold_the_types_is_refused(spark, pair):
    source = pair.make(pair.src("t"), "SELECT id, array(id) AS a FROM range(3)")
    outcome = copy.ctas(spark, source, pair.dst("t"), fmt="csv")
    assert outcome.status_code == FAILED and "cannot hold columns a" in outcome.description
    assert not exists(spark, pair.dst("t"))
    assert copy.ctas(spark, source, pair.dst("t"), fmt="nosuchformat").status_code == FAILED


def test_a_failed_check_keeps_the_old_target(spark, pair, monkeypatch):
    source = pair.make(pair.src("t"), PARTS)
    ok(copy.ctas(spark, source, pair.dst("t"), partition_by=["p"]))
    before = pair.rows(pair.dst("t"))

    def differ(*_):
        raise AssertionError("contents differ")

    monkeypatch.setattr(copy, "require_equal", differ)
    outcome = copy.ctas(spark, source, pair.dst("t"), select=["id"])
    assert outcome.status_code == FAILED and "differ" in outcome.description
    assert pair.rows(pair.dst("t")) == before
    assert leftovers(spark, pair, "dst") == []


def test_a_failed_swap_puts_the_old_target_back(spark, pair):
    old = pair.make(pair.dst("t"), PARTS, "USING parquet PARTITIONED BY (p)")
    staging = pair.make(pair.dst("t2"), PARTS + " WHERE id < 30", "USING parquet PARTITIONED BY (p)")
    with pytest.raises(AssertionError, match="holds 30 of 31 rows"):
        copy.swap(spark, staging, old, 31, True)
    assert pair.read(old).count() == 90
    assert pair.read(staging).count() == 30
    copy.drop(spark, staging)
    assert pair.read(old).count() == 90


@pytest.mark.parametrize("step", range(4))
def test_every_failing_step_of_a_swap_is_undone(spark, pair, monkeypatch, step):
    old = pair.make(pair.dst("t"), PARTS, "USING parquet PARTITIONED BY (p)")
    staging = pair.make(pair.dst("t2"), PARTS + " WHERE id < 30", "USING parquet PARTITIONED BY (p)")
    calls = []

    def failing(name):
        plain = getattr(copy, name)

        def run(*arguments):
            calls.append(name)
            if len(calls) - 1 == step:
                raise RuntimeError(f"planted in {name}")
            return plain(*arguments)

        return run

    with monkeypatch.context() as patch:
        # The steps of a swap: rename, its repair, rename, its repair. The count after them has its own test.
        patch.setattr(copy, "rename", failing("rename"))
        patch.setattr(copy, "repair", failing("repair"))
        if step == 4:
            patch.setattr(copy, "rename", copy.rename)
        with pytest.raises((RuntimeError, AssertionError), match="planted|holds 30"):
            copy.swap(spark, staging, old, 31, True)
    assert pair.read(old).count() == 90 and pair.read(staging).count() == 30
    copy.swap(spark, staging, old, 30, True)
    assert pair.read(old).count() == 30 and not exists(spark, staging)


def test_a_failed_external_copy_can_be_repeated(spark, pair, monkeypatch):
    source, location = pair.make(pair.src("t"), PARTS), pair.area("t")

    def differ(*_):
        raise AssertionError("contents differ")

    for run in (copy.ctas, copy.clone):
        target = pair.dst(run.__name__)
        with monkeypatch.context() as patch:
            patch.setattr(copy, "require_equal", differ)
            assert run(spark, source, target, location=f"{location}/{target.name}").status_code == FAILED
        assert ok(run(spark, source, target, location=f"{location}/{target.name}")).target_rows == 90
    other = copy.clone(spark, source, pair.dst("other"), location=f"{location}/clone")
    assert other.status_code == FAILED and "is not empty" in other.description
    assert pair.read(pair.dst("clone")).count() == 90


def test_only_exact_markers_are_left_behind(spark, pair):
    source = pair.make(pair.src("t"), PARTS)
    mine = {"synced_hourly": "1", "cloned_from_team": "2", "upgraded_schema_version": "3", "mine": "4"}
    copy.markers.set_properties(spark, source, mine)
    ok(copy.ctas(spark, source, pair.dst("a")))
    ok(copy.clone(spark, pair.src("t"), pair.dst("b")))
    for name in ("a", "b"):
        properties = describe(spark, pair.dst(name))["properties"]
        assert mine.items() <= properties.items()
        assert not copy.markers.KEYS & properties.keys()


def test_dropping_the_old_version_leaves_the_new_files(spark, pair):
    source = pair.make(pair.src("t"), PARTS)
    for _ in range(3):
        ok(copy.ctas(spark, source, pair.dst("t"), partition_by=["p"]))
    location = describe(spark, pair.dst("t"))["location"].removeprefix("file:")
    assert sorted(d for d in os.listdir(location) if "=" in d) == ["p=0", "p=1", "p=2"]
    spark.catalog.refreshTable(pair.sql(pair.dst("t")))
    assert_equal(spark, source, pair.dst("t"), "diff")


def test_a_wrong_observation_does_not_refuse_a_right_copy(spark, pair, monkeypatch):
    source = pair.make(pair.src("t"), PARTS)
    monkeypatch.setattr(copy, "measured_fingerprint", lambda _: (91, 0, 0, 0, 0))
    assert ok(copy.ctas(spark, source, pair.dst("t"))).source_rows == 90


def test_source_is_target(spark, pair):
    source = pair.make(pair.src("t"), PARTS)
    assert copy.ctas(spark, source, source).status_code == FAILED
    assert copy.clone(spark, source, source).status_code == FAILED
    assert pair.read(source).count() == 90


def test_view_as_source_and_as_target(spark, pair):
    pair.make(pair.src("t"), PARTS)
    spark.sql(f"CREATE VIEW {pair.sql(pair.src('v'))} AS SELECT id FROM {pair.sql(pair.src('t'))}")
    ok(copy.ctas(spark, pair.src("v"), pair.dst("v")))
    assert pair.read(pair.dst("v")).count() == 90
    assert "is a view" in copy.ctas(spark, pair.src("t"), pair.src("v")).description
    assert "is a view" in copy.clone(spark, pair.src("v"), pair.dst("x")).description


def test_missing_source(spark, pair):
    outcome = copy.ctas(spark, pair.src("nothing"), pair.dst("t"))
    assert outcome.status_code == FAILED and outcome.description


def test_hot_partition_is_split(spark, pair, monkeypatch):
    """One partition value with nearly all rows is written by several tasks."""
    source = pair.make(pair.src("t"), "SELECT uuid() AS s, IF(id < 10, 1, 0) AS p FROM range(0, 40000, 1, 8)")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        ok(copy.ctas(spark, source, pair.dst("t"), partition_by=["p"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    location = describe(spark, pair.dst("t"))["location"].removeprefix("file:")
    files = [f for f in os.listdir(f"{location}/p=0") if f.endswith(".parquet")]
    assert len(files) > 1
    assert len([f for f in os.listdir(f"{location}/p=1") if f.endswith(".parquet")]) == 1


def test_same_partitions_are_not_shuffled(spark, pair):
    source = pair.make(pair.src("t"), PARTS, "USING parquet PARTITIONED BY (p)")
    about = describe(spark, source)
    schema = pair.read(source).schema
    assert not copy._layout(about, schema).rebalance
    assert copy._layout(about, schema, partition_by=["s"]).rebalance
    assert not copy._layout(about, schema, partition_by=["s"], rebalance=False).rebalance


@pytest.mark.parametrize("level", ["count", "fingerprint", "diff"])
def test_levels_of_checking(spark, pair, level):
    source = pair.make(pair.src("t"), PARTS)
    for step in (copy.ctas, copy.clone):
        outcome = ok(step(spark, source, pair.dst("t"), level=level))
        assert (outcome.source_rows, outcome.target_rows) == (90, 90)
    assert copy.clone(spark, source, pair.dst("u"), level="none").status_code == FAILED


def test_csv_without_texts_can_be_split(spark, pair):
    numbers = pair.make(pair.src("n"), "SELECT id FROM range(5)")
    ok(copy.ctas(spark, numbers, pair.dst("n"), fmt="csv"))
    assert "multiLine" not in describe(spark, pair.dst("n"))["options"]


def test_clone_keeps_metadata_but_not_the_description(spark, pair):
    spark.sql(
        f"CREATE TABLE {pair.sql(pair.src('t'))} (id BIGINT COMMENT 'the key', s STRING, p INT) USING parquet "
        "PARTITIONED BY (p) COMMENT 'about it' TBLPROPERTIES ('team' = 'me')"
    )
    spark.sql(f"INSERT INTO {pair.sql(pair.src('t'))} SELECT id, s, p FROM ({PARTS})")
    for location in (None, pair.area("c")):
        target = pair.dst("t" if location is None else "x")
        for _ in range(2):
            ok(copy.clone(spark, pair.src("t"), target, location))
        about = describe(spark, target)
        assert about["object_type"] == (EXTERNAL if location else MANAGED)
        assert about["columns"][0]["comment"] == "the key"
        assert about["partition_cols"] == ["p"]
        assert about["properties"]["team"] == "me" and "cloned_to" not in about["properties"]
        assert not about["comment"]
        assert_equal(spark, pair.src("t"), target, "diff")
    assert describe(spark, pair.src("t"))["properties"]["cloned_to"] == str(pair.dst("x"))


def test_clone_into_a_catalog_without_like(spark, pair, monkeypatch):
    source = pair.make(pair.src("t"), PARTS, "USING parquet PARTITIONED BY (p) TBLPROPERTIES ('team' = 'me')")
    monkeypatch.setattr(copy, "session_sql", lambda *_: None)
    ok(copy.clone(spark, source, pair.dst("t")))
    assert describe(spark, pair.dst("t"))["properties"]["team"] == "me"
    assert_equal(spark, source, pair.dst("t"), "diff")


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("partitioned", [False, True])
def test_convert(spark, pair, partitioned, external):
    clauses = "USING parquet" + (" PARTITIONED BY (p)" if partitioned else "")
    if external:
        clauses += f" LOCATION '{pair.area('t')}'"
    pair.make(pair.src("t"), PARTS, clauses + " COMMENT 'kept' TBLPROPERTIES ('team' = 'me')")
    before = describe(spark, pair.src("t"))
    reference = pair.make(pair.dst("r"), PARTS)
    outcome = ok(convert.convert_format(spark, pair.src("t"), "orc", analyze=True))
    assert outcome.action == "CONVERT" and outcome.target_rows == 90
    about = describe(spark, pair.src("t"))
    assert about["provider"] == "orc" and about["comment"] == "kept"
    assert about["object_type"] == before["object_type"]
    assert about["partition_cols"] == before["partition_cols"]
    assert about["properties"]["team"] == "me" and about["properties"]["converted_to"] == "ORC"
    assert_equal(spark, reference, pair.src("t"), "diff")
    again = ok(convert.convert_format(spark, pair.src("t"), "orc"))
    assert again.action == "IN_SYNC"
    assert leftovers(spark, pair, "src") == []


def test_convert_rejects_other_formats(spark, pair):
    pair.make(pair.src("t"), PARTS, "USING json")
    outcome = convert.convert_format(spark, pair.src("t"), "orc")
    assert outcome.status_code == FAILED and "table is json" in outcome.description
    pair.make(pair.src("u"), PARTS)
    outcome = convert.convert_format(spark, pair.src("u"))
    assert outcome.status_code == FAILED and "delta is not available" in outcome.description
    assert pair.read(pair.src("u")).count() == 90
