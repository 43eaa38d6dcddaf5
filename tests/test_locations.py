import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablemove.functions.paths import PLATFORM_ROOT_SOURCES
from tablemove.operators import locations
from tablemove.operators.lookup import Lookup, fits_broadcast, lookup_join

ROOT = PLATFORM_ROOT_SOURCES[0]
MOUNTS = [
    ("/mnt/a", "abfss://one@acct.host/root/"),
    ("/mnt/a/b", "abfss://two@acct.host"),
    ("/mnt/ab", "abfss://one@acct.host/other"),
    ("/mnt/old", "wasbs://c@acct.host/x"),
    ("/mnt/s3", "s3a://bucket/x"),
    ("/mnt/root", ROOT),
    ("/mnt/clash", "abfss://one@elsewhere.host/x"),
]
EXTERNAL = [
    ("equal", "abfss://two@acct.host/"),
    ("parent", "abfss://one@acct.host"),
    ("child", "abfss://one@acct.host/root/deep"),
    ("lookalike", "abfss://one@acct.host/roo"),
]
OBJECTS = [
    (1, "table", "dbfs:/mnt/a/x"),
    (2, "table", "dbfs:/mnt/a/b/x%20y"),
    (3, "table", "dbfs:/mnt/ab/x"),
    (4, "table", "dbfs:/mnt/abc/x"),
    (5, "table", "dbfs:/user/hive/x"),
    (6, "schema", "dbfs:/user/hive/x"),
    (7, "table", "abfss://one@acct.host/root/deep/x"),
    (8, "schema", "abfss://nowhere@acct.host/x"),
    (9, "table", "dbfs:/mnt/root/x"),
    (10, "schema", "dbfs:/mnt/a"),
    (11, "table", None),
]


@pytest.fixture(scope="module")
def inputs(spark):
    return (
        spark.createDataFrame(OBJECTS, "id int, object_type string, location string"),
        spark.createDataFrame(MOUNTS, locations.MOUNTS),
        spark.createDataFrame(EXTERNAL, locations.EXTERNAL_LOCATIONS),
    )


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


SIZES = pytest.mark.parametrize("small", [None, True, False])


@SIZES
def test_resolve(inputs, small):
    objects, mounts, _ = inputs
    got = {r["id"]: (r["external_location"], r["resolution"]) for r in locations.resolve(objects, mounts, small).collect()}
    assert got == {
        1: ("abfss://one@acct.host/root/x", "RESOLVED"),
        2: ("abfss://two@acct.host/x y", "RESOLVED"),
        3: ("abfss://one@acct.host/other/x", "RESOLVED"),
        4: (None, "NEEDS_DATA_MOVEMENT"),
        5: (None, "NEEDS_DATA_MOVEMENT"),
        6: (None, "DEFAULT_LOCATION"),
        7: ("abfss://one@acct.host/root/deep/x", "UNCHANGED"),
        8: ("abfss://nowhere@acct.host/x", "UNCHANGED"),
        9: (None, "NEEDS_DATA_MOVEMENT"),
        10: ("abfss://one@acct.host/root", "RESOLVED"),
        11: (None, None),
    }


def test_resolve_without_mounts(inputs, spark):
    objects, _, _ = inputs
    empty = spark.createDataFrame([], locations.MOUNTS)
    got = locations.resolve(objects, empty).filter("id = 1").first()
    assert got["resolution"] == "NEEDS_DATA_MOVEMENT"


@SIZES
def test_mounted(inputs, small):
    objects, mounts, _ = inputs
    got = rows(locations.mounted(objects, mounts, small), "id", "mount_point")
    assert got == sorted([(1, "/mnt/a"), (2, "/mnt/a/b"), (3, "/mnt/ab"), (7, "/mnt/a"), (10, "/mnt/a")], key=repr)


def brute_force_pairs():
    for (point, source), (name, url) in itertools.product(MOUNTS, EXTERNAL):
        source, url = source.rstrip("/"), url.rstrip("/")
        if source == ROOT:
            continue
        if source == url:
            yield point, name, "EQUAL"
        elif url.startswith(source + "/"):
            yield point, name, "LOCATION_UNDER_MOUNT"
        elif source.startswith(url + "/"):
            yield point, name, "MOUNT_UNDER_LOCATION"


@SIZES
def test_coverage(inputs, small):
    _, mounts, external_locations = inputs
    expected = list(brute_force_pairs())
    covered = {point for point, _, _ in expected}
    expected += [
        (point, None, "NOT_COVERED")
        for point, source in MOUNTS
        if point not in covered and source != ROOT
    ]
    got = rows(locations.coverage(mounts, external_locations, small), "mount_point", "name", "coverage")
    assert got == sorted(expected, key=repr)


@SIZES
def test_ambiguous(inputs, small):
    _, mounts, external_locations = inputs
    assert rows(locations.ambiguous(mounts, external_locations, small), "mount_point", "n_locations") == [
        ("/mnt/a", 2)
    ]


@SIZES
def test_table_coverage(inputs, small):
    objects, mounts, external_locations = inputs
    got = locations.table_coverage(objects, mounts, external_locations, small)
    found = {r["id"]: (r["coverage"], r["external_location_name"]) for r in got.collect()}
    assert found[1] == ("AMBIGUOUS", None)
    assert found[2] == ("EQUAL", "equal")
    assert found[3] == ("MOUNT_UNDER_LOCATION", "parent")
    assert found[5] == ("NOT_COVERED", None)
    assert len(found) == len(OBJECTS)


@pytest.mark.parametrize("small", [True, False])
def test_random_paths_against_brute_force(spark, small):
    chance = random.Random(7)

    def path(deepest):
        return "/mnt/" + "/".join(chance.choice("abc") for _ in range(chance.randint(1, deepest)))

    mounts = {path(4): f"abfss://c{i}@h/x{i}" for i in range(25)}
    objects = [(i, "table", f"dbfs:{path(6)}") for i in range(400)]
    frame = spark.createDataFrame(objects, "id int, object_type string, location string")
    resolved = locations.resolve(frame, spark.createDataFrame(list(mounts.items()), locations.MOUNTS), small)
    got = {r["id"]: r["external_location"] for r in resolved.collect()}
    for i, _, location in objects:
        plain = location.removeprefix("dbfs:")
        above = [m for m in mounts if plain == m or plain.startswith(m + "/")]
        best = max(above, key=len, default=None)
        assert got[i] == (mounts[best] + plain[len(best):] if best else None)


def tables_on(spark, *points):
    return spark.createDataFrame([(i, f"dbfs:{p}/t") for i, p in enumerate(points)], "id int, location string")


@SIZES
def test_plan(inputs, spark, small):
    _, mounts, _ = inputs
    used = tables_on(spark, "/mnt/a", "/mnt/a", "/mnt/ab", "/mnt/a/b", "/mnt/old", "/mnt/s3", "/nowhere")
    got = rows(locations.plan(used, mounts, "p", small=small), "name", "url", "status", "comment")
    assert got == sorted(
        [
            (
                "p_ext_loc_one",
                "abfss://one@acct.host/",
                "PLANNED",
                "Created from mount point /mnt/a with mount source abfss://one@acct.host/root",
            ),
            (
                "p_ext_loc_two",
                "abfss://two@acct.host/",
                "PLANNED",
                "Created from mount point /mnt/a/b with mount source abfss://two@acct.host",
            ),
            (None, None, "REJECTED", "Created from mount point /mnt/old with mount source wasbs://c@acct.host/x"),
            (None, None, "REJECTED", "Created from mount point /mnt/s3 with mount source s3a://bucket/x"),
        ],
        key=repr,
    )


def test_plan_for_one_mount(inputs, spark):
    _, mounts, _ = inputs
    used = tables_on(spark, "/mnt/a/b", "/mnt/ab")
    got = rows(locations.plan(used, mounts, mount_point="/mnt/a/"), "name")
    assert got == [("_ext_loc_one",)]


def test_plan_reports_name_conflicts(inputs, spark):
    _, mounts, _ = inputs
    got = rows(locations.plan(tables_on(spark, "/mnt/a", "/mnt/clash"), mounts, "p"), "url", "status")
    assert [status for _, status in got] == ["NAME_CONFLICT", "NAME_CONFLICT"]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join_on_a_hot_key(spark, how):
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    side = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = lookup_join(hot, Lookup(side, False), ["k"], how)
    plain = hot.join(side, ["k"], how)
    columns = plain.columns
    assert rows(salted, *columns) == rows(plain, *columns)


def test_salting_spreads_copies_of_one_row(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("k"))
    side = spark.createDataFrame([(1, "x")], "k int, v string")
    plan = lookup_join(copies, Lookup(side, False), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "xxhash64" in plan


def test_fits_broadcast(spark):
    side = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("v"))
    assert fits_broadcast(side)
    assert not fits_broadcast(side, max_rows=99)
    assert not fits_broadcast(side, max_bytes=50_000)


@SIZES
def test_plain_mount_paths(spark, small):
    objects = spark.createDataFrame(
        [(1, "table", "/mnt/a/x"), (2, "table", "/user/y")], "id long, object_type string, location string"
    )
    mounts = spark.createDataFrame([("/mnt/a", "abfss://c@h")], locations.MOUNTS)
    found = locations.resolve(objects, mounts, small)
    got = {r["id"]: (r["external_location"], r["resolution"]) for r in found.collect()}
    assert got == {1: ("abfss://c@h/x", "RESOLVED"), 2: ("/user/y", "UNCHANGED")}


def test_conflicting_mounts_are_reported(spark):
    listed = [("/mnt/a", "abfss://c@s1"), ("/mnt/a/", "abfss://c@s2"), ("/mnt/b", None), ("/mnt/c", "abfss://c@s3")]
    mounts = spark.createDataFrame(listed, locations.MOUNTS)
    found = {r["mount_point"]: list(r["sources"]) for r in locations.mount_conflicts(mounts).collect()}
    assert found == {"/mnt/a": ["abfss://c@s1", "abfss://c@s2"], "/mnt/b": []}
    tables = spark.createDataFrame([(1, "table", "dbfs:/mnt/c/t")], "id long, object_type string, location string")
    planned = {(r["status"], r["reason"]) for r in locations.plan(tables, mounts, "p").collect()}
    assert planned == {("PLANNED", None), ("REJECTED", "mount point without a single source")}


def test_a_hot_mount_is_split(spark):
    """Urls below one mount, with sides that are not broadcast, don't end in one task."""
    mounts = spark.createDataFrame([("/mnt/a", "abfss://c@h/a"), ("/mnt/b", "abfss://c@h/b")], locations.MOUNTS)
    urls = spark.range(4000).selectExpr("cast(id as string) AS name", "concat('abfss://c@h/a/', id) AS url")
    found = locations.coverage(mounts, urls, small=False)
    assert found.select("mount_point", "coverage").distinct().count() == 2
    assert found.filter("coverage = 'LOCATION_UNDER_MOUNT'").count() == 4000
