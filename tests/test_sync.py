"""External tables, views, incremental clones, batches and seeding."""

import shutil
from pathlib import Path

import pytest

from tablemove.functions.names import table_sql
from tablemove.operators import copy, external, views
from tablemove.operators.locations import MOUNTS
from tablemove.operators.outcome import FAILED, SUCCESS
from tablemove.operators.validate import assert_equal
from tablemove.plans import migrate, report
from tablemove.sources import estate
from tablemove.sources.inventory import describe, exists, inventory
from tablemove.streaming import incremental, resume

PARTS = "SELECT id, CAST(id % 3 AS INT) AS p FROM range(30)"


def ok(outcome):
    assert outcome.status_code == SUCCESS, outcome.description
    return outcome


@pytest.fixture
def source(pair):
    return pair.make(pair.src("t"), PARTS, f"USING parquet PARTITIONED BY (p) LOCATION '{pair.area('t')}'")


def test_sync_creates_then_is_in_sync(spark, pair, source):
    first = ok(external.sync(spark, source, pair.dst("t")))
    assert (first.action, first.source_rows, first.target_rows) == ("CREATE", 30, 30)
    assert describe(spark, pair.dst("t"))["object_type"] == "EXTERNAL"
    assert describe(spark, source)["properties"]["synced_to"] == str(pair.dst("t"))
    assert ok(external.sync(spark, source, pair.dst("t"))).action == "IN_SYNC"


def test_new_partitions_are_found_by_the_next_sync(spark, pair, source):
    ok(external.sync(spark, source, pair.dst("t")))
    spark.sql(f"INSERT INTO {pair.sql(source)} SELECT 99, 7")
    assert ok(external.sync(spark, source, pair.dst("t"))).action == "IN_SYNC"
    assert pair.read(pair.dst("t")).count() == 31


def test_repair_of_the_difference(spark, pair):
    """Names that need escapes, NULL, an empty folder and a partition elsewhere; a run in sync issues nothing."""
    location = pair.area("r")
    name = pair.make(pair.src("r"), "SELECT id, 'a %/+' || id % 2 AS p, id % 3 AS q FROM range(12)",
                     f"USING parquet PARTITIONED BY (p, q) LOCATION '{location}'")
    assert external.repair_difference(spark, name, location) == (0, 0)
    folder = Path(location.removeprefix("file:"))
    shutil.rmtree(next(folder.glob("p=*0/q=1")))
    for file in next(folder.glob("p=*1/q=2")).iterdir():
        file.unlink()  # the folder stays, and so does its partition
    spark.range(3).selectExpr("id", "'é=1' AS p", "7 AS q").write.mode("append").partitionBy("p", "q").parquet(location)
    elsewhere = pair.area("elsewhere")
    spark.range(2).write.parquet(elsewhere)
    spark.sql(f"ALTER TABLE {pair.sql(name)} ADD PARTITION (p = 'far', q = 1) LOCATION '{elsewhere}'")
    assert external.repair_difference(spark, name, location) == (1, 1)
    assert external.repair_difference(spark, name, location) == (0, 0)
    rows = pair.read(name)
    assert rows.filter("p = 'é=1' AND q = 7").count() == 3 and rows.filter("p = 'far'").count() == 2
    spark.sql("SELECT 1L AS id, CAST(NULL AS STRING) AS p, 1 AS q").write.mode("append").partitionBy("p", "q").parquet(location)
    external.repair_difference(spark, name, location)
    assert pair.read(name).filter("p IS NULL").count() == 1


def test_batch_sync_decides_by_one_plan(spark, pair, source, monkeypatch):
    other = pair.make(pair.src("o"), "SELECT 1 AS x", f"USING parquet LOCATION '{pair.area('o')}'")
    run = lambda **k: {o.target_full_name.rsplit(".", 1)[1]: o for o in migrate.sync_external(spark, "src", pair.schema, "dst", **k)}
    assert {o.action for o in run().values()} == {"CREATE"}
    with monkeypatch.context() as patch:
        # Tables in sync are described by the inventories alone.
        patch.setattr(external, "describe", lambda *_: 1 / 0)
        assert {o.action for o in run(tables="O, T").values()} == {"IN_SYNC"}
    copy.drop(spark, pair.dst("o"))
    views.create_view(spark, pair.dst("o"), "SELECT 1 AS x")
    found = run(on_error="continue")
    assert (found["o"].action, found["o"].status_code, found["t"].action) == ("BLOCKED", FAILED, "IN_SYNC")
    assert pair.rows(other) == [(1,)]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_drifted_external_target_is_created_again(spark, pair, source, fmt):
    schema = "id BIGINT" if fmt == "parquet" else "id BIGINT, p INT"
    spark.sql(f"CREATE TABLE {pair.sql(pair.dst('t'))} ({schema}) USING {fmt} LOCATION '{pair.area('old')}'")
    outcome = ok(external.sync(spark, source, pair.dst("t")))
    assert outcome.action == "RECREATE" and ("formats" in outcome.description) == (fmt == "json")
    assert_equal(spark, source, pair.dst("t"), "diff")
    assert [r["name"] for r in inventory(spark, "dst", pair.schema).collect()] == ["t"]


def test_drifted_managed_target_is_kept(spark, pair, source):
    pair.make(pair.dst("t"), "SELECT 1 AS other")
    outcome = external.sync(spark, source, pair.dst("t"))
    assert (outcome.status_code, outcome.action) == (FAILED, "BLOCKED")
    assert pair.rows(pair.dst("t")) == [(1,)]


def test_sync_through_mounts(spark, pair, source):
    """The catalog's location is replaced by the mount's source."""
    location = describe(spark, source)["location"].removeprefix("file:")
    folder, name = location.rsplit("/", 1)
    mounts = spark.createDataFrame([("/mnt/x", folder + "/")], MOUNTS)
    place = external.resolve_location(spark, {**describe(spark, source), "location": f"dbfs:/mnt/x/{name}"}, mounts)
    assert place == (location, "RESOLVED")
    ok(external.sync(spark, source, pair.dst("t"), place=place))
    blocked = external.sync(spark, source, pair.dst("u"), place=(None, "NEEDS_DATA_MOVEMENT"))
    assert blocked.status_code == FAILED and "data movement" in blocked.description


def test_register_without_schema(spark, pair, source):
    location = describe(spark, source)["location"]
    external.register(spark, pair.dst("t"), "parquet", location)
    assert pair.read(pair.dst("t")).count() == 30


def test_views_sync(spark, pair, source):
    schema = spark.sql(f"DESCRIBE SCHEMA `src__{pair.schema}`")
    assert schema.count() > 0
    ok(external.sync(spark, source, pair.dst("t")))
    v_z, a_v = pair.src("v_z"), pair.src("a_v")
    views.create_view(spark, v_z, f"SELECT id, 'src.x' AS l FROM {pair.sql(source)}")
    views.create_view(spark, a_v, f"SELECT count(*) AS n FROM {pair.sql(v_z)}")
    current = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    first = migrate.sync_views(spark, "src", pair.schema, "dst")
    assert sorted(o.action for o in first) == ["CREATE", "CREATE"]
    assert pair.rows(pair.dst("a_v")) == [(30,)]
    text = describe(spark, pair.dst("v_z"))["view_text"]
    assert "'src.x'" in text and f"dst__{pair.schema}" in text
    assert {o.action for o in migrate.sync_views(spark, "src", pair.schema, "dst")} == {"IN_SYNC"}
    views.create_view(spark, v_z, f"SELECT id, p FROM {pair.sql(source)}")
    again = {o.target_full_name.rsplit(".", 1)[1]: o.action for o in migrate.sync_views(spark, "src", pair.schema, "dst")}
    assert again == {"v_z": "REPLACE", "a_v": "IN_SYNC"}
    assert (spark.catalog.currentCatalog(), spark.catalog.currentDatabase()) == current


def test_views_are_created_in_the_order_of_their_references(spark, pair, source, monkeypatch):
    ok(external.sync(spark, source, pair.dst("t")))
    views.create_view(spark, pair.src("z"), f"SELECT id FROM {pair.sql(source)}")
    views.create_view(spark, pair.src("m"), f"SELECT id FROM {pair.sql(pair.src('z'))}")
    views.create_view(spark, pair.src("a"), f"SELECT m.id FROM {pair.sql(pair.src('m'))} m JOIN {pair.sql(pair.src('z'))}")
    tried = []
    plain = views.apply
    monkeypatch.setattr(views, "apply", lambda *v: tried.append(v[1].name) or plain(*v))
    outcomes = migrate.sync_views(spark, "src", pair.schema, "dst")
    assert [o.status_code for o in outcomes] == [SUCCESS] * 3
    assert tried == ["z", "m", "a"]


def test_views_into_another_schema_settle(spark, pair, source):
    ok(external.sync(spark, source, pair.dst("t")))
    views.create_view(spark, pair.src("v"), f"SELECT id FROM {pair.sql(source)}")
    run = lambda **more: migrate.sync_views(
        spark, "src", pair.schema, "dst", create_schema=True, target_schema=f"{pair.schema}_v", schema_comment="views", **more
    )
    assert [(o.action, o.status_code) for o in run()] == [("CREATE", SUCCESS)]
    assert [(o.action, o.status_code) for o in run()] == [("IN_SYNC", SUCCESS)]
    assert spark.table(f"`dst__{pair.schema}_v`.v").count() == 30
    views.create_view(spark, pair.src("x"), f"SELECT id FROM {pair.sql(source)}")
    copy.drop(spark, pair.dst("t"))
    spark.sql(f"DROP VIEW `dst__{pair.schema}_v`.v")
    assert [o.status_code for o in run(on_error="stop")] == [FAILED]
    assert [o.status_code for o in run()] == [FAILED] * 2


def test_sync_sees_another_location(spark, pair, source):
    other = pair.area("other")
    spark.sql(PARTS + " WHERE id < 3").write.partitionBy("p").parquet(other)
    external.register(spark, pair.dst("t"), "parquet", other, pair.read(source).schema, ["p"])
    assert pair.read(pair.dst("t")).count() == 3
    outcome = ok(external.sync(spark, source, pair.dst("t")))
    assert (outcome.action, pair.read(pair.dst("t")).count()) == ("RECREATE", 30)
    assert ok(external.sync(spark, source, pair.dst("t"))).action == "IN_SYNC"


def test_unqualified_names_are_looked_up_in_the_target(spark, pair, source):
    """They follow the view's own schema, never the caller's schema or temporary views."""
    ok(copy.ctas(spark, source, pair.dst("t"), select=["id", "'dst' AS side"]))
    session = spark.newSession()
    session.sql(f"USE `src__{pair.schema}`")
    session.sql("CREATE VIEW v AS SELECT count(*) AS n FROM t")
    session.sql("CREATE VIEW w AS SELECT count(side) AS n FROM (SELECT id AS side FROM t)")
    spark.range(5).createOrReplaceTempView("t")
    try:
        outcomes = migrate.sync_views(spark, "src", pair.schema, "dst")
    finally:
        spark.catalog.dropTempView("t")
    assert [o.status_code for o in outcomes] == [SUCCESS, SUCCESS]
    copy.drop(spark, source)
    assert pair.rows(pair.dst("v")) == [(30,)]


def test_view_over_a_missing_table_fails_alone(spark, pair, source):
    views.create_view(spark, pair.src("v1"), f"SELECT id FROM {pair.sql(source)}")
    views.create_view(spark, pair.src("v2"), "SELECT 1 AS x")
    outcomes = {o.source_full_name.rsplit(".", 1)[1]: o for o in migrate.sync_views(spark, "src", pair.schema, "dst")}
    assert outcomes["v1"].status_code == FAILED and outcomes["v2"].status_code == SUCCESS


def write(spark, body, location, mode="append"):
    spark.sql(body).write.mode(mode).partitionBy("p").parquet(location)


@pytest.fixture
def arriving(spark, pair):
    location = pair.area("arriving")
    write(spark, PARTS, location)
    external.register(spark, pair.src("e"), "parquet", location, spark.read.parquet(location).schema, ["p"])
    return location


def repaired(spark, pair):
    spark.sql(f"MSCK REPAIR TABLE {pair.sql(pair.src('e'))} SYNC PARTITIONS")


def test_incremental_clone(spark, pair, arriving):
    run = lambda: ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e"), level="diff"))
    assert run().description == "all files copied"
    assert (run().description, pair.read(pair.dst("e")).count()) == ("new files appended", 30)
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    repaired(spark, pair)
    assert (run().description, pair.read(pair.dst("e")).count()) == ("new files appended", 35)
    write(spark, "SELECT id, 1 AS p FROM range(3)", arriving, "overwrite")
    repaired(spark, pair)
    assert (run().description, pair.read(pair.dst("e")).count()) == ("changed files replaced", 3)
    assert run().description == "new files appended"


def crash(*_, **__):
    raise RuntimeError("driver lost")


def test_incremental_clone_goes_on_after_a_crash(spark, pair, arriving, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "publish", crash)
        assert incremental.clone_append(spark, pair.src("e"), pair.dst("e")).status_code == FAILED
    assert ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e"))).target_rows == 30
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    repaired(spark, pair)
    with monkeypatch.context() as patch:
        # Lost between writing the rows and recording their files.
        patch.setattr(incremental, "measured_fingerprint", crash)
        assert incremental.clone_append(spark, pair.src("e"), pair.dst("e")).status_code == FAILED
    outcome = ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    assert (outcome.description, outcome.target_rows) == ("new files appended", 5)
    assert_equal(spark, pair.src("e"), pair.dst("e"), "diff")


@pytest.mark.parametrize("step", ["_move_in", "_delete", "_mapped"])
def test_incremental_clone_puts_back_what_a_lost_run_left(spark, pair, arriving, monkeypatch, step):
    """Lost after some files moved in, before or after old ones went, and before the map was written."""
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    first, *_ = sorted(Path(arriving.removeprefix("file:")).rglob("p=1/*.parquet"))
    first.unlink()
    repaired(spark, pair)
    whole = getattr(incremental, step)

    def halfway(*arguments):
        whole(*arguments)
        crash()

    with monkeypatch.context() as patch:
        patch.setattr(incremental, step, halfway)
        assert incremental.clone_append(spark, pair.src("e"), pair.dst("e")).status_code == FAILED
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    assert_equal(spark, pair.src("e"), pair.dst("e"), "diff")
    assert ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e"))).target_rows == 0


def files_of(spark, name):
    location = describe(spark, name)["location"].removeprefix("file:")
    return {str(f): f.stat().st_mtime_ns for f in Path(location).rglob("*.parquet") if "_run_" not in str(f.parent)}


def test_only_files_of_changed_source_files_are_replaced(spark, pair):
    location = pair.area("many")
    for i in range(12):
        spark.range(100 * i, 100 * i + 50 + i).write.mode("append").parquet(location)
    external.register(spark, pair.src("m"), "parquet", location, spark.read.parquet(location).schema)
    run = lambda: ok(incremental.clone_append(spark, pair.src("m"), pair.dst("m"), level="diff"))
    run()
    before = files_of(spark, pair.dst("m"))
    stray = Path(next(iter(before))).parent / "of-another-writer.parquet"
    own = sorted(f for f in Path(location.removeprefix("file:")).glob("*.parquet") if f.stat().st_size)
    spark.range(7000, 7003).coalesce(1).write.parquet(f"{location}_one")
    new = next(Path(f"{location}_one".removeprefix("file:")).glob("*.parquet"))
    own[0].write_bytes(new.read_bytes())
    (own[0].parent / f".{own[0].name}.crc").unlink()
    own[1].unlink()
    stray.write_bytes(own[2].read_bytes())
    outcome = run()
    assert (outcome.description, outcome.target_rows) == ("changed files replaced", 3)
    after = files_of(spark, pair.dst("m"))
    untouched = {f for f in before if after.get(f) == before[f]}
    assert len(before) - len(untouched) <= 2 and str(stray) in after
    stray.unlink()
    spark.catalog.refreshTable(pair.sql(pair.dst("m")))
    assert_equal(spark, pair.src("m"), pair.dst("m"), "diff")


def test_stream_goes_on_with_the_clone(spark, pair, arriving):
    """Partition names with escapes, a removed file, and files the stream had seen before and after the clone."""
    write(spark, "SELECT id, 5 AS p FROM range(500, 503)", arriving)
    repaired(spark, pair)
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    schema, sink, before, after = spark.read.parquet(arriving).schema, *(pair.area(x) for x in ("sink", "a", "b"))

    def stream(folder, checkpoint):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)
        rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink, "parquet").awaitTermination()
        return spark.read.parquet(sink).count()

    assert stream(arriving, before) == 33
    shutil.rmtree(next(Path(arriving.removeprefix("file:")).glob("p=5")))
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    repaired(spark, pair)
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    seen = resume.continue_on_clone(spark, pair.dst("e"), before, after)
    assert seen == resume.seen_files(spark, before).select("path").distinct().filter("path NOT LIKE '%p=5%'").count()
    clone = describe(spark, pair.dst("e"))["location"]
    assert stream(clone, after) == 38 and stream(clone, after) == 38
    for checkpoint, name in ((before, pair.dst("e")), (pair.area("none"), pair.dst("e")), (before, pair.dst("nosuch"))):
        with pytest.raises(ValueError):
            resume.continue_on_clone(spark, name, checkpoint, after if checkpoint == before and name.name == "e" else pair.area("c"))


@pytest.mark.parametrize("clauses", ["USING parquet", "USING parquet PARTITIONED BY (p)", "USING orc", "USING csv"])
def test_new_columns_arrive_without_a_rebuild(spark, pair, clauses):
    src, dst = pair.src("w"), pair.dst("w")
    pair.make(src, "SELECT id, id % 2 AS p FROM range(10)", clauses)
    ok(incremental.clone_append(spark, src, dst))
    before = {f: t for f, t in files_of(spark, dst).items()}
    spark.sql(f"ALTER TABLE {pair.sql(src)} ADD COLUMNS (note STRING)")
    spark.sql(f"INSERT INTO {pair.sql(src)} (id, note, p) VALUES (100, 'new', 1)")
    outcome = ok(incremental.clone_append(spark, src, dst))
    assert (outcome.description, outcome.target_rows) == ("new files appended", 1)
    assert before.items() <= files_of(spark, dst).items()
    rows = {r["id"]: r["note"] for r in pair.read(dst).collect()}
    assert len(rows) == 11 and rows[100] == "new" and rows[3] is None
    assert_equal(spark, src, dst, "diff")
    spark.sql(f"DROP TABLE {pair.sql(src)}")
    pair.make(src, "SELECT CAST(id AS STRING) AS id, id % 2 AS p FROM range(5)", clauses)
    assert ok(incremental.clone_append(spark, src, dst)).description == "all files copied"
    assert_equal(spark, src, dst, "diff")


def test_buckets_and_strange_names_of_an_incremental_clone(spark, pair):
    src, dst = pair.src("b"), pair.dst("b")
    pair.make(src, "SELECT id, concat('a +%', id % 3) AS p FROM range(60)", "USING parquet PARTITIONED BY (p) CLUSTERED BY (id) INTO 3 BUCKETS")
    ok(incremental.clone_append(spark, src, dst, level="diff"))
    spark.sql(f"INSERT INTO {pair.sql(src)} VALUES (1000, 'a +%1'), (1001, 'é/x')")
    assert ok(incremental.clone_append(spark, src, dst, level="diff")).target_rows == 2
    assert_equal(spark, src, dst, "diff")
    assert pair.read(dst).filter("id = 17").count() == 1  # read by bucket


def test_rows_that_fail_their_check_are_taken_back(spark, pair, arriving, monkeypatch):
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    repaired(spark, pair)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "require_equal", crash)
        assert incremental.clone_append(spark, pair.src("e"), pair.dst("e")).status_code == FAILED
    assert pair.read(pair.dst("e")).count() == 30
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e"), level="diff"))
    assert_equal(spark, pair.src("e"), pair.dst("e"), "diff")


def test_failed_rebuild_keeps_the_clone(spark, pair, arriving):
    ok(incremental.clone_append(spark, pair.src("e"), pair.dst("e")))
    kept = pair.rows(pair.dst("e"))
    first, *others = sorted(Path(arriving.removeprefix("file:")).rglob("*.parquet"))
    first.unlink()
    others[0].write_bytes(b"PAR1 broken PAR1")
    assert incremental.clone_append(spark, pair.src("e"), pair.dst("e")).status_code == FAILED
    assert pair.rows(pair.dst("e")) == kept


def test_clone_of_an_incremental_clone_has_no_part_in_its_state(spark, pair, arriving):
    c1, c2 = pair.dst("c1"), pair.dst("c2")
    ok(incremental.clone_append(spark, pair.src("e"), c1))
    ok(copy.clone(spark, c1, c2))
    write(spark, "SELECT id, 9 AS p FROM range(100, 105)", arriving)
    repaired(spark, pair)
    assert incremental.clone_append(spark, pair.src("e"), c2).status_code == FAILED
    assert ok(incremental.clone_append(spark, pair.src("e"), c1)).description == "new files appended"
    assert (pair.read(c1).count(), pair.read(c2).count()) == (35, 30)
    state = describe(spark, c1)["properties"][copy.STATE_PROPERTY]
    spark.sql(f"ALTER TABLE {pair.sql(c2)} SET TBLPROPERTIES ('{copy.STATE_PROPERTY}' = '{state}')")
    assert "carries the state of" in incremental.clone_append(spark, pair.src("e"), c2).description


def test_incremental_clone_does_not_touch_other_tables(spark, pair, arriving):
    pair.make(pair.dst("e"), "SELECT 1 AS x")
    outcome = incremental.clone_append(spark, pair.src("e"), pair.dst("e"))
    assert outcome.status_code == FAILED and pair.rows(pair.dst("e")) == [(1,)]


def steps_of(log, *codes):
    def step(code):
        def run():
            log.append(code)
            outcome = copy.Outcome("test", None, str(code), "x")
            outcome.status_code = FAILED if code < 0 else SUCCESS
            return outcome

        return run

    return [step(code) for code in codes]


def test_batch_stops_at_the_first_failure(spark):
    log = []
    outcomes = report.run_batch(spark, steps_of(log, 1, -2, 3, 4), workers=1)
    assert [o.source_full_name for o in outcomes] == ["1", "-2"] and log == [1, -2]


def test_batch_goes_on_if_told_so(spark):
    outcomes = report.run_batch(spark, steps_of([], 1, -2, 3), on_error="continue")
    assert [o.status_code for o in outcomes] == [SUCCESS, FAILED, SUCCESS]
    with pytest.raises(ValueError):
        report.run_batch(spark, [], on_error="ignore")


def test_report_table(spark, pair, monkeypatch):
    monkeypatch.setattr(report, "FLUSH_ROWS", 2)
    table = pair.sql(pair.dst("report"))
    report.run_batch(spark, steps_of([], 1, 2, 3, 4, 5), report_table=table)
    assert spark.table(table).count() == 5
    assert report.to_frame(spark, []).count() == 0


def test_empty_schema_gives_an_empty_batch(spark, pair):
    assert migrate.copy_schema(spark, "src", pair.schema, "dst") == []
    assert migrate.sync_external(spark, "src", pair.schema, "dst") == []
    assert migrate.sync_views(spark, "src", pair.schema, "dst") == []


def test_argument_rules(spark, pair):
    with pytest.raises(ValueError, match="single source table"):
        migrate.copy_schema(spark, "src", pair.schema, "dst", tables="a, b", target_table="c")
    with pytest.raises(ValueError, match="single source table"):
        migrate.clone_schema(spark, "src", pair.schema, "dst", location="/x")
    with pytest.raises(ValueError, match="not found"):
        migrate.copy_schema(spark, "src", pair.schema, "dst", tables="nothing")
    with pytest.raises(ValueError):
        migrate.copy_schema(spark, "src", "", "dst")


def test_batches_over_a_schema(spark, pair):
    for name in ("a", "b", "c"):
        pair.make(pair.src(name), PARTS)
    copied = migrate.copy_schema(spark, "src", pair.schema, "new1", create_schema=True)
    cloned = migrate.clone_schema(spark, "src", pair.schema, "new2", "other", "a, c", create_schema=True)
    converted = migrate.convert_schema(spark, "new1", pair.schema, "orc")
    assert [o.status_code for o in copied + cloned + converted] == [SUCCESS] * 8
    assert exists(spark, f"new2.other.c") and not exists(spark, "new2.other.b")
    one = migrate.clone_schema(spark, "src", pair.schema, "new2", "other", "b", target_table="renamed")
    assert ok(one[0]).target_full_name == "new2.other.renamed"
    synced = migrate.sync_external(spark, "new1", pair.schema, "new3", create_schema=True)
    assert [o.action for o in synced] == ["CREATE"] * 3
    back = migrate.sync_external(spark, "new3", pair.schema, "new4", create_schema=True)
    assert [o.status_code for o in back] == [SUCCESS] * 3
    spark.sql("DROP SCHEMA new2__other CASCADE")


def test_seeding(spark, pair):
    pair.make(pair.src("a"), PARTS)
    pair.make(pair.src("b"), "SELECT array(1) AS x")
    made = estate.copy_schema(spark, "src", pair.schema, "dst", pair.schema, "orc", rename=lambda n: f"{n}_orc")
    assert [o.status_code for o in made] == [SUCCESS, SUCCESS]
    location = pair.area("ext")
    made = estate.copy_schema(spark, "src", pair.schema, "dst", pair.schema, "csv", location, on_error="continue")
    assert sorted(o.status_code for o in made) == [FAILED, SUCCESS]
    assert describe(spark, pair.dst("a"))["location"].endswith("/a")
    estate.make_view(spark, pair.dst("a"), pair.dst("v"))
    assert spark.table(table_sql(spark, pair.dst("v"))).count() == 30
    estate.drop_schemas(spark, "dst", [pair.schema])
    assert spark.read.csv(f"{location}/a").count() == 30


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_seeded_texts_take_less_space_than_their_rows(spark, pair, fmt):
    body = "SELECT id, repeat('a \"line\"\\n', 20) AS text, CAST(NULL AS STRING) AS none FROM range(20000)"
    source, location = pair.make(pair.src("t"), body), pair.area("seed")
    ok(estate.copy_table(spark, source, pair.dst("t"), fmt, location))
    files = list(Path(location.removeprefix("file:")).glob("part-*"))
    assert 0 < sum(f.stat().st_size for f in files) < 20_000 * 40
    assert assert_equal(spark, source, pair.dst("t")) == (20_000, 20_000)
    spark.sql(f"INSERT INTO {pair.sql(pair.dst('t'))} SELECT * FROM {pair.sql(source)}")
    assert pair.read(pair.dst("t")).distinct().count() == 20_000 and pair.read(pair.dst("t")).count() == 40_000
