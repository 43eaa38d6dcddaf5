import pytest
from pyspark.sql import functions as F

from tablemove.operators import drift, markers
from tablemove.sources import inventory as inv
from tablemove.sources.formats import available, effective_format, is_available, unsupported_columns
from tablemove.sources.schemas import derive_schemas, describe_schema, ensure_schema

PARQUET_SERDE = "org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe"
AVRO_SERDE = "org.apache.hadoop.hive.serde2.avro.AvroSerDe"


@pytest.fixture
def estate(spark, pair):
    pair.make(pair.src("a"), "SELECT 1 AS Type, 'x' AS `Table Properties`", "USING parquet TBLPROPERTIES ('k' = 'v')")
    pair.make(pair.src("b"), "SELECT 1 AS x", "USING orc")
    spark.sql(f"CREATE VIEW {pair.sql(pair.src('v'))} AS SELECT * FROM {pair.sql(pair.src('b'))}")
    spark.range(1).createOrReplaceTempView("a_temporary_view")
    return pair


def names(frame):
    return sorted(r["name"] for r in frame.select("name").collect())


def test_listing(spark, estate):
    assert names(inv.list_objects(spark, "src", estate.schema)) == ["a", "b", "v"]
    assert names(inv.list_objects(spark, "src", estate.schema, kind="view")) == ["v"]
    assert names(inv.list_objects(spark, "src", estate.schema, kind="table")) == ["a", "b"]
    assert names(inv.list_objects(spark, "src", estate.schema, "a, v ,")) == ["a", "v"]
    with pytest.raises(ValueError):
        inv.list_objects(spark, "src", "")


def test_inventory(spark, estate):
    rows = {r["name"]: r for r in inv.inventory(spark, "src", estate.schema).collect()}
    assert rows["a"]["object_type"] == "MANAGED" and rows["a"]["properties"] == {"k": "v"}
    assert [c["name"] for c in rows["a"]["columns"]] == ["Type", "Table Properties"]
    assert rows["b"]["provider"] == "orc" and rows["b"]["location"]
    assert rows["v"]["object_type"] == "VIEW" and "SELECT * FROM" in rows["v"]["view_text"]
    assert names(inv.inventory(spark, "src", estate.schema, kind="view")) == ["v"]


def test_a_name_that_does_not_exist_is_an_error(spark, estate):
    with pytest.raises(ValueError, match="nothing"):
        inv.inventory(spark, "src", estate.schema, "a, nothing")


def test_a_view_without_its_table_is_still_listed(spark, estate):
    spark.sql(f"DROP TABLE {estate.sql(estate.src('b'))}")
    rows = {r["name"]: r for r in inv.inventory(spark, "src", estate.schema).collect()}
    assert rows["v"]["columns"] is None


def test_several_schemas_and_snapshot(spark, estate, monkeypatch):
    other = type(estate)(spark)
    other.make(other.src("z"), "SELECT 1 AS x")
    both = inv.inventory(spark, "src", [estate.schema, other.schema])
    assert names(both) == ["a", "b", "v", "z"]
    monkeypatch.setattr(inv, "CHUNK_OBJECTS", 2)
    spooled = inv.inventory(spark, "src", [estate.schema, other.schema])
    assert names(spooled) == names(both) and spooled.schema == inv.INVENTORY
    texts = inv.fetch_ddl(spark, [estate.src("a"), estate.src("b"), other.src("z")])
    assert texts.filter("createtab_stmt LIKE 'CREATE TABLE%'").count() == 3
    kept = inv.snapshot(spark, "src", f"{estate.schema}, {other.schema}", estate.area("inv"))
    assert names(kept) == names(both)
    assert kept.schema == inv.INVENTORY


def test_filter_names(spark, estate):
    frame = inv.inventory(spark, "src", estate.schema)
    assert names(inv.filter_names(frame, "a,b")) == ["a", "b"]
    assert names(inv.filter_names(frame, None)) == ["a", "b", "v"]


SERDES = [
    ("hive", PARQUET_SERDE, "parquet"),
    ("HIVE", AVRO_SERDE, "avro"),
    ("hive", "org.apache.hadoop.hive.ql.io.orc.OrcSerde", None),
    ("hive", None, None),
    ("PARQUET", None, "parquet"),
    ("delta", PARQUET_SERDE, "delta"),
]


def test_effective_format(spark):
    frame = spark.createDataFrame([s[:2] for s in SERDES], "provider string, serde string")
    got = [r["effective_format"] for r in inv.with_effective_format(frame).collect()]
    assert got == [s[2] for s in SERDES]
    for provider, serde, expected in SERDES:
        if expected:
            assert effective_format(provider, serde) == expected
        else:
            with pytest.raises(NotImplementedError):
                effective_format(provider, serde)


def test_formats(spark, testdata):
    assert available(spark)[:4] == ["parquet", "orc", "json", "csv"]
    assert not is_available(spark, "nosuchformat")
    schema = spark.read.parquet(f"{testdata}/embeddings.parquet").schema
    assert unsupported_columns("csv", schema) == ["embedding"] and unsupported_columns("orc", schema) == []


def record(name, provider="parquet", object_type="EXTERNAL", columns=(("a", "int"),), serde=None):
    row = {f.name: None for f in inv.INVENTORY} | {
        "schema": "s",
        "name": name,
        "provider": provider,
        "serde": serde,
        "object_type": object_type,
        "columns": [
            {"name": n, "type": t, "nullable": True, "comment": None, "pos": i} for i, (n, t) in enumerate(columns)
        ],
    }
    return row


def test_drift(spark):
    source = [
        record("missing"),
        record("same"),
        record("format"),
        record("case", provider="hive", serde=PARQUET_SERDE),
        record("schema"),
        record("order", columns=(("a", "int"), ("b", "int"))),
        record("managed"),
        record("unsupported", provider="hive", serde="other"),
        record("a_view", object_type="VIEW"),
        record("moved") | {"location": "file:/a/moved/"},
        record("here") | {"location": "file:///a/here"},
        record("parts") | {"partition_cols": ["P"], "options": {"path": "x"}},
        record("same_parts") | {"partition_cols": ["P"], "options": {"path": "x", "Sep": ","}},
        record("hidden"),
    ]
    target = [
        record("moved") | {"location": "file:/b/moved"},
        record("here") | {"location": "/a/here/"},
        record("parts") | {"partition_cols": []},
        record("same_parts") | {"partition_cols": ["p"], "options": {"sep": ","}},
        record("hidden", object_type="VIEW", provider=None),
        record("own_view", object_type="VIEW", provider=None),
        record("same"),
        record("format", provider="orc"),
        record("case", provider="PARQUET"),
        record("schema", columns=(("a", "bigint"),)),
        record("order", columns=(("b", "int"), ("a", "int"))),
        record("managed", provider="orc", object_type="MANAGED"),
        record("orphan"),
    ]
    found = drift.classify(spark.createDataFrame(source, inv.INVENTORY), spark.createDataFrame(target, inv.INVENTORY))
    assert {r["name"]: (r["action"], r["reason"]) for r in found.collect()} == {
        "missing": ("CREATE", "MISSING"),
        "same": ("IN_SYNC", None),
        "format": ("RECREATE", "FORMAT"),
        "case": ("IN_SYNC", None),
        "schema": ("RECREATE", "SCHEMA"),
        "order": ("RECREATE", "SCHEMA"),
        "managed": ("BLOCKED", "FORMAT"),
        "unsupported": ("BLOCKED", "UNSUPPORTED"),
        "orphan": ("ORPHAN", "MISSING"),
        "moved": ("RECREATE", "LOCATION"),
        "here": ("IN_SYNC", None),
        "parts": ("RECREATE", "LAYOUT"),
        "same_parts": ("IN_SYNC", None),
        "hidden": ("BLOCKED", "VIEW"),
    }


def test_markers(spark, pair):
    for name in ("up", "back", "both", "none"):
        pair.make(pair.src(name), "SELECT 1 AS x", "USING parquet TBLPROPERTIES ('z' = '1')")
    for name in ("up", "both"):
        markers.mark(spark, pair.src(name), "ctas", "dst.s.t", "CTAS")
    for name in ("back", "both"):
        markers.mark_rolled_back(spark, pair.src(name), "dst.s.t")
    frame = inv.inventory(spark, "src", pair.schema)
    assert names(markers.filter_marked(frame, "upgraded")) == ["both", "up"]
    assert names(markers.filter_marked(frame, "roll_backed")) == ["back", "both"]
    with pytest.raises(ValueError):
        markers.filter_marked(frame, "other")
    with pytest.raises(ValueError):
        markers.mark(spark, pair.src("up"), "ctas", "x", "y", style="other")
    markers.mark(spark, pair.src("none"), "sync", "dst.s.t", "it's", style="comment")
    comment = inv.describe(spark, pair.src("none"))["comment"]
    assert comment.startswith("Synced to dst.s.t by ") and "it's" in comment


def test_schemas(spark, pair):
    located = describe_schema(spark, "src", pair.schema)
    row = located.first()
    assert row["database"] == pair.schema and row["location"] == row["external_location"]
    derived = derive_schemas(located, "new").first()
    assert derived["target_location"] == f"{row['location']}/{pair.schema}"
    assert derived["target_comment"] == f"Migrated from src.{pair.schema} within the same location."
    ensure_schema(spark, "new", derived["target_schema"], derived["target_location"], derived["target_comment"])
    ensure_schema(spark, "new", derived["target_schema"])
    made = describe_schema(spark, "new", derived["target_schema"]).first()
    assert made["location"] == derived["target_location"]


def test_schema_on_local_storage_gets_the_default_location(spark):
    local = spark.createDataFrame([("src", "s", None)], "catalog string, database string, external_location string")
    slashed = spark.createDataFrame(
        [("src", "s", "abfss://c@h/x/")], "catalog string, database string, external_location string"
    )
    assert derive_schemas(local, "new").first()["target_location"] is None
    assert derive_schemas(slashed, "new").select(F.col("target_location")).first()[0] == "abfss://c@h/x/s"


@pytest.mark.parametrize("objects", [999, 1000, 1001])
def test_inventories_of_any_size_need_the_shared_folder_on_a_cluster(spark, monkeypatch, objects):
    chunk = inv.CHUNK_OBJECTS
    rows = [("c", "s", f"t{i}", "x") for i in range(objects)]
    chunks = [rows[i : i + chunk] for i in range(0, objects, chunk)]
    found = inv._spooled(spark, iter(chunks), inv.DDL_TEXTS)
    assert sorted(r["name"] for r in found.collect()) == sorted(r[2] for r in rows)

    def refuse(*_):
        raise ValueError("set spark.checkpoint.dir")

    monkeypatch.setattr(inv, "new_area", refuse)
    with pytest.raises(ValueError, match="checkpoint"):
        inv._spooled(spark, iter(chunks), inv.DDL_TEXTS)


def test_names_are_found_in_any_case(spark, pair):
    pair.make(pair.src("orders"), "SELECT 1 AS x")
    listed = inv.list_objects(spark, "src", pair.schema, "Orders, NONE")
    assert [r["name"] for r in listed.collect()] == ["orders"]
