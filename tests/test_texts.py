"""View texts, DDL texts, property strings and paths."""

import pytest
from pyspark.sql import functions as F

from tablemove.functions import ddl
from tablemove.functions.paths import ancestors, between
from tablemove.functions.properties import parse_properties
from tablemove.functions.viewtext import mentions, rewrite


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("SELECT * FROM src.s.t", "SELECT * FROM dst.s.t"),
        ("SELECT * FROM `src`.`s`.`t`", "SELECT * FROM dst.`s`.`t`"),
        ("SELECT 'src.x' FROM src.s.t", "SELECT 'src.x' FROM dst.s.t"),
        ("SELECT 'it\\'s src.x', \"src.y\" FROM src.s.t", "SELECT 'it\\'s src.x', \"src.y\" FROM dst.s.t"),
        ("SELECT 'a''src.x' FROM src.s.t", "SELECT 'a''src.x' FROM dst.s.t"),
        ("SELECT my_src.x, src_2.y, t.src.z FROM src.s.t", "SELECT my_src.x, src_2.y, t.src.z FROM dst.s.t"),
        ("SELECT 1 -- src.x\nFROM src.s.t /* src.y */", "SELECT 1 -- src.x\nFROM dst.s.t /* src.y */"),
        ("SELECT src FROM a.b", "SELECT src FROM a.b"),
        ("SELECT a-src.s.f(b)/src.s.g(c)", "SELECT a-dst.s.f(b)/dst.s.g(c)"),
        ("SELECT `a'b` FROM src.s.t WHERE c = 'x'", "SELECT `a'b` FROM dst.s.t WHERE c = 'x'"),
        ("SELECT 'open FROM src.s.t", "SELECT 'open FROM dst.s.t"),
    ],
)
def test_rewrite(spark, text, expected):
    assert one(spark, rewrite(F.lit(text), "src", "dst")) == expected


def test_rewrite_folded(spark):
    text = "SELECT 'src__x' FROM spark_catalog.`src__s`.t JOIN src__r.u JOIN my_src__q.v"
    expected = "SELECT 'src__x' FROM spark_catalog.`dst__s`.t JOIN dst__r.u JOIN my_src__q.v"
    assert one(spark, rewrite(F.lit(text), "src", "dst", folded=True)) == expected


def test_rewrite_long_texts(spark):
    text = "SELECT " + ", ".join(f"'src.{i}' AS `c{i}`" for i in range(3000)) + " FROM src.s.t"
    got = one(spark, rewrite(F.lit(text), "src", "dst"))
    assert got == text.replace("FROM src.", "FROM dst.")


def test_rewrite_names_with_special_characters(spark):
    assert one(spark, rewrite(F.lit("FROM a$b.s.t"), "a$b", "c$1")) == "FROM c$1.s.t"


def test_mentions(spark):
    assert one(spark, mentions(F.lit("SELECT 1 FROM src.s.t"), "src"))
    assert not one(spark, mentions(F.lit("SELECT 'src.x' FROM dst.s.t -- src.y"), "src"))


def decomposed(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, createtab_stmt string")
    return [r.asDict() for r in ddl.decompose(frame).orderBy("id").collect()]


def test_ddl_of_a_real_table(spark, pair):
    name = pair.src("t")
    location = pair.area()
    spark.sql(
        f"CREATE TABLE {pair.sql(name)} (a INT COMMENT 'it''s (x)\\nUSING csv', b DECIMAL(10,2), "
        "`we ' ird` STRING, c ARRAY<STRUCT<x: INT, y: MAP<STRING, INT>>>) USING parquet "
        f"OPTIONS ('k1' = 'v)1') PARTITIONED BY (b) COMMENT 'about; USING orc' LOCATION '{location}' "
        "TBLPROPERTIES ('p' = 'q)z', 'r' = 's=t')"
    )
    text = spark.sql(f"SHOW CREATE TABLE {pair.sql(name)}").first()[0]
    (got,) = decomposed(spark, text)
    assert got["object_type"] == "table"
    assert got["full_table_name"].endswith(".t")
    assert got["table_schema"].startswith("a INT COMMENT 'it\\'s (x)\nUSING csv', `we ' ird` STRING")
    assert got["table_schema"].count("DECIMAL(10,2)") == 1 and "y: MAP<STRING, INT>" in got["table_schema"]
    assert (got["using"], got["partition_by"], got["cluster_by"]) == ("parquet", "b", "")
    assert got["comment"] == "about; USING orc"
    assert got["location"].endswith(location)
    assert got["properties_map"] == {"p": "q)z", "r": "s=t"}
    assert got["options_map"] == {"k1": "v)1"}
    assert got["partition_cols"] == ["b"]
    assert got["dynamic_ddl"] == (
        "CREATE TABLE <<full_table_name>> (<<schema>>) USING <<using>> OPTIONS (<<options>>) "
        "PARTITIONED BY (<<partition_by>>) COMMENT '<<comment>>' LOCATION '<<location>>' "
        "TBLPROPERTIES (<<table_properties>>)"
    )
    assert "\n" not in got["original_ddl"]


def test_ddl_of_buckets_clusters_and_views(spark, pair):
    bucketed, clustered, view = pair.src("b"), pair.src("c"), pair.src("v")
    spark.sql(f"CREATE TABLE {pair.sql(bucketed)} (a INT, b INT) USING parquet CLUSTERED BY (a) INTO 4 BUCKETS")
    spark.sql(f"CREATE TABLE {pair.sql(clustered)} (a INT, b INT) USING parquet CLUSTER BY (a)")
    spark.sql(
        f"CREATE VIEW {pair.sql(view)} COMMENT 'vc' AS SELECT a, 'x' AS l FROM {pair.sql(bucketed)}\n"
        "WHERE b > 0"
    )
    texts = [spark.sql(f"SHOW CREATE TABLE {pair.sql(n)}").first()[0] for n in (bucketed, clustered, view)]
    b, c, v = decomposed(spark, *texts)
    assert (b["cluster_by"], b["buckets"], b["partition_by"]) == ("a", "4", "")
    assert (c["cluster_by"], c["partition_by"]) == ("a", "")
    assert (v["object_type"], v["comment"], v["using"]) == ("view", "vc", "")
    assert v["dynamic_ddl"].startswith("CREATE VIEW <<full_table_name>> (<<schema>>)")
    assert v["dynamic_ddl"].endswith("WHERE b > 0")


def test_ddl_without_clauses(spark):
    (got,) = decomposed(spark, "CREATE TABLE s.t (\n  a INT)")
    assert got["table_schema"] == "a INT"
    for clause in ("using", "location", "comment", "partition_by", "cluster_by", "table_properties", "options"):
        assert got[clause] == ""
    assert got["properties_map"] == {}


def test_view_body_is_not_searched_for_clauses(spark):
    text = "CREATE VIEW s.v (\n  a)\nAS SELECT a FROM t\nUSING nothing\nLOCATION 'x'"
    (got,) = decomposed(spark, text)
    assert (got["using"], got["location"]) == ("", "")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("[upgraded_to=a.b.c, owner=x]", {"upgraded_to": "a.b.c", "owner": "x"}),
        ("[owner=x, upgraded_to=a.b.c]", {"upgraded_to": "a.b.c", "owner": "x"}),
        ("[a=b=c]", {"a": "b=c"}),
        ("[]", {}),
        ("", {}),
        ("[k=v, w, l=m]", {"k": "v, w", "l": "m"}),
        ("[k=[x]]", {"k": "[x]"}),
        ("[k=1, k=2]", {"k": "1"}),
        ("[k=]", {"k": ""}),
    ],
)
def test_parse_properties(spark, text, expected):
    assert one(spark, parse_properties(F.lit(text))) == expected


def test_between_and_ancestors(spark):
    assert one(spark, between(F.lit("abfss://c@acct/x"), "//", "@")) == "c"
    assert one(spark, between(F.lit("nothing"), "//", "@")) is None
    assert one(spark, ancestors(F.lit("s3://b/x"))) == ["s3:", "s3:/", "s3://b", "s3://b/x"]
