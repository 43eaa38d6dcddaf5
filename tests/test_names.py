import pytest
from pyspark.sql import functions as F

from tablemove.functions.names import (
    ObjectName,
    literal,
    physical_schema,
    quote,
    split_names,
    split_names_column,
    table_sql,
    target_name_column,
    target_of,
)


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("c.s.t", ("c", "s", "t")),
        ("s.t", ("spark_catalog", "s", "t")),
        ("`a.b`.`s`.`t``x`", ("a.b", "s", "t`x")),
    ],
)
def test_parse(text, parts):
    assert ObjectName.parse(text) == ObjectName(*parts)


@pytest.mark.parametrize("text", ["", "t", "a.b.c.d", "a..b", "a.b.", "`a.b"])
def test_parse_rejects(text):
    with pytest.raises(ValueError):
        ObjectName.parse(text)


def test_quote_and_literal(spark):
    assert quote("a`b") == "`a``b`"
    tricky = "it's a \\ back'slash"
    assert spark.sql(f"SELECT {literal(tricky)}").first()[0] == tricky


def test_unregistered_catalogs_fold(spark):
    assert physical_schema(spark, "src", "s") == ("spark_catalog", "src__s")
    assert physical_schema(spark, "spark_catalog", "s") == ("spark_catalog", "s")
    assert table_sql(spark, "src.s.t") == "`spark_catalog`.`src__s`.`t`"


def test_target_defaults():
    source = ObjectName("src", "s", "t")
    assert target_of(source, "dst") == ObjectName("dst", "s", "t")
    assert target_of(source, "dst", "x", "y") == ObjectName("dst", "x", "y")
    with pytest.raises(ValueError):
        target_of(source, "")


LISTS = [
    ("", []),
    ("a", ["a"]),
    ("a,b", ["a", "b"]),
    ("a, b", ["a", "b"]),
    ("a,  b ,", ["a", "b"]),
    (" , a", ["a"]),
]


@pytest.mark.parametrize(("text", "names"), LISTS)
def test_split_names(text, names):
    assert split_names(text) == names


def test_split_names_column(spark):
    frame = spark.createDataFrame([(t,) for t, _ in LISTS], "t string")
    got = [r[0] for r in frame.select(split_names_column(F.col("t"))).collect()]
    assert got == [names for _, names in LISTS]


def test_target_name_column(spark):
    frame = spark.createDataFrame([("s", None), ("s", ""), ("s", " "), ("s", "t")], "s string, t string")
    got = [r[0] for r in frame.select(target_name_column(F.col("s"), F.col("t"))).collect()]
    assert got == ["s", "s", "s", "t"]
