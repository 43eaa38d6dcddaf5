"""Facts about Spark that the library relies on; a change should fail here first."""

import json

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Observation
from pyspark.sql import functions as F

PARTS = "SELECT id, id % 3 AS p FROM range(30)"


def test_create_or_replace_as_select_is_not_there(spark, pair):
    pair.make(pair.src("t"), PARTS)
    with pytest.raises(AnalysisException):
        spark.sql(f"REPLACE TABLE {pair.sql(pair.src('t'))} USING parquet AS {PARTS}")


def test_platform_statements_do_not_parse(spark):
    for statement in ("CREATE TABLE a DEEP CLONE b", "CONVERT TO DELTA a", "SHOW EXTERNAL LOCATIONS"):
        with pytest.raises(ParseException):
            spark.sql(statement)


def test_external_partitioned_table_reads_empty_until_repaired(spark, pair):
    location = pair.area("t")
    spark.sql(PARTS).write.partitionBy("p").parquet(location)
    name = pair.sql(pair.src("t"))
    spark.sql(f"CREATE TABLE {name} (id BIGINT, p BIGINT) USING parquet PARTITIONED BY (p) LOCATION '{location}'")
    assert spark.table(name).count() == 0
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert spark.table(name).count() == 30
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(location).count() == 30


def test_repair_of_an_unpartitioned_table_fails(spark, pair):
    pair.make(pair.src("t"), PARTS)
    with pytest.raises(AnalysisException):
        spark.sql(f"MSCK REPAIR TABLE {pair.sql(pair.src('t'))}")


def test_create_like_drops_properties_and_comment(spark, pair):
    pair.make(pair.src("t"), PARTS, "USING parquet PARTITIONED BY (p) COMMENT 'c' TBLPROPERTIES ('k' = 'v')")
    spark.sql(f"CREATE TABLE `src__{pair.schema}`.u LIKE `src__{pair.schema}`.t")
    about = json.loads(spark.sql(f"DESCRIBE EXTENDED {pair.sql(pair.src('u'))} AS JSON").first()[0])
    assert about["partition_columns"] == ["p"]
    assert not about.get("comment") and "k" not in about.get("table_properties", {})


def test_the_hash_skips_nulls(spark):
    row = spark.sql(
        "SELECT xxhash64(NULL, 1) = xxhash64(1, NULL), xxhash64(array(1, NULL)) = xxhash64(array(NULL, 1))"
    ).first()
    assert tuple(row) == (True, True)


def test_saving_makes_columns_nullable(spark, pair):
    pair.make(pair.src("t"), "SELECT id FROM range(1)")
    assert not spark.range(1).schema["id"].nullable
    assert spark.table(pair.sql(pair.src("t"))).schema["id"].nullable


def test_observation_counts_what_is_written(spark, pair):
    observation = Observation()
    frame = spark.range(0, 1000, 1, 7).observe(observation, F.count(F.lit(1)).alias("n"))
    frame.write.saveAsTable(pair.sql(pair.src("t")))
    assert observation.get == {"n": 1000}


def test_a_table_may_be_a_single_file(spark, pair, testdata):
    name = pair.sql(pair.src("nation"))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{testdata}/nation.parquet'")
    assert spark.table(name).count() == 25
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(f"{testdata}/nation.parquet").count() == 25


def test_listing_files_reads_no_content(spark, testdata):
    frame = spark.read.format("binaryFile").load(f"{testdata}/nation.parquet").select("path", "length")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
