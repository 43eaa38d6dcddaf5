from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tablemove.functions.names import ObjectName, table_sql  # noqa: E402
from tablemove.sources.schemas import ensure_schema  # noqa: E402
from tablemove.sources.workspace import new_area, new_schema  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablemove-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


class Pair:
    """A source and a target schema of the same name, and tables in them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.schema = new_schema(spark, "src", "t")
        ensure_schema(spark, "dst", self.schema)

    def src(self, name: str) -> ObjectName:
        return ObjectName("src", self.schema, name)

    def dst(self, name: str) -> ObjectName:
        return ObjectName("dst", self.schema, name)

    def sql(self, name: ObjectName) -> str:
        return table_sql(self.spark, name)

    def read(self, name: ObjectName):
        return self.spark.table(self.sql(name))

    def rows(self, name: ObjectName) -> list[tuple]:
        return sorted(tuple(r) for r in self.read(name).collect())

    def area(self, label: str = "area") -> str:
        return new_area(self.spark, label)

    def make(self, name: ObjectName, body: str, clauses: str = "USING parquet") -> ObjectName:
        self.spark.sql(f"CREATE TABLE {self.sql(name)} {clauses} AS {body}")
        return name


@pytest.fixture
def pair(spark) -> Pair:
    return Pair(spark)


@pytest.fixture(scope="session")
def testdata() -> str:
    return TESTDATA
