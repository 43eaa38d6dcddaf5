"""Inventory of the tables and views of a catalog, as a DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from itertools import chain, islice

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.names import (
    ObjectName,
    require,
    schema_sql,
    split_names,
    table_sql,
)
from tablemove.sources.formats import effective_format_column
from tablemove.sources.workspace import new_area

COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("comment", T.StringType()),
        T.StructField("pos", T.IntegerType()),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("catalog", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("object_type", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("serde", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("view_text", T.StringType()),
        T.StructField("view_namespace", T.StringType()),
        T.StructField("partition_cols", T.ArrayType(T.StringType())),
        T.StructField("cluster_cols", T.ArrayType(T.StringType())),
        T.StructField("bucket_cols", T.ArrayType(T.StringType())),
        T.StructField("sort_cols", T.ArrayType(T.StringType())),
        T.StructField("n_buckets", T.IntegerType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("options", T.MapType(T.StringType(), T.StringType())),
        T.StructField("columns", T.ArrayType(COLUMN)),
    ]
)

DDL_TEXTS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("catalog", "schema", "name", "createtab_stmt")]
)

VIEW = "VIEW"
EXTERNAL = "EXTERNAL"
MANAGED = "MANAGED"

METADATA_THREADS = 8
CHUNK_OBJECTS = 1000


def list_objects(
    spark: SparkSession,
    catalog: str,
    schema: str,
    names: str | list[str] | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Names of a schema's objects; ``kind`` may be ``'view'`` or ``'table'``.

    Temporary views are left out. ``names`` is a list or a text such as ``"a, b"``.
    """
    require(catalog=catalog, schema=schema)
    where = schema_sql(spark, catalog, schema)
    listing = spark.sql(f"SHOW TABLES IN {where}").filter(~F.col("isTemporary")).select(
        F.col("tableName").alias("name")
    )
    if kind is not None:
        views = spark.sql(f"SHOW VIEWS IN {where}").filter(~F.col("isTemporary")).select(
            F.col("viewName").alias("name")
        )
        how = "left_semi" if kind.lower() == "view" else "left_anti"
        listing = listing.join(views, "name", how)
    wanted = split_names(names)
    if wanted:
        listing = listing.filter(F.lower("name").isin([w.lower() for w in wanted]))
    return listing.select(F.lit(catalog).alias("catalog"), F.lit(schema).alias("schema"), "name")


@lru_cache(maxsize=16)
def _plain_session(spark: SparkSession) -> SparkSession:
    """A session in which properties with ``url`` in their keys are shown, so that they can be copied."""
    session = spark.newSession()
    session.conf.set("spark.sql.redaction.options.regex", "(?!)")
    return session


def describe(spark: SparkSession, name: str | ObjectName) -> dict:
    """Metadata of one object, with the fields of :data:`INVENTORY`."""
    name = ObjectName.parse(name)
    text = _plain_session(spark).sql(f"DESCRIBE EXTENDED {table_sql(spark, name)} AS JSON").first()[0]
    meta = json.loads(text)
    return {
        "catalog": name.catalog,
        "schema": name.schema,
        "name": name.name,
        "object_type": meta.get("type"),
        "provider": meta.get("provider"),
        "serde": meta.get("serde_library"),
        "location": meta.get("location"),
        "comment": meta.get("comment"),
        "view_text": meta.get("view_text"),
        "view_namespace": meta.get("view_catalog_and_namespace"),
        "partition_cols": meta.get("partition_columns") or [],
        "cluster_cols": meta.get("clustering_columns") or [],
        "bucket_cols": meta.get("bucket_columns") or [],
        "sort_cols": meta.get("sort_columns") or [],
        "n_buckets": meta.get("num_buckets"),
        "properties": meta.get("table_properties") or {},
        "options": meta.get("storage_properties") or {},
        "columns": _columns(spark, name),
    }


def _columns(spark: SparkSession, name: ObjectName) -> list[dict] | None:
    """Column records; NULL for a view whose tables are gone."""
    try:
        schema = schema_of(spark, name)
    except PySparkException:
        return None
    return [
        {
            "name": field.name,
            "type": field.dataType.simpleString(),
            "nullable": field.nullable,
            "comment": (field.metadata or {}).get("comment"),
            "pos": position,
        }
        for position, field in enumerate(schema)
    ]


def schema_of(spark: SparkSession, name: str | ObjectName) -> T.StructType:
    """Schema of a table or view; analysis only, no job."""
    return spark.table(table_sql(spark, name)).schema


def exists(spark: SparkSession, name: str | ObjectName) -> bool:
    return spark.catalog.tableExists(table_sql(spark, name))


def _in_chunks(
    read: Callable[[ObjectName], object], names: Iterable[ObjectName], threads: int
) -> Iterator[list]:
    """One metadata command per object, so that the driver holds one chunk at a time."""
    names = iter(names)
    with ThreadPoolExecutor(threads) as pool:
        while chunk := list(islice(names, CHUNK_OBJECTS)):
            yield list(pool.map(read, chunk))


def _listed(
    spark: SparkSession, catalog: str, schemas: list[str], names: str | list[str] | None, missing_ok: bool = False
) -> Iterator[ObjectName]:
    wanted = split_names(names)
    found = set()
    for schema in schemas:
        for row in list_objects(spark, catalog, schema, wanted).toLocalIterator():
            found.add(row["name"].lower())
            yield ObjectName(catalog, schema, row["name"])
    missing = [name for name in wanted if name.lower() not in found]
    if missing and not missing_ok:
        raise ValueError(f"not found in {catalog}: {', '.join(missing)}")


def inventory(
    spark: SparkSession,
    catalog: str,
    schemas: str | list[str],
    names: str | list[str] | None = None,
    kind: str | None = None,
    threads: int = METADATA_THREADS,
    missing_ok: bool = False,
) -> DataFrame:
    """Inventory of one or more schemas; a name that does not exist is an error unless ``missing_ok``.

    Describing is one metadata command per object and runs from a thread pool. Beyond
    one chunk of objects the records go to the shared folder, so that the driver holds
    one chunk at a time; :func:`snapshot` keeps them under a path of one's own.
    """
    schemas = split_names(schemas)
    require(catalog=catalog, schemas=schemas)
    listed = _listed(spark, catalog, schemas, names, missing_ok)
    frame = _spooled(spark, _in_chunks(lambda name: describe(spark, name), listed, threads), INVENTORY)
    return filter_kind(frame, kind) if kind else frame


def _spooled(spark: SparkSession, chunks: Iterator[list], schema: T.StructType) -> DataFrame:
    """One chunk as local rows; more of them as Parquet files in the shared folder."""
    path = new_area(spark, "inventory")  # a cluster without a shared folder is refused at any size
    first = next(chunks, [])
    second = next(chunks, None)
    frame = spark.createDataFrame(first, schema)
    if second is None:
        return frame
    frame.write.parquet(path)
    for chunk in chain([second], chunks):
        spark.createDataFrame(chunk, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def fetch_ddl(
    spark: SparkSession, objects: Iterable[ObjectName], threads: int = METADATA_THREADS
) -> DataFrame:
    """CREATE statements of objects: ``catalog, schema, name, createtab_stmt``."""

    def fetch(name: ObjectName) -> tuple[str, str, str, str]:
        text = spark.sql(f"SHOW CREATE TABLE {table_sql(spark, name)}").first()[0]
        return name.catalog, name.schema, name.name, text

    return _spooled(spark, _in_chunks(fetch, objects, threads), DDL_TEXTS)


def snapshot(
    spark: SparkSession,
    catalog: str,
    schemas: str | list[str],
    path: str,
    threads: int = METADATA_THREADS,
) -> DataFrame:
    """Write the inventory to Parquet chunk by chunk and return it as a scan.

    Listed once, an estate of any size is then planned on as a distributed table.
    """
    schemas = split_names(schemas)
    require(catalog=catalog, schemas=schemas, path=path)
    spark.createDataFrame([], INVENTORY).write.mode("overwrite").parquet(path)
    listed = _listed(spark, catalog, schemas, None)
    for chunk in _in_chunks(lambda name: describe(spark, name), listed, threads):
        spark.createDataFrame(chunk, INVENTORY).write.mode("append").parquet(path)
    return spark.read.schema(INVENTORY).parquet(path)


def filter_kind(frame: DataFrame, kind: str) -> DataFrame:
    """Keep views (``'view'``) or everything else (``'table'``)."""
    is_view = F.upper(F.col("object_type")) == VIEW
    if kind.lower() == "view":
        return frame.filter(is_view)
    return frame.filter(~is_view)


def filter_names(frame: DataFrame, names: str | list[str] | None) -> DataFrame:
    """Keep the named objects; no names means all."""
    wanted = split_names(names)
    return frame.filter(F.lower("name").isin([w.lower() for w in wanted])) if wanted else frame


def with_effective_format(frame: DataFrame) -> DataFrame:
    """Add ``effective_format``: the provider, or the format behind a Hive serde."""
    return frame.withColumn("effective_format", effective_format_column(F.col("provider"), F.col("serde")))
