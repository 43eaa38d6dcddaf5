"""Queries that move data or register tables, and read the result back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import TABLES, query, read
from tablemove.functions import ddl
from tablemove.functions.names import ObjectName, schema_sql, table_sql
from tablemove.operators import convert, copy, external, validate, views
from tablemove.operators.outcome import Outcome
from tablemove.plans import migrate, report
from tablemove.sources import estate
from tablemove.sources.inventory import METADATA_THREADS, fetch_ddl, filter_kind, inventory
from tablemove.sources.schemas import describe_schema
from tablemove.sources.workspace import new_area, new_schema
from tablemove.streaming import incremental

SOURCE, TARGET = "src", "dst"


class Estate:
    """A source schema with external tables over the given files, and an empty target."""

    def __init__(self, spark: SparkSession, sf_dir: str, *tables: str):
        self.spark = spark
        self.schema = new_schema(spark, SOURCE, "q")
        spark.sql(
            f"CREATE SCHEMA {schema_sql(spark, TARGET, self.schema)} "
            f"LOCATION '{new_area(spark, 'dst')}'"
        )
        with ThreadPoolExecutor(METADATA_THREADS) as pool:
            list(
                pool.map(
                    lambda t: external.register(spark, self.source(t), "parquet", f"{sf_dir}/{t}.parquet"),
                    tables,
                )
            )

    def source(self, table: str) -> ObjectName:
        return ObjectName(SOURCE, self.schema, table)

    def target(self, table: str) -> ObjectName:
        return ObjectName(TARGET, self.schema, table)

    def read(self, name: ObjectName) -> DataFrame:
        return self.spark.table(table_sql(self.spark, name))

    def area(self, label: str) -> str:
        return new_area(self.spark, label)


def done(*outcomes: Outcome) -> None:
    """A registered query must not hide a failed step."""
    for outcome in outcomes:
        if outcome.failed:
            raise RuntimeError(f"{outcome.operation} {outcome.source_full_name}: {outcome.description}")


def _each(template: str, tables=TABLES) -> str:
    return " UNION ALL ".join(template.format(t=t) for t in tables)


_COLUMN_COUNT = (
    "(SELECT count(DISTINCT column_name) FROM information_schema.columns WHERE table_name = '{t}')"
)


def _row_counts(here: Estate, names: list[ObjectName]) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            here.read(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n.name).alias("name"), "n_rows")
            for n in names
        ],
    )


@query(
    _each(
        "SELECT '{t}' AS name, 'EXTERNAL' AS object_type, 'parquet' AS provider, "
        f"CAST({_COLUMN_COUNT} AS INTEGER) AS n_columns, (SELECT count(*) FROM {{t}}) AS n_rows"
    )
)
def inventory_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, *TABLES)
    views.create_view(spark, here.source("v_orders"), f"SELECT * FROM {table_sql(spark, here.source('orders'))}")
    listed = filter_kind(inventory(spark, SOURCE, here.schema), "table")
    return listed.select(
        "name", "object_type", "provider", F.size("columns").alias("n_columns")
    ).join(_row_counts(here, [here.source(t) for t in TABLES]), "name")


@query(
    _each(
        "SELECT '{t}' AS name, 'parquet' AS using_format, '{t}.parquet' AS file_name, "
        "(SELECT count(*) FROM {t}) AS n_rows"
    )
)
def ddl_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE statements fetched from the catalog and decomposed in one projection."""
    here = Estate(spark, sf_dir, *TABLES)
    names = [here.source(t) for t in TABLES]
    clauses = ddl.decompose(fetch_ddl(spark, names)).filter("table_schema <> '' AND object_type = 'table'")
    return clauses.select(
        "name",
        F.col("using").alias("using_format"),
        F.substring_index("location", "/", -1).alias("file_name"),
    ).join(_row_counts(here, names), "name")


_VIEW_TABLES = ("orders", "lineitem", "events", "documents")


@query(
    _each(
        "SELECT 'v_{t}' AS name, 'VIEW' AS object_type, "
        f"CAST({_COLUMN_COUNT} AS INTEGER) AS n_columns, (SELECT count(*) FROM {{t}}) AS n_rows",
        _VIEW_TABLES,
    )
)
def inventory_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, *_VIEW_TABLES)
    for t in _VIEW_TABLES:
        views.create_view(spark, here.source(f"v_{t}"), f"SELECT * FROM {table_sql(spark, here.source(t))}")
    listed = filter_kind(inventory(spark, SOURCE, here.schema), "view")
    return listed.select("name", "object_type", F.size("columns").alias("n_columns")).join(
        _row_counts(here, [here.source(f"v_{t}") for t in _VIEW_TABLES]), "name"
    )


@query(
    _each(
        f"SELECT '{{t}}' AS name, CAST({_COLUMN_COUNT} AS INTEGER) AS n_columns, "
        "(SELECT count(*) FROM {t}) AS n_rows",
        ("lineitem", "orders"),
    )
)
def inventory_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, *TABLES)
    listed = inventory(spark, SOURCE, here.schema, "ORDERS,  LineItem ,", "table")
    return listed.select("name", F.size("columns").alias("n_columns")).join(
        _row_counts(here, [here.source(t) for t in ("orders", "lineitem")]), "name"
    )


@query("SELECT * FROM orders")
def ctas_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "orders")
    done(copy.ctas(spark, here.source("orders"), here.target("orders")))
    return here.read(here.target("orders"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, "
    "l_quantity, l_shipdate, l_returnflag FROM lineitem"
)
def ctas_select_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "lineitem")
    select = [
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
        "l_quantity",
        "l_shipdate",
        "l_returnflag",
    ]
    done(
        copy.ctas(
            spark,
            here.source("lineitem"),
            here.target("lineitem"),
            select=select,
            partition_by=["l_returnflag"],
        )
    )
    return here.read(here.target("lineitem"))


@query("SELECT * FROM lineitem")
def ctas_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "lineitem")
    done(copy.ctas(spark, here.source("lineitem"), here.target("lineitem"), fmt="orc"))
    return here.read(here.target("lineitem"))


@query("SELECT * FROM part")
def ctas_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "part")
    done(copy.ctas(spark, here.source("part"), here.target("part"), location=here.area("part")))
    return here.read(here.target("part"))


@query("SELECT event_id, ts, user_id, value, props, event_type FROM events")
def ctas_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned target replaced by one with other columns and partitions."""
    here = Estate(spark, sf_dir, "events")
    source, target = here.source("events"), here.target("events")
    done(
        copy.ctas(spark, source, target, select=["event_id", "event_type"]),
        copy.ctas(spark, source, target, partition_by=["event_type"]),
        copy.ctas(spark, source, target, partition_by=["event_type"]),
    )
    return here.read(target).select("event_id", "ts", "user_id", "value", "props", "event_type")


@query("SELECT * FROM lineitem")
def clone_managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "lineitem")
    done(copy.clone(spark, here.source("lineitem"), here.target("lineitem")))
    return here.read(here.target("lineitem"))


@query(
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows FROM lineitem"
)
def clone_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clone compared with its source row by row."""
    here = Estate(spark, sf_dir, "lineitem")
    source, target = here.source("lineitem"), here.target("lineitem")
    done(copy.clone(spark, source, target, level="count"))
    differences = validate.diff_summary(here.read(source), here.read(target))
    rows = _row_counts(here, [target]).withColumn("on", F.lit(1))
    return rows.join(differences.withColumn("on", F.lit(1)), "on").select(
        "n_rows", "missing_rows", "extra_rows"
    )


@query(
    "SELECT vec_id, label, CAST(pos AS INTEGER) AS pos, CAST(embedding[pos + 1] AS DOUBLE) AS value "
    "FROM (SELECT *, unnest(range(len(embedding))) AS pos FROM embeddings)"
)
def clone_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "embeddings")
    done(
        copy.clone(spark, here.source("embeddings"), here.target("embeddings"), location=here.area("embeddings"))
    )
    cloned = here.read(here.target("embeddings"))
    return cloned.select("vec_id", "label", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", "label", "pos", F.col("value").cast("double").alias("value")
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders")
def clone_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clone of a partitioned table, partitions carried over; run twice to replace."""
    here = Estate(spark, sf_dir, "orders")
    parted = here.source("orders_by_status")
    done(
        copy.ctas(spark, here.source("orders"), parted, partition_by=["o_orderstatus"]),
        copy.clone(spark, parted, here.target("orders")),
        copy.clone(spark, parted, here.target("orders")),
    )
    return here.read(here.target("orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )


@query("SELECT * FROM events")
def clone_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in three steps; each run copies what is new."""
    here = Estate(spark, sf_dir)
    events, location = read(spark, sf_dir, "events"), here.area("events")
    source, target = here.source("events"), here.target("events")
    arrivals = [
        F.col("event_type").isin("click", "view"),
        F.col("event_type") == "purchase",
        ~F.col("event_type").isin("click", "view", "purchase") | F.col("event_type").isNull(),
    ]
    for step, arrival in enumerate(arrivals):
        events.filter(arrival).write.mode("append").parquet(location)
        if step == 0:
            external.register(spark, source, "parquet", location, events.schema)
        outcome = incremental.clone_append(spark, source, target)
        done(outcome)
        if ("new files" in outcome.description) != (step > 0):
            raise RuntimeError(f"run {step} was not incremental: {outcome.description}")
    return here.read(target)


@query("SELECT * FROM customer")
def convert_to_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir, "customer")
    mine = here.target("customer")
    done(copy.clone(spark, here.source("customer"), mine), convert.convert_format(spark, mine, "orc"))
    provider = inventory(spark, TARGET, here.schema).filter(F.col("provider") != "orc")
    if not provider.isEmpty():
        raise RuntimeError("the table was not converted")
    return here.read(mine)


@query("SELECT * FROM lineitem")
def convert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned Parquet table converted in place keeps its partitions."""
    here = Estate(spark, sf_dir, "lineitem")
    mine = here.target("lineitem")
    done(
        copy.ctas(spark, here.source("lineitem"), mine, partition_by=["l_linestatus"]),
        convert.convert_format(spark, mine, "orc"),
    )
    return here.read(mine)


@query(
    "SELECT fmt, status_code, action, (SELECT count(*) FROM supplier) AS n_rows FROM (VALUES "
    "('csv', 'FAILED', NULL), ('json', 'FAILED', NULL), ('orc', 'SUCCESS', 'IN_SYNC'), "
    "('parquet', 'SUCCESS', 'CONVERT')) AS v(fmt, status_code, action)"
)
def convert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only Parquet is converted; a table that is ORC already is in sync; data stays."""
    here = Estate(spark, sf_dir, "supplier")
    names = {fmt: here.target(f"supplier_{fmt}") for fmt in ("csv", "json", "orc", "parquet")}
    done(*[estate.copy_table(spark, here.source("supplier"), name, fmt) for fmt, name in names.items()])
    outcomes = [convert.convert_format(spark, name, "orc") for name in names.values()]
    found = report.to_frame(spark, outcomes).select(
        F.regexp_extract("source_full_name", r"supplier_(\w+)$", 1).alias("fmt"), "status_code", "action"
    )
    rows = _row_counts(here, list(names.values())).select(
        F.substring_index("name", "_", -1).alias("fmt"), "n_rows"
    )
    return found.join(rows, "fmt").select("fmt", "status_code", "action", "n_rows")


@query("SELECT * FROM supplier")
def external_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = Estate(spark, sf_dir)
    schema = read(spark, sf_dir, "supplier").schema
    external.register(spark, here.target("supplier"), "parquet", f"{sf_dir}/supplier.parquet", schema)
    return here.read(here.target("supplier"))


@query(
    "SELECT l_returnflag, l_linestatus, count(*) AS n_rows, "
    "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL"
)
def external_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written elsewhere become a partitioned external table, read by partition."""
    here = Estate(spark, sf_dir)
    location = here.area("lineitem")
    read(spark, sf_dir, "lineitem").hint("rebalance", "l_returnflag", "l_linestatus").write.partitionBy(
        "l_returnflag", "l_linestatus"
    ).parquet(location)
    name = here.target("lineitem")
    schema = spark.read.parquet(location).schema
    external.register(spark, name, "parquet", location, schema, ["l_returnflag", "l_linestatus"])
    return here.read(name).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


@query(
    "SELECT name, marker, n_rows FROM (VALUES "
    "('customer', 'upgraded', (SELECT count(*) FROM customer)), "
    "('part', 'cloned', (SELECT count(*) FROM part)), "
    "('supplier', 'synced', (SELECT count(*) FROM supplier))) AS v(name, marker, n_rows)"
)
def markers_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers that three kinds of moves leave on their sources, and the rows at the target."""
    tables = ("customer", "part", "supplier")
    here = Estate(spark, sf_dir, *tables)
    steps = zip(tables, (copy.ctas, copy.clone, external.sync), strict=True)
    done(*[step(spark, here.source(t), here.target(t)) for t, step in steps])
    marks = inventory(spark, SOURCE, here.schema).select(
        "name",
        F.explode(
            F.map_keys(
                F.map_filter("properties", lambda k, v: k.endswith("_to") & v.startswith(TARGET + "."))
            )
        ).alias("key"),
    )
    return marks.select("name", F.regexp_replace("key", "_to$", "").alias("marker")).join(
        _row_counts(here, [here.target(t) for t in tables]), "name"
    )


@query("SELECT true AS in_source_folder, true AS commented, count(*) AS n_rows FROM customer")
def schema_provision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target schema derived from the source's, created, and filled by a sync."""
    here = Estate(spark, sf_dir, "customer")
    fresh = f"{TARGET}_{here.schema}"
    done(*migrate.sync_external(spark, SOURCE, here.schema, fresh, create_schema=True))
    source = describe_schema(spark, SOURCE, here.schema).select(
        "database", F.concat_ws("/", "location", F.lit(here.schema)).alias("wanted")
    )
    described = spark.sql(f"DESCRIBE SCHEMA {schema_sql(spark, fresh, here.schema)}")
    comment = described.filter("info_name = 'Comment'").select(F.lit(here.schema).alias("database"), "info_value")
    rows = here.read(ObjectName(fresh, here.schema, "customer")).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        source.join(describe_schema(spark, fresh, here.schema), "database")
        .join(comment, "database")
        .join(rows.withColumn("database", F.lit(here.schema)), "database")
        .select(
            (F.col("location") == F.col("wanted")).alias("in_source_folder"),
            F.col("info_value").startswith("Migrated from ").alias("commented"),
            "n_rows",
        )
    )


@query(
    "SELECT run, action, CASE WHEN action <> 'IN_SYNC' THEN (SELECT count(*) FROM customer) END AS source_rows, "
    "CASE WHEN action <> 'IN_SYNC' THEN (SELECT count(*) FROM customer) END AS target_rows "
    "FROM (VALUES (1, 'CREATE'), (2, 'IN_SYNC'), (3, 'RECREATE'), (4, 'IN_SYNC')) AS v(run, action)"
)
def external_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, nothing to do, create again after the target's schema drifted, nothing to do."""
    here = Estate(spark, sf_dir, "customer")
    source, target = here.source("customer"), here.target("customer")
    first = [external.sync(spark, source, target) for _ in range(2)]
    copy.drop(spark, target)
    narrowed = read(spark, sf_dir, "customer").drop("c_mktsegment").schema
    external.register(spark, target, "parquet", f"{sf_dir}/customer.parquet", narrowed)
    outcomes = [*first, *[external.sync(spark, source, target) for _ in range(2)]]
    done(*outcomes)
    rows = [(run, o.action, o.source_rows, o.target_rows) for run, o in enumerate(outcomes, 1)]
    return spark.createDataFrame(rows, "run int, action string, source_rows bigint, target_rows bigint")


@query(
    "SELECT r_name, n_name, count(*) AS customers, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) "
    "AS cents FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "GROUP BY ALL"
)
def view_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over three tables, synced to the target and read there."""
    tables = ("customer", "nation", "region")
    here = Estate(spark, sf_dir, *tables)
    c, n, r = (table_sql(spark, here.source(t)) for t in tables)
    views.create_view(
        spark,
        here.source("v_balance"),
        f"SELECT r_name, n_name, c_acctbal, 'src.x' AS origin FROM {c} JOIN {n} ON c_nationkey = n_nationkey "
        f"JOIN {r} ON n_regionkey = r_regionkey",
    )
    done(*[external.sync(spark, here.source(t), here.target(t)) for t in tables])
    done(*migrate.sync_views(spark, SOURCE, here.schema, TARGET))
    synced = here.read(here.target("v_balance")).filter(F.col("origin") == "src.x")
    return synced.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("cents"),
    )


@query(
    "SELECT name, action, n_rows FROM (VALUES "
    "('v_a', 'IN_SYNC', (SELECT count(*) FROM orders)), "
    "('v_b', 'REPLACE', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')), "
    "('v_c', 'CREATE', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000))"
    ") AS v(name, action, n_rows)"
)
def view_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views in sync, replaced and created (over another view), then read."""
    here = Estate(spark, sf_dir, "orders")
    orders = table_sql(spark, here.source("orders"))
    v_b = table_sql(spark, here.source("v_b"))
    done(external.sync(spark, here.source("orders"), here.target("orders")))
    views.create_view(spark, here.source("v_a"), f"SELECT * FROM {orders}")
    views.create_view(spark, here.source("v_b"), f"SELECT * FROM {orders}")
    done(*migrate.sync_views(spark, SOURCE, here.schema, TARGET))
    views.create_view(spark, here.source("v_b"), f"SELECT * FROM {orders} WHERE o_orderstatus = 'F'")
    views.create_view(spark, here.source("v_c"), f"SELECT * FROM {v_b} WHERE o_totalprice > 100000")
    outcomes = migrate.sync_views(spark, SOURCE, here.schema, TARGET)
    done(*outcomes)
    actions = spark.createDataFrame(
        [(ObjectName.parse(o.target_full_name).name, o.action) for o in outcomes], "name string, action string"
    )
    return actions.join(_row_counts(here, [here.target(v) for v in ("v_a", "v_b", "v_c")]), "name")


def _roundtrip(spark: SparkSession, sf_dir: str, table: str, fmt: str) -> DataFrame:
    here = Estate(spark, sf_dir, table)
    done(copy.ctas(spark, here.source(table), here.target(table), fmt=fmt))
    return here.read(here.target(table))


@query("SELECT * FROM documents")
def copy_as_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes survive a text format unchanged."""
    return _roundtrip(spark, sf_dir, "documents", "csv")


@query("SELECT * FROM conversations")
def copy_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "conversations", "json")


@query("SELECT * FROM pages")
def copy_as_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roundtrip(spark, sf_dir, "pages", "orc")


@query("SELECT * FROM lineitem")
def copy_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets and their order are inherited by a copy."""
    here = Estate(spark, sf_dir, "lineitem")
    bucketed = here.source("bucketed")
    here.read(here.source("lineitem")).write.bucketBy(8, "l_orderkey").sortBy(
        "l_orderkey"
    ).saveAsTable(table_sql(spark, bucketed))
    done(copy.ctas(spark, bucketed, here.target("bucketed")))
    about = inventory(spark, TARGET, here.schema).filter("n_buckets = 8 AND bucket_cols[0] = 'l_orderkey'")
    if about.isEmpty():
        raise RuntimeError("the buckets were not inherited")
    return here.read(here.target("bucketed"))


@query(
    "SELECT name, fmt, n_rows FROM ("
    + _each("SELECT '{t}' AS t, (SELECT count(*) FROM {t}) AS n_rows")
    + ") CROSS JOIN (VALUES ('parquet'), ('orc'), ('json')) AS f(fmt) "
    "CROSS JOIN LATERAL (SELECT t || '_' || fmt AS name)"
)
def seed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table seeded as managed Parquet and ORC and as external JSON."""
    here = Estate(spark, sf_dir, *TABLES)
    for fmt in ("parquet", "orc", "json"):
        done(
            *estate.copy_schema(
                spark,
                SOURCE,
                here.schema,
                TARGET,
                here.schema,
                fmt,
                here.area("seed") if fmt == "json" else None,
                rename=lambda name, fmt=fmt: f"{name}_{fmt}",
            )
        )
    names = [here.target(f"{t}_{fmt}") for t in TABLES for fmt in ("parquet", "orc", "json")]
    listed = inventory(spark, TARGET, here.schema).select("name", F.col("provider").alias("fmt"))
    return listed.join(_row_counts(here, names), "name")


_BATCH = ("customer", "orders", "part")


@query(
    _each(
        "SELECT '{t}' AS name, 'SUCCESS' AS status_code, 'COPY' AS action, "
        "(SELECT count(*) FROM {t}) AS source_rows, (SELECT count(*) FROM {t}) AS target_rows",
        _BATCH,
    )
    + " UNION ALL SELECT 'embeddings', 'FAILED', NULL, NULL, NULL"
)
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of copies to CSV with one table the format cannot hold."""
    here = Estate(spark, sf_dir, *_BATCH, "embeddings")
    table = table_sql(spark, here.target("report"))
    migrate.copy_schema(
        spark, SOURCE, here.schema, TARGET, fmt="csv", on_error="continue", report_table=table
    )
    return spark.table(table).select(
        F.substring_index("source_full_name", ".", -1).alias("name"),
        "status_code",
        "action",
        "source_rows",
        "target_rows",
    )


@query(_each("SELECT '{t}' AS name, (SELECT count(*) FROM {t}) AS source_rows, "
             "(SELECT count(*) FROM {t}) AS target_rows, true AS same"))
def clone_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables cloned as one batch, then compared by content in one job."""
    here = Estate(spark, sf_dir, *TABLES)
    done(*migrate.clone_schema(spark, SOURCE, here.schema, TARGET))
    pairs = [(here.source(t), here.target(t)) for t in TABLES]
    return validate.fingerprints(spark, pairs).select(
        F.substring_index("name", ".", -1).alias("name"), "source_rows", "target_rows", "same"
    )


