"""Queries on what happens to tables after their first copy: reruns, rebuilds, metadata, tear-down."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query, read
from registry.movement import SOURCE, TARGET, Estate, done
from tablemove.functions import ddl
from tablemove.functions.names import ObjectName, table_sql
from tablemove.operators import convert, copy, external, locations, validate, views
from tablemove.plans import migrate
from tablemove.sources import estate
from tablemove.sources.inventory import describe, inventory, list_objects
from tablemove.sources.workspace import remove
from tablemove.streaming import incremental, resume


@query("SELECT * FROM events WHERE event_type <> 'click' OR event_type IS NULL")
def clone_incremental_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that were copied are all rewritten: the clone holds what they hold now."""
    here = Estate(spark, sf_dir)
    events, location = read(spark, sf_dir, "events"), here.area("events")
    source, target = here.source("events"), here.target("events")
    events.write.parquet(location)
    external.register(spark, source, "parquet", location, events.schema)
    done(incremental.clone_append(spark, source, target, level="fingerprint"))
    kept = events.filter("event_type <> 'click' OR event_type IS NULL")
    kept.write.mode("overwrite").parquet(location)
    outcome = incremental.clone_append(spark, source, target, level="diff")
    done(outcome)
    if outcome.description != "changed files replaced":
        raise RuntimeError(f"rewritten files were not noticed: {outcome.description}")
    return here.read(target)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, false AS touched FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_quantity + 1, l_returnflag, true FROM lineitem WHERE l_returnflag = 'N'
    """
)
def clone_incremental_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the source's files some are rewritten, some removed, most left: the clone's other files stay as they are."""
    here = Estate(spark, sf_dir)
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    lines, location = read(spark, sf_dir, "lineitem").select(*columns), here.area("lineitem")
    source, target = here.source("lineitem"), here.target("lineitem")
    # Rows of one flag are too many for a task that sorts them all.
    lines.hint("rebalance", "l_returnflag").write.partitionBy("l_returnflag").parquet(location)
    external.register(spark, source, "parquet", location, lines.schema, ["l_returnflag"])
    done(incremental.clone_append(spark, source, target))
    file = F.col("_metadata.file_path").alias("file")
    before = here.read(target).select(file).distinct()
    seen = here.area("before")
    before.write.parquet(seen)
    before = spark.read.parquet(seen)
    changed = lines.filter("l_returnflag = 'N'").withColumn("l_quantity", (F.col("l_quantity") + 1).cast(lines.schema["l_quantity"].dataType))
    changed.drop("l_returnflag").write.mode("overwrite").parquet(f"{location}/l_returnflag=N")
    remove(spark, f"{location}/l_returnflag=R")
    outcome = incremental.clone_append(spark, source, target, level="diff")
    done(outcome)
    if outcome.description != "changed files replaced":
        raise RuntimeError(f"rewritten files were not noticed: {outcome.description}")
    rows = here.read(target).select(*columns, file)
    return rows.join(before.withColumn("old", F.lit(True)), "file", "left").select(*columns, F.col("old").isNull().alias("touched"))


@query("SELECT * FROM events")
def stream_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream reads a part of the source, stops, and goes on with the clone: every row once."""
    here = Estate(spark, sf_dir)
    events, location = read(spark, sf_dir, "events"), here.area("events")
    source, target = here.source("events"), here.target("events")
    sink, before, after = here.area("sink"), here.area("checkpoint"), here.area("checkpoint")

    def arrive(*types):
        rows = events.filter(F.coalesce("event_type", F.lit("error")).isin(*types))
        rows.repartition(3).write.mode("append").parquet(location)

    def stream(folder: str, checkpoint: str) -> None:
        rows = spark.readStream.schema(events.schema).parquet(folder)
        writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(sink).awaitTermination()

    arrive("click", "view")
    external.register(spark, source, "parquet", location, events.schema)
    done(incremental.clone_append(spark, source, target))
    stream(location, before)
    arrive("purchase")
    done(incremental.clone_append(spark, source, target))
    resume.continue_on_clone(spark, target, before, after)
    folder = describe(spark, target)["location"]
    stream(folder, after)
    arrive("signup", "error")
    done(incremental.clone_append(spark, source, target))
    stream(folder, after)
    return spark.read.parquet(sink)


@query(
    """
    SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS value, event_type <> 'purchase' AS old
    FROM events WHERE event_type IS NOT NULL
    """
)
def clone_incremental_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the source gets later arrives with the files that have it; older rows have NULL."""
    here = Estate(spark, sf_dir)
    events = read(spark, sf_dir, "events").filter("event_type IS NOT NULL").select("event_id", "event_type", "value")
    source, target = here.source("events"), here.target("events")
    early = events.filter("event_type <> 'purchase'").drop("value")
    early.write.saveAsTable(table_sql(spark, source))
    done(incremental.clone_append(spark, source, target))
    old = here.read(target).select(F.col("_metadata.file_path").alias("file")).distinct()
    seen = here.area("old")
    old.write.parquet(seen)
    old = spark.read.parquet(seen).withColumn("old", F.lit(True))
    spark.sql(f"ALTER TABLE {table_sql(spark, source)} ADD COLUMNS (value {events.schema['value'].dataType.simpleString()})")
    events.filter("event_type = 'purchase'").write.mode("append").saveAsTable(table_sql(spark, source))
    outcome = incremental.clone_append(spark, source, target, level="diff")
    done(outcome)
    if outcome.description != "new files appended":
        raise RuntimeError(f"a new column led to a rebuild: {outcome.description}")
    rows = here.read(target).select("*", F.col("_metadata.file_path").alias("file")).join(old, "file", "left")
    return rows.select("event_id", "event_type", "value", F.coalesce("old", F.lit(False)).alias("old"))


@query(
    "SELECT 'first' AS clone, * FROM events UNION ALL "
    "SELECT 'second', * FROM events WHERE event_type IN ('click', 'view')"
)
def clone_of_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clone of an incremental clone stays as it was; the first one goes on with new files."""
    here = Estate(spark, sf_dir)
    events, location = read(spark, sf_dir, "events"), here.area("events")
    source, first, second = here.source("events"), here.target("first"), here.target("second")
    early = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    events.filter(early).write.parquet(location)
    external.register(spark, source, "parquet", location, events.schema)
    done(incremental.clone_append(spark, source, first), copy.clone(spark, first, second))
    events.filter(~early).write.mode("append").parquet(location)
    if not incremental.clone_append(spark, source, second).failed:
        raise RuntimeError("a copy went on with the state of another table")
    done(incremental.clone_append(spark, source, first, level="fingerprint"))
    named = [here.read(n).select(F.lit(n.name).alias("clone"), "*") for n in (first, second)]
    return named[0].unionByName(named[1])


@query(
    """
    SELECT n_name AS comment, n_name || '_1' AS synced_hourly, CAST(n_nationkey AS VARCHAR) AS cloned_from_team,
           (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_rows, true AS bucketed
    FROM nation
    """
)
def ctas_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments, properties that look like markers, and buckets arrive with a copy."""
    here = Estate(spark, sf_dir, "customer")
    result = None
    for row in read(spark, sf_dir, "nation").collect():
        name = f"customer_{row['n_nationkey']}"
        own = here.source(name)
        rows = here.read(here.source("customer")).filter(F.col("c_nationkey") == row["n_nationkey"])
        rows.write.bucketBy(4, "c_custkey").saveAsTable(table_sql(spark, own))
        copy.markers.set_properties(
            spark, own, {"synced_hourly": f"{row['n_name']}_1", "cloned_from_team": str(row["n_nationkey"])}
        )
        done(
            copy.ctas(spark, own, here.target(name), comment=row["n_name"]),
            # Once more: by now the source carries the markers of a move.
            copy.ctas(spark, own, here.target(name), comment=row["n_name"]),
        )
        counted = here.read(here.target(name)).agg(F.count("*").alias("n_rows")).withColumn("name", F.lit(name))
        result = counted if result is None else result.unionByName(counted)
    about = inventory(spark, TARGET, here.schema).filter(~F.map_contains_key("properties", "upgraded_to"))
    return about.join(result, "name").select(
        "comment",
        F.col("properties")["synced_hourly"].alias("synced_hourly"),
        F.col("properties")["cloned_from_team"].alias("cloned_from_team"),
        "n_rows",
        (F.col("n_buckets") == 4).alias("bucketed"),
    )


@query(
    """
    SELECT change, changed = 'nothing' AS same, (SELECT count(*) FROM orders JOIN events ON o_orderkey = event_id)
           AS n_rows
    FROM (VALUES ('nothing', 'nothing'), ('one microsecond in a map', 'm'), ('one NULL in a struct', 's'),
                 ('bounds of an array', 'a')) AS v(change, changed)
    """
)
def validate_fingerprint_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values of all joined orders and events, and copies with one unit changed in one row."""
    joined = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "events"), F.col("o_orderkey") == F.col("event_id"))
    later = F.timestamp_add("MICROSECOND", F.lit(1), F.col("ts"))
    one = F.col("o_orderkey") == joined.agg(F.min("o_orderkey")).first()[0]

    def nested(map_time=F.col("ts"), status=F.col("o_orderstatus"), split=1):
        keys = F.array("o_orderkey", "o_custkey", "user_id")
        return joined.select(
            "o_orderkey",
            F.create_map(F.lit("ordered"), "o_orderdate", F.lit("seen"), map_time).alias("m"),
            F.struct(F.col("o_totalprice"), status.alias("status"), F.struct("props", "value").alias("inner")).alias("s"),
            F.array(F.slice(keys, F.lit(1), split), F.slice(keys, F.lit(split) + 1, F.lit(3) - split)).alias("a"),
        )

    copies = {
        "nothing": nested(),
        "one microsecond in a map": nested(map_time=F.when(one, later).otherwise(F.col("ts"))),
        "one NULL in a struct": nested(status=F.when(~one, F.col("o_orderstatus"))),
        "bounds of an array": nested(split=F.when(one, F.lit(2)).otherwise(F.lit(1))),
    }
    base = validate.take_fingerprint(nested())
    found = [(c, validate.take_fingerprint(f)) for c, f in copies.items()]
    return spark.createDataFrame(
        [(c, f == base, f[0]) for c, f in found], "change string, same boolean, n_rows bigint"
    )


_SYNCED = {
    "customer": "c_custkey",
    "nation": "n_nationkey",
    "orders": "o_orderkey * o_custkey",
    "part": "p_partkey * p_size",
    "region": "r_regionkey",
    "supplier": "s_suppkey * s_nationkey",
}


def _content(key: str) -> Column:
    """The sum of a product of keys as a BIGINT, modulo 2 ** 64 if it is larger."""
    factors = [F.col(c).cast("decimal(19,0)") for c in key.split(" * ")]
    total = F.sum(reduce(lambda a, b: a * b, factors))
    half, whole = F.lit(Decimal(1 << 63)), F.lit(Decimal(1 << 64))
    return (F.pmod(total + half, whole) - half).cast("bigint")


@query(
    " UNION ALL ".join(
        f"SELECT run, '{t}' AS name, CASE WHEN run = 1 THEN 'CREATE' "
        f"WHEN run = 3 AND '{t}' = 'orders' THEN 'RECREATE' ELSE 'IN_SYNC' END AS action, "
        f"(SELECT count(*) FROM {t}) AS n_rows, (SELECT sum({k})::BIGINT FROM {t}) AS content FROM range(1, 5) AS r(run)"
        for t, k in _SYNCED.items()
    )
)
def sync_external_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run four times: created, in sync, one table at another place, in sync.

    ``content`` is the exact sum of a key; one that a BIGINT can't hold goes on from the other end, modulo 2 ** 64.
    """
    here = Estate(spark, sf_dir, *_SYNCED)
    runs = []
    for run in range(1, 5):
        if run == 3:
            elsewhere = here.area("orders")
            orders = read(spark, sf_dir, "orders")
            orders.limit(0).write.parquet(elsewhere)
            copy.drop(spark, here.target("orders"))
            external.register(spark, here.target("orders"), "parquet", elsewhere, orders.schema)
        outcomes = migrate.sync_external(spark, SOURCE, here.schema, TARGET)
        done(*outcomes)
        runs += [(run, ObjectName.parse(o.target_full_name).name, o.action) for o in outcomes]
    actions = spark.createDataFrame(runs, "run bigint, name string, action string")
    counts = None
    for t, key in _SYNCED.items():
        counted = here.read(here.target(t)).agg(F.count("*").alias("n_rows"), _content(key).alias("content"))
        counted = counted.withColumn("name", F.lit(t))
        counts = counted if counts is None else counts.unionByName(counted)
    return actions.join(counts, "name").select("run", "name", "action", "n_rows", "content")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, 1 AS n_added, 1 AS n_dropped
    FROM lineitem WHERE l_returnflag IN ('N', 'R')
    """
)
def external_repair_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition came, one went, one stayed: only the first two cost a command, and a run in sync none."""
    here = Estate(spark, sf_dir)
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]
    lines, location = read(spark, sf_dir, "lineitem").select(*columns), here.area("lineitem")

    def arrive(*flags):
        lines.filter(F.col("l_returnflag").isin(*flags)).write.mode("append").partitionBy("l_returnflag").parquet(location)

    arrive("A", "N")
    source, target = here.source("lineitem"), here.target("lineitem")
    external.register(spark, source, "parquet", location, lines.schema, ["l_returnflag"])
    done(external.sync(spark, source, target))
    arrive("R")
    remove(spark, f"{location}/l_returnflag=A")
    added, dropped = external.repair_difference(spark, source, location)
    done(external.sync(spark, source, target))
    if external.repair_difference(spark, target, location) != (0, 0):
        raise RuntimeError("partitions were repaired that were in sync")
    return here.read(target).select(*columns, F.lit(added).alias("n_added"), F.lit(dropped).alias("n_dropped"))


@query(
    """
    SELECT run, action, n_rows
    FROM (SELECT count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'),
         (VALUES (1, 'CREATE'), (2, 'IN_SYNC')) AS v(run, action)
    """
)
def view_sync_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views synced into a schema of another name, twice."""
    here = Estate(spark, sf_dir, "orders")
    orders = table_sql(spark, here.source("orders"))
    done(external.sync(spark, here.source("orders"), here.target("orders")))
    views.create_view(spark, here.source("v"), f"SELECT * FROM {orders} WHERE o_orderstatus = 'F'")
    other = f"{here.schema}_views"
    rows = []
    for run in (1, 2):
        outcomes = migrate.sync_views(
            spark, SOURCE, here.schema, TARGET, create_schema=True, target_schema=other, schema_comment="views"
        )
        done(*outcomes)
        rows += [(run, o.action) for o in outcomes]
    count = here.read(ObjectName(TARGET, other, "v")).agg(F.count("*").alias("n_rows"))
    return spark.createDataFrame(rows, "run int, action string").join(count, how="cross")


@query("SELECT count(*) AS stated_rows, 'orc' AS provider, count(*) AS n_rows FROM part")
def convert_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversion that collects statistics leaves the row count in the catalog."""
    here = Estate(spark, sf_dir, "part")
    mine = here.target("part")
    done(copy.clone(spark, here.source("part"), mine), convert.convert_format(spark, mine, "orc", analyze=True))
    described = spark.sql(f"DESCRIBE EXTENDED {table_sql(spark, mine)}").filter("col_name = 'Statistics'")
    stated = described.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("stated_rows"))
    counted = here.read(mine).agg(F.count("*").alias("n_rows"))
    return stated.join(counted, how="cross").select("stated_rows", F.lit(describe(spark, mine)["provider"]).alias("provider"), "n_rows")


@query("SELECT true AS says_where, true AS says_how, count(*) AS n_rows FROM supplier")
def marker_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marker of a copy as a comment on its source."""
    here = Estate(spark, sf_dir, "supplier")
    target = here.target("supplier")
    done(copy.ctas(spark, here.source("supplier"), target, marker="comment"))
    comment = F.lit(describe(spark, here.source("supplier"))["comment"])
    return here.read(target).agg(
        F.first(comment.contains(str(target))).alias("says_where"),
        F.first(comment.contains("via CTAS")).alias("says_how"),
        F.count("*").alias("n_rows"),
    )


@query("SELECT 'nation' AS name, n_nationkey, n_name, n_regionkey, 0 AS objects_left FROM nation")
def tear_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas are dropped with their managed tables; files of external tables stay."""
    here = Estate(spark, sf_dir, "nation")
    location = here.area("nation")
    done(
        estate.copy_table(spark, here.source("nation"), here.target("managed")),
        estate.copy_table(spark, here.source("nation"), here.target("kept"), location=location),
    )
    estate.drop_schemas(spark, TARGET, [here.schema])
    spark.sql(f"CREATE SCHEMA `{TARGET}__{here.schema}`")
    left = list_objects(spark, TARGET, here.schema).agg(F.count("*").cast("int").alias("objects_left"))
    return spark.read.parquet(location).select(F.lit("nation").alias("name"), "*").join(left, how="cross")


@query(
    "SELECT 'all' AS seeded, count(*) AS n_rows FROM orders UNION ALL "
    "SELECT 'first', least(count(*), 100) FROM orders"
)
def seed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded views read their table whole, or as many rows as were asked for."""
    here = Estate(spark, sf_dir, "orders")
    estate.make_view(spark, here.source("orders"), here.target("all"))
    estate.make_view(spark, here.source("orders"), here.target("first"), limit=100)
    both = [here.read(here.target(n)).select(F.lit(n).alias("seeded")) for n in ("all", "first")]
    return both[0].unionByName(both[1]).groupBy("seeded").agg(F.count("*").alias("n_rows"))


@query(
    """
    WITH m AS (SELECT split_part(url, '/', 3) AS host FROM pages)
    SELECT 'one_ext_loc_c' AS name, 'abfss://c@' || min(host) || '.net/' AS url, 'PLANNED' AS status FROM m
    """
)
def location_plan_one_mount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan for one of as many mounts as the pages have hosts."""
    pages = read(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
    mounts = pages.select(
        F.concat(F.lit("/mnt/"), "host").alias("mount_point"),
        F.concat(F.lit("abfss://c@"), "host", F.lit(".net/")).alias("source"),
    ).distinct()
    tables = pages.select(
        F.col("page_id").alias("id"),
        F.lit("table").alias("object_type"),
        F.concat(F.lit("dbfs:/mnt/"), "host", F.lit("/t/"), F.col("page_id").cast("string")).alias("location"),
    )
    one = pages.agg(F.min("host")).first()[0]
    return locations.plan(tables, mounts, "one", mount_point=f"/mnt/{one}").select("name", "url", "status")


@query(
    "SELECT p_partkey, 'p_size, brand' AS cluster_by, 'USING delta' AS using_clause, "
    "concat('c.s.part_', p_partkey) AS full_table_name FROM part"
)
def ddl_cluster_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLUSTER BY clauses of as many statements as there are parts."""
    statements = read(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(
            F.lit("CREATE TABLE c.s.part_"),
            F.col("p_partkey").cast("string"),
            F.lit(" (\n  p_size INT,\n  brand STRING COMMENT 'CLUSTER BY (x)')\nUSING delta\nCLUSTER BY (p_size, brand)\n"),
            F.concat(F.lit("COMMENT '"), "p_name", F.lit("'\n")),
        ).alias("createtab_stmt"),
    )
    found = ddl.decompose(statements)
    return found.select(
        "p_partkey", "cluster_by", F.concat(F.lit("USING "), "using").alias("using_clause"), "full_table_name"
    )
