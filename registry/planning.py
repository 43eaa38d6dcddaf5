"""Queries that plan and compare: operators on inventories, paths and texts.

Large estates are derived from the given tables, one object per row, so that the
operators run over as many objects as the tables have rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query, read
from registry.movement import SOURCE, TARGET, Estate, done
from tablemove.functions import ddl
from tablemove.functions.names import split_names_column, target_name_column
from tablemove.functions.paths import PLATFORM_ROOT_SOURCES, between
from tablemove.functions.properties import parse_properties
from tablemove.operators import copy, drift, locations, markers, validate, views
from tablemove.sources.inventory import filter_kind, inventory, with_effective_format
from tablemove.sources.schemas import derive_schemas

# --- inventories -----------------------------------------------------------------

# One table or view per order; provider and serde follow the priority.
_ORDER_OBJECTS = """
    SELECT lower(substr(o_orderpriority, 3)) AS schema,
           concat('t_', o_orderkey) AS name,
           CASE o_orderstatus WHEN 'P' THEN 'VIEW' WHEN 'F' THEN 'EXTERNAL' ELSE 'MANAGED' END AS object_type,
           CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'hive' WHEN '2' THEN 'PARQUET'
                WHEN '3' THEN 'hive' WHEN '4' THEN 'parquet' ELSE 'hive' END AS provider,
           CASE substr(o_orderpriority, 1, 1)
                WHEN '1' THEN 'org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe'
                WHEN '3' THEN 'org.apache.hadoop.hive.serde2.avro.AvroSerDe'
                WHEN '5' THEN 'org.apache.hadoop.hive.ql.io.orc.OrcSerde' END AS serde
    FROM {orders}
"""

_FORMAT_CASE = """
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'parquet' WHEN '3' THEN 'avro' WHEN '5' THEN NULL
         ELSE 'parquet' END
"""


@query(
    f"""
    SELECT concat('t_', o_orderkey) AS name, {_FORMAT_CASE} AS effective_format
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def effective_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = spark.sql(_ORDER_OBJECTS, orders=read(spark, sf_dir, "orders"))
    tables = filter_kind(with_effective_format(objects), "table")
    return tables.select("name", "effective_format")


_COLUMNS_SQL = """
    array(named_struct('name', 'k', 'type', 'bigint', 'nullable', true, 'comment', '', 'pos', 0),
          named_struct('name', 'v', 'type', {v_type}, 'nullable', true, 'comment', '', 'pos', 1))
"""

_DRIFT_TARGETS = """
    SELECT l.l_orderkey AS key,
           CASE min(ascii(l_returnflag)) WHEN ascii('A') THEN 'orc' WHEN ascii('N') THEN 'PARQUET'
                ELSE 'parquet' END AS provider,
           CASE max(ascii(l_linestatus)) WHEN ascii('O') THEN 'EXTERNAL' ELSE 'MANAGED' END AS object_type,
           CASE WHEN sum(l_quantity) > 100 THEN 'decimal(12,2)' ELSE 'decimal(10,2)' END AS v_type,
           concat(CASE WHEN min(l_linenumber) = max(l_linenumber) THEN 's3://old/' ELSE 's3://new/' END,
                  CAST(l.l_orderkey AS VARCHAR(20)), '/') AS location,
           CASE WHEN max(l_linenumber) = 3 THEN 'ts' ELSE 'DAY' END AS part
    FROM {lineitem} l GROUP BY l.l_orderkey
"""


@query(
    """
    WITH s AS (
        SELECT o_orderkey AS key, lower(substr(o_orderpriority, 3)) AS schema, """
    + _FORMAT_CASE
    + """ AS fmt, o_orderstatus FROM orders
    ), t AS ("""
    + _DRIFT_TARGETS.replace("{lineitem}", "lineitem")
    + """), t2 AS (
        SELECT t.*, o.schema FROM t JOIN s o USING (key)
    ), j AS (
        SELECT coalesce(s.schema, t.schema) AS schema, concat('t_', coalesce(s.key, t.key)) AS name,
               s.key IS NOT NULL AS has_s, t.key IS NOT NULL AS has_t, s.fmt AS s_fmt,
               lower(t.provider) AS t_fmt, t.object_type, t.v_type, t.location, t.part
        FROM (SELECT * FROM s WHERE o_orderstatus <> 'P') s FULL JOIN t2 t ON s.key = t.key
    ), r AS (
        SELECT *, CASE WHEN NOT has_s THEN 'MISSING' WHEN s_fmt IS NULL THEN 'UNSUPPORTED'
                       WHEN NOT has_t THEN 'MISSING' WHEN s_fmt <> t_fmt THEN 'FORMAT'
                       WHEN v_type <> 'decimal(10,2)' THEN 'SCHEMA' WHEN location LIKE 's3://old/%' THEN 'LOCATION'
                       WHEN part = 'ts' THEN 'LAYOUT' END AS reason
        FROM j
    )
    SELECT schema, name, s_fmt AS source_format, t_fmt AS target_format, reason,
           CASE WHEN NOT has_s THEN 'ORPHAN' WHEN reason IS NULL THEN 'IN_SYNC'
                WHEN reason = 'MISSING' THEN 'CREATE' WHEN reason = 'UNSUPPORTED' THEN 'BLOCKED'
                WHEN object_type = 'EXTERNAL' THEN 'RECREATE' ELSE 'BLOCKED' END AS action
    FROM r
    """
)
def drift_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    source = spark.sql(_ORDER_OBJECTS, orders=orders).selectExpr(
        "*",
        "concat('s3://new/', substr(name, 3)) AS location",
        "array('day') AS partition_cols",
        _COLUMNS_SQL.format(v_type="'decimal(10,2)'") + " AS columns",
    )
    target = spark.sql(
        "SELECT lower(substr(o.o_orderpriority, 3)) AS schema, concat('t_', t.key) AS name, t.object_type, "
        "t.provider, CAST(NULL AS STRING) AS serde, t.v_type, t.location, array(t.part) AS partition_cols FROM {targets} t JOIN {orders} o "
        "ON o.o_orderkey = t.key",
        targets=spark.sql(_DRIFT_TARGETS, lineitem=lineitem),
        orders=orders,
    ).selectExpr("schema", "name", "object_type", "provider", "serde", "location", "partition_cols", _COLUMNS_SQL.format(v_type="v_type") + " AS columns")
    return drift.classify(source, target)


# --- views -----------------------------------------------------------------------

_VIEW_TEXT = """
    concat('SELECT p_name, ''', {c}, '.kept'' AS lit, my_', {c}, '.x, t.', {c}, '.y FROM ', {d},
           '.sales.part_', p_partkey, ' t JOIN `', {d}, '`.ref.brand b -- ', {c}, '.note', chr(10),
           'WHERE p_size = ', p_size, ' AND p_type <> ''', p_type, '''')
"""


def _view_text(kept: str, catalog: str) -> str:
    return _VIEW_TEXT.format(c=f"'{kept}'", d=f"'{catalog}'")


@query(
    f"""
    SELECT p_partkey, {_view_text('src', 'src')} AS view_text,
           replace({_view_text('src', 'dst')}, '`dst`', 'dst') AS rewritten
    FROM part
    """
)
def view_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_view_text('src', 'src')} AS view_text")
    return texts.select("*", views.rewritten(F.col("view_text"), "src", "dst").alias("rewritten"))


@query(
    """
    WITH s AS (SELECT o_orderkey AS key, o_orderstatus FROM orders),
         t AS (SELECT l_orderkey AS key, CASE WHEN max(l_quantity) > 40 THEN 'changed' ELSE 'same' END AS state
               FROM lineitem GROUP BY l_orderkey)
    SELECT CASE WHEN s.key IS NULL THEN 'ORPHAN' WHEN t.key IS NULL THEN 'CREATE'
                WHEN t.state = 'same' THEN 'IN_SYNC' ELSE 'REPLACE' END AS action, count(*) AS n_views
    FROM (SELECT * FROM s WHERE o_orderstatus <> 'P') s FULL JOIN t ON s.key = t.key GROUP BY 1
    """
)
def view_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read(spark, sf_dir, "orders").selectExpr(
        "'sales' AS schema",
        "concat('v_', o_orderkey) AS name",
        "CASE WHEN o_orderstatus = 'P' THEN 'MANAGED' ELSE 'VIEW' END AS object_type",
        "concat('SELECT * FROM src.sales.o_', o_orderkey) AS view_text",
        "'src.sales' AS view_namespace",
    )
    target = spark.sql(
        "SELECT 'sales' AS schema, concat('v_', l_orderkey) AS name, 'VIEW' AS object_type, "
        "concat('SELECT * FROM dst.sales.', CASE WHEN max(l_quantity) > 40 THEN 'x_' ELSE 'o_' END, l_orderkey) "
        "AS view_text FROM {lineitem} GROUP BY l_orderkey",
        lineitem=read(spark, sf_dir, "lineitem"),
    )
    return views.classify(source, target, "src", "dst").groupBy("action").agg(
        F.count(F.lit(1)).alias("n_views")
    )


# --- DDL -------------------------------------------------------------------------

_DDL = """
    concat('CREATE TABLE c.sales.part_', p_partkey, ' (', chr(10), '  k BIGINT COMMENT ''key (', p_size, ')'',', chr(10),
           '  price DECIMAL(10,2),', chr(10), '  brand STRING)', chr(10), 'USING ',
           CASE WHEN p_size > 25 THEN 'parquet' ELSE 'orc' END, chr(10),
           CASE WHEN p_size > 40 THEN concat('OPTIONS (', chr(10), '  ''path)'' = ''x', p_size, ''')', chr(10)) ELSE '' END,
           'PARTITIONED BY (brand)', chr(10),
           'LOCATION ''abfss://c@host/part/', p_partkey, '''', chr(10),
           'COMMENT ''', p_type, ' USING csv''', chr(10),
           'TBLPROPERTIES (', chr(10), '  ''name'' = ''', p_name, ' (a)'',', chr(10), '  ''size'' = ''', p_size, ''')', chr(10))
"""


@query(
    """
    SELECT p_partkey, concat('c.sales.part_', p_partkey) AS full_table_name,
           concat('k BIGINT COMMENT ''key (', p_size, ')'', price DECIMAL(10,2), brand STRING') AS table_schema,
           CASE WHEN p_size > 25 THEN 'parquet' ELSE 'orc' END AS using_format, 'brand' AS partition_by,
           '' AS cluster_by, concat('''name'' = ''', p_name, ' (a)'', ''size'' = ''', p_size, '''') AS table_properties,
           concat(p_type, ' USING csv') AS comment,
           CASE WHEN p_size > 40 THEN concat('''path)'' = ''x', p_size, '''') ELSE '' END AS options,
           concat('abfss://c@host/part/', p_partkey) AS location, concat(p_name, ' (a)') AS name_property
    FROM part
    """
)
def ddl_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    statements = read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_DDL} AS createtab_stmt")
    return ddl.decompose(statements).select(
        "p_partkey",
        "full_table_name",
        "table_schema",
        F.col("using").alias("using_format"),
        "partition_by",
        "cluster_by",
        "table_properties",
        "comment",
        "options",
        "location",
        F.col("properties_map")["name"].alias("name_property"),
    )


@query(
    """
    SELECT CASE WHEN p_size > 40 THEN
        'CREATE TABLE <<full_table_name>> (<<schema>>) USING <<using>> OPTIONS (<<options>>) PARTITIONED BY '
        || '(<<partition_by>>) LOCATION ''<<location>>'' COMMENT ''<<comment>>'' TBLPROPERTIES (<<table_properties>>)'
      ELSE
        'CREATE TABLE <<full_table_name>> (<<schema>>) USING <<using>> PARTITIONED BY '
        || '(<<partition_by>>) LOCATION ''<<location>>'' COMMENT ''<<comment>>'' TBLPROPERTIES (<<table_properties>>)'
      END AS dynamic_ddl, count(*) AS n_tables
    FROM part GROUP BY 1
    """
)
def ddl_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    statements = read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_DDL} AS createtab_stmt")
    return ddl.decompose(statements).groupBy("dynamic_ddl").agg(F.count(F.lit(1)).alias("n_tables"))


# --- locations -------------------------------------------------------------------

# Pages as stored objects: https pages live on mounted storage, others where they are.
_PAGE_OBJECTS = """
    SELECT page_id AS id,
           CASE WHEN split_part(url, '/', 4) = 'en' THEN 'table' ELSE 'schema' END AS object_type,
           CASE WHEN url LIKE 'https:%'
                THEN concat('dbfs:/mnt/', replace(substr(url, 9), '?', '%20')) ELSE url END AS location
    FROM {pages}
"""

# Hosts are mounts, except those of blogs; a host's English pages are a mount below it.
_ROOT = PLATFORM_ROOT_SOURCES[0]
_PAGE_MOUNTS = """
    SELECT DISTINCT concat('/mnt/', split_part(url, '/', 3)) AS mount_point,
           CASE WHEN split_part(url, '/', 3) LIKE 'm.%' THEN concat('wasbs://c@', split_part(url, '/', 3), '/root')
                WHEN split_part(url, '/', 3) LIKE 'www.%' THEN '{root}'
                ELSE concat('abfss://', split_part(split_part(url, '/', 3), '.', 1), '@acct.host/',
                            split_part(url, '/', 3), '/') END AS source
    FROM {pages} WHERE split_part(url, '/', 3) NOT LIKE 'blog.%'
    UNION ALL
    SELECT DISTINCT concat('/mnt/', split_part(url, '/', 3), '/en/') AS mount_point,
           concat('abfss://en@acct.host/', split_part(url, '/', 3)) AS source
    FROM {pages} WHERE split_part(url, '/', 4) = 'en' AND split_part(url, '/', 3) NOT LIKE 'www.%'
""".replace("{root}", _ROOT)

# Cloud locations in use: per host one for its root (twice for short hosts), one per language, one parent.
_PAGE_EXTERNAL = """
    SELECT DISTINCT concat('host_', split_part(url, '/', 3)) AS name,
           concat('abfss://', split_part(split_part(url, '/', 3), '.', 1), '@acct.host/', split_part(url, '/', 3)) AS url
    FROM {pages} WHERE url LIKE '%.example.com/%'
    UNION ALL
    SELECT DISTINCT concat('lang_', split_part(url, '/', 3), '_', split_part(url, '/', 4)) AS name,
           concat('abfss://', split_part(split_part(url, '/', 3), '.', 1), '@acct.host/', split_part(url, '/', 3),
                  '/', split_part(url, '/', 4), '/') AS url
    FROM {pages} WHERE url LIKE '%.example.net/%'
    UNION ALL
    SELECT 'english' AS name, 'abfss://en@acct.host' AS url
"""

_ORACLE_PAGES = f"""
    WITH objects AS ({_PAGE_OBJECTS.replace('{pages}', 'pages')}),
    mounts AS (SELECT rtrim(mount_point, '/') AS mount_point, min(rtrim(source, '/')) AS source
               FROM ({_PAGE_MOUNTS.replace('{pages}', 'pages')}) WHERE source <> '{_ROOT}' GROUP BY 1),
    ext AS (SELECT name, rtrim(url, '/') AS url FROM ({_PAGE_EXTERNAL.replace('{pages}', 'pages')})),
    placed AS (
        SELECT o.id, any_value(o.object_type) AS object_type, any_value(o.location) AS location,
               arg_max(m.mount_point, length(m.mount_point)) AS mount_point,
               arg_max(m.source, length(m.mount_point)) AS source
        FROM objects o LEFT JOIN mounts m ON o.location LIKE 'dbfs:%'
         AND (substr(o.location, 6) = m.mount_point OR starts_with(substr(o.location, 6), m.mount_point || '/'))
        GROUP BY o.id
    ),
    pairs AS (
        SELECT m.mount_point, m.source, e.name, e.url,
               CASE WHEN m.source = e.url THEN 'EQUAL' WHEN starts_with(e.url, m.source || '/')
                    THEN 'LOCATION_UNDER_MOUNT' ELSE 'MOUNT_UNDER_LOCATION' END AS coverage,
               CASE WHEN m.source = e.url THEN '' WHEN starts_with(e.url, m.source || '/')
                    THEN substr(e.url, length(m.source) + 1) ELSE substr(m.source, length(e.url) + 1) END AS folder
        FROM mounts m JOIN ext e ON m.source = e.url OR starts_with(e.url, m.source || '/')
          OR starts_with(m.source, e.url || '/')
    )
"""


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    pages = read(spark, sf_dir, "pages")
    return tuple(spark.sql(text, pages=pages) for text in (_PAGE_OBJECTS, _PAGE_MOUNTS, _PAGE_EXTERNAL))


@query(
    _ORACLE_PAGES
    + """
    SELECT id, object_type, location,
           CASE WHEN source IS NOT NULL
                THEN replace(concat(source, substr(location, 6 + length(mount_point))), '%20', ' ')
                WHEN location NOT LIKE 'dbfs:%' THEN location END AS external_location,
           CASE WHEN source IS NOT NULL THEN 'RESOLVED' WHEN location NOT LIKE 'dbfs:%' THEN 'UNCHANGED'
                WHEN object_type = 'table' THEN 'NEEDS_DATA_MOVEMENT' ELSE 'DEFAULT_LOCATION' END AS resolution
    FROM placed
    """
)
def location_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects, mounts, _ = _pages(spark, sf_dir)
    return locations.resolve(objects, mounts)


@query(
    _ORACLE_PAGES
    + "SELECT id, mount_point, source AS mount_source FROM placed WHERE mount_point IS NOT NULL"
)
def mounted_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects, mounts, _ = _pages(spark, sf_dir)
    return locations.mounted(objects, mounts).select("id", "mount_point", "mount_source")


@query(
    _ORACLE_PAGES
    + """
    SELECT m.mount_point, m.source, p.name, p.url, coalesce(p.coverage, 'NOT_COVERED') AS coverage, p.folder
    FROM mounts m LEFT JOIN pairs p USING (mount_point)
    """
)
def location_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mounts, external_locations = _pages(spark, sf_dir)
    return locations.coverage(mounts, external_locations)


@query(
    _ORACLE_PAGES
    + """
    , per_mount AS (SELECT mount_point, count(*) AS n, min(coverage) AS coverage, min(folder) AS folder,
                           min(name) AS name FROM pairs GROUP BY 1)
    SELECT id, CASE WHEN n = 1 THEN name END AS external_location_name,
           CASE WHEN n > 1 THEN 'AMBIGUOUS' ELSE coalesce(coverage, 'NOT_COVERED') END AS coverage,
           coalesce(n, 0) AS n_locations,
           coalesce(n = 1 AND folder <> '' AND contains(location, folder), false) AS folder_in_path
    FROM placed LEFT JOIN per_mount USING (mount_point)
    """
)
def table_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects, mounts, external_locations = _pages(spark, sf_dir)
    return locations.table_coverage(objects, mounts, external_locations).select(
        "id", "external_location_name", "coverage", "n_locations", "folder_in_path"
    )


@query(_ORACLE_PAGES + "SELECT mount_point, source, count(*) AS n_locations FROM pairs GROUP BY 1, 2 HAVING count(*) > 1")
def location_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mounts, external_locations = _pages(spark, sf_dir)
    return locations.ambiguous(mounts, external_locations)


@query(
    _ORACLE_PAGES
    + """
    , used AS (SELECT source, min(mount_point) AS mount_point FROM placed WHERE source IS NOT NULL GROUP BY 1),
    named AS (
        SELECT CASE WHEN source LIKE 'abfss:%'
                    THEN 'mig_ext_loc_' || regexp_extract(source || '/', '//(.+?)@', 1) END AS name,
               CASE WHEN source LIKE 'abfss:%'
                    THEN 'abfss://' || regexp_extract(source || '/', '//(.+?)/', 1) || '/' END AS url,
               mount_point, source
        FROM used
    )
    SELECT name, url, 'Created from mount point ' || min(mount_point) || ' with mount source '
           || arg_min(source, mount_point) AS comment, 'PLANNED' AS status, NULL AS reason
    FROM named WHERE name IS NOT NULL GROUP BY name, url
    UNION ALL
    SELECT name, url, 'Created from mount point ' || mount_point || ' with mount source ' || source, 'REJECTED',
           'deprecated scheme, remount as abfss'
    FROM named WHERE name IS NULL
    """
)
def location_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects, mounts, _ = _pages(spark, sf_dir)
    return locations.plan(objects, mounts, name_prefix="mig")


@query(
    """
    SELECT 'src' AS source_catalog, lower(replace(split_part(url, '/', 3), '.', '_')) AS source_schema,
           'dst' AS target_catalog, lower(replace(split_part(url, '/', 3), '.', '_')) AS target_schema,
           CASE WHEN max(url) LIKE 'https:%'
                THEN concat('abfss://c@host/', split_part(url, '/', 3), '/', lower(replace(split_part(url, '/', 3), '.', '_')))
                END AS target_location,
           concat('Migrated from src.', lower(replace(split_part(url, '/', 3), '.', '_')), ' within the same location.')
             AS target_comment
    FROM pages GROUP BY split_part(url, '/', 3)
    """
)
def schema_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = spark.sql(
        "SELECT 'src' AS catalog, lower(replace(split_part(url, '/', 3), '.', '_')) AS database, "
        "CASE WHEN max(url) LIKE 'https:%' THEN concat('abfss://c@host/', split_part(url, '/', 3), '/') END "
        "AS external_location FROM {pages} GROUP BY split_part(url, '/', 3)",
        pages=read(spark, sf_dir, "pages"),
    )
    return derive_schemas(sources, "dst").select(
        F.lit("src").alias("source_catalog"),
        F.col("target_schema").alias("source_schema"),
        "target_catalog",
        "target_schema",
        "target_location",
        "target_comment",
    )


# --- markers and names -----------------------------------------------------------

_PROPERTIES = """
    concat('[', CASE o_orderstatus WHEN 'F' THEN concat('upgraded_to=dst.sales.o_', o_orderkey, ', ') ELSE '' END,
           'owner=a=b, size=', o_custkey,
           CASE WHEN o_orderpriority LIKE '1%' THEN concat(', roll_backed_from=dst.sales.o_', o_orderkey) ELSE '' END, ']')
"""


@query(
    f"""
    SELECT o_orderkey, {_PROPERTIES} AS props, 'a=b' AS owner, CAST(o_custkey AS VARCHAR) AS size,
           CASE o_orderstatus WHEN 'F' THEN concat('dst.sales.o_', o_orderkey) END AS upgraded_to
    FROM orders
    """
)
def markers_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_PROPERTIES} AS props")
    parsed = texts.withColumn("p", parse_properties(F.col("props")))
    return parsed.select(
        "o_orderkey",
        "props",
        F.col("p")["owner"].alias("owner"),
        F.col("p")["size"].alias("size"),
        F.col("p")["upgraded_to"].alias("upgraded_to"),
    )


@query(
    """
    SELECT 'upgraded' AS marker, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'roll_backed' AS marker, o_orderkey FROM orders WHERE o_orderpriority LIKE '1%'
    """
)
def markers_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_PROPERTIES} AS props")
    objects = objects.withColumn("properties", parse_properties(F.col("props")))
    upgraded, rolled_back = (
        markers.filter_marked(objects, kind).select(F.lit(kind).alias("marker"), "o_orderkey")
        for kind in ("upgraded", "roll_backed")
    )
    return upgraded.unionByName(rolled_back)


@query(
    """
    SELECT conv_id, turn, part, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS INTEGER) AS pos
    FROM (SELECT conv_id, turn, unnest(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS part,
                 unnest(range(len(string_split(text, ',')))) AS i FROM conversations)
    WHERE part <> ''
    """
)
def name_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists split into names: blanks trimmed, empty parts dropped."""
    return read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.posexplode(split_names_column(F.col("text"))).alias("pos", "part")
    )


@query(
    """
    SELECT o_orderkey, coalesce(nullif(CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN concat('t_', o_custkey) END, ''),
           concat('s_', o_orderkey)) AS target_name FROM orders
    """
)
def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.expr("CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN concat('t_', o_custkey) END")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", target_name_column(F.expr("concat('s_', o_orderkey)"), given).alias("target_name")
    )


@query(
    """
    SELECT page_id, nullif(regexp_extract(url, '//(.+?)/', 1), '') AS host,
           nullif(regexp_extract(html, '<title>(.+?)</title>', 1), '') AS title FROM pages
    """
)
def text_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(
        "page_id",
        between(F.col("url"), "//", "/").alias("host"),
        between(F.col("html"), "<title>", "</title>").alias("title"),
    )


# --- validation ------------------------------------------------------------------

# A copy of orders with planted changes: rows dropped, changed and doubled.
_CHANGED_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderpriority LIKE '1%' AND o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END
             AS o_totalprice, o_orderdate, o_orderpriority
    FROM {orders} WHERE NOT (o_orderpriority LIKE '5%' AND o_orderstatus = 'P')
    UNION ALL
    SELECT * FROM {orders} WHERE o_orderpriority LIKE '2%' AND o_orderstatus = 'F'
"""
_ORACLE_CHANGED = _CHANGED_ORDERS.replace("{orders}", "orders")


def _changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = read(spark, sf_dir, "orders")
    return orders, spark.sql(_CHANGED_ORDERS, orders=orders)


@query(
    f"""
    WITH c AS ({_ORACLE_CHANGED})
    SELECT 'orders' AS name, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM c) AS target_rows,
           (SELECT count(*) FROM orders) - (SELECT count(*) FROM c) AS diff
    UNION ALL
    SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), 0
    """
)
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, changed = _changed(spark, sf_dir)
    lineitem = read(spark, sf_dir, "lineitem")
    return validate.counts(spark, [(orders, changed), (lineitem, lineitem)], ["orders", "lineitem"])


@query(
    """
    SELECT name, (SELECT count(*) FROM orders) AS n_rows, same FROM (VALUES ('copy', true), ('reordered', true),
        ('one column changed', false), ('rows swapped for others', false)) AS v(name, same)
    """
)
def validate_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints ignore the order of rows and columns, and nothing else."""
    orders = read(spark, sf_dir, "orders")
    shifted = orders.withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("o_orderkey") == 0, 1).otherwise(0))
    doubled = orders.filter("o_orderkey <> 0").unionByName(orders.filter("o_orderkey = 1"))
    variants = {
        "copy": orders,
        "reordered": orders.select(*reversed(orders.columns)).repartition(8, "o_custkey"),
        "one column changed": shifted,
        "rows swapped for others": doubled,
    }
    found = validate.fingerprints(spark, [(orders, v) for v in variants.values()], list(variants))
    return found.select("name", F.col("target_rows").alias("n_rows"), "same")


@query(
    f"""
    WITH c AS ({_ORACLE_CHANGED}), d AS (
        SELECT * EXCLUDE (w), sum(w) AS net FROM (
            SELECT *, 1 AS w FROM orders UNION ALL SELECT *, -1 AS w FROM c) GROUP BY ALL HAVING sum(w) <> 0)
    SELECT CAST(sum(greatest(net, 0)) AS BIGINT) AS missing_rows, CAST(sum(greatest(-net, 0)) AS BIGINT) AS extra_rows,
           count(*) FILTER (net < 0) AS distinct_extra, count(*) FILTER (net > 0) AS distinct_missing
    FROM d
    """
)
def validate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.diff_summary(*_changed(spark, sf_dir))


@query(
    f"""
    WITH c AS ({_ORACLE_CHANGED}), s AS (
        SELECT *, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT *, count(*) AS n FROM c GROUP BY ALL)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) AS n_target
    FROM s FULL JOIN t USING (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
    WHERE coalesce(s.n, 0) <> coalesce(t.n, 0)
    """
)
def validate_diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.content_diff(*_changed(spark, sf_dir)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "n_source",
        "n_target",
    )


_ORACLE_SHIFTED = """
    SELECT * REPLACE (CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM lineitem) THEN l_quantity + 1 ELSE l_quantity END
                      AS l_quantity)
    FROM lineitem WHERE l_orderkey < (SELECT max(l_orderkey) FROM lineitem)
"""


@query(
    f"""
    WITH c AS ({_ORACLE_SHIFTED}), u AS (
        SELECT *, 1 AS s, 0 AS t FROM lineitem UNION ALL SELECT *, 0, 1 FROM c
    )
    SELECT l_orderkey, l_linenumber, l_quantity, sum(s)::BIGINT AS n_source, sum(t)::BIGINT AS n_target, true AS few_moved
    FROM u GROUP BY ALL HAVING sum(s) <> sum(t)
    """.replace("GROUP BY ALL", "GROUP BY " + ", ".join(
        f"l_{c}" for c in ("orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "discount", "tax",
                           "returnflag", "linestatus", "shipdate")))
)
def validate_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where two large tables differ in few rows, only the rows of few buckets are compared one by one."""
    lines = read(spark, sf_dir, "lineitem")
    least, most = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    quantity = F.when(F.col("l_orderkey") == least, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    changed = lines.filter(F.col("l_orderkey") < most).withColumn("l_quantity", quantity)
    buckets = validate.bucket_differences(lines, changed, ["l_orderkey"])
    moved = buckets.agg(F.coalesce(F.sum("n_source"), F.lit(0))).first()[0]
    rows = validate.localized_diff(lines, changed, ["l_orderkey"])
    few = F.lit(100 * moved < lines.count())
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "n_source", "n_target", few.alias("few_moved"))


@query(
    """
    SELECT 'lineitem' AS name, column_name AS "column",
           CASE column_name WHEN 'l_tax' THEN 'MISSING' WHEN 'l_quantity' THEN 'TYPE'
                WHEN 'l_returnflag' THEN 'ORDER' WHEN 'l_linestatus' THEN 'ORDER'
                WHEN 'l_shipdate' THEN 'ORDER' ELSE 'SAME' END AS status,
           (SELECT count(*) FROM lineitem) AS target_rows
    FROM (SELECT DISTINCT column_name FROM information_schema.columns WHERE table_name = 'lineitem')
    UNION ALL SELECT 'lineitem', 'l_cents', 'EXTRA', (SELECT count(*) FROM lineitem)
    """
)
def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a table and of a copy with a column dropped, retyped and added."""
    here = Estate(spark, sf_dir, "lineitem")
    select = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS l_cents",
    ]
    done(copy.ctas(spark, here.source("lineitem"), here.target("lineitem"), select=select))
    diff = validate.schema_diff(
        inventory(spark, SOURCE, here.schema), inventory(spark, TARGET, here.schema)
    )
    rows = here.read(here.target("lineitem")).agg(F.count(F.lit(1)).alias("target_rows"))
    return diff.join(rows.withColumn("name", F.lit("lineitem")), "name").select(
        "name", "column", "status", "target_rows"
    )
