"""Decomposing CREATE statements into clauses, as one projection over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.functions.literals import ddl_pieces, mask, unmask, unquote

# Clause patterns for a masked statement (see ``literals.mask``), in which a quoted
# piece is '<n>'. Clauses start a line, so nothing inside columns or values matches.
_CLAUSE_START = (
    r"(?:USING|OPTIONS|PARTITIONED|CLUSTERED|CLUSTER|SORTED|LOCATION|COMMENT|TBLPROPERTIES"
    r"|WITH|AS|DEFAULT)\b"
)
_NAME = r"((?:[\w.]++|'\d+')+)"
_HEAD = rf"(?s)^CREATE (TABLE|VIEW) {_NAME}"
_COLUMNS = rf"{_HEAD}\s*\(\s*(.*?)\)\s*(?=\n{_CLAUSE_START}|$)"
_USING = r"(?m)^(USING )(\w+)"
_LOCATION = r"(?m)^(LOCATION )('\d+')"
_COMMENT = r"(?m)^(COMMENT )('\d+')"
_PARTITION_BY = r"(?m)^(PARTITIONED BY \()(?!cluster_by)([^()]*)(\))"
_CLUSTER_BY = (
    r"(?m)^(PARTITIONED BY \(cluster_by\(|CLUSTER BY \(|CLUSTERED BY \()([^()]*)(\)\)?)"
)
_BUCKETS = r"(?m)^INTO (\d+) BUCKETS"
_PROPERTIES = r"(?m)^(TBLPROPERTIES \()([^)]*)(\))"
_OPTIONS = r"(?m)^(OPTIONS \()([^)]*)(\))"
_VIEW_BODY = r"(?s)^CREATE VIEW .*?(\nAS .*)$"

# Placeholders of the statement template.
PLACEHOLDERS = (
    "<<full_table_name>>",
    "<<location>>",
    "<<schema>>",
    "<<using>>",
    "<<partition_by>>",
    "<<comment>>",
    "<<cluster_by>>",
    "<<table_properties>>",
    "<<options>>",
)


def _template(masked: Column) -> Column:
    """The statement with each clause's content replaced by its placeholder."""
    name, location, schema, using, partition, comment, cluster, properties, options = PLACEHOLDERS
    text = F.regexp_replace(masked, _COLUMNS, f"CREATE $1 $2 ({schema})\n")
    text = F.regexp_replace(text, _HEAD, f"CREATE $1 {name}")
    text = F.regexp_replace(text, _LOCATION, f"$1'{location}'")
    text = F.regexp_replace(text, _USING, f"$1{using}")
    text = F.regexp_replace(text, _PARTITION_BY, f"$1{partition}$3")
    text = F.regexp_replace(text, _COMMENT, f"$1'{comment}'")
    text = F.regexp_replace(text, _CLUSTER_BY, f"$1{cluster}$3")
    text = F.regexp_replace(text, _PROPERTIES, f"$1{properties}$3")
    text = F.regexp_replace(text, _OPTIONS, f"$1{options}$3")
    return F.trim(_one_line(text))


def _one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"\s*\n\s*", " ")


def decompose(statements: DataFrame, column: str = "createtab_stmt") -> DataFrame:
    """Add one column per DDL clause to a DataFrame of CREATE statements.

    All other columns are kept. A clause the statement lacks is an empty string.
    ``properties_map`` and ``options_map`` hold the parsed key/value clauses and
    ``partition_cols`` the partition columns as an array.
    """
    work = (
        statements.withColumn("__pieces", ddl_pieces(F.col(column)))
        .withColumn("__whole", mask(F.col("__pieces")))
        .withColumn("__body", F.regexp_extract("__whole", _VIEW_BODY, 1))
        .withColumn(
            "__masked",
            F.substring("__whole", F.lit(1), F.length("__whole") - F.length("__body")),
        )
    )
    masked, pieces, body = F.col("__masked"), F.col("__pieces"), F.col("__body")

    def clause(pattern: str, group: int) -> Column:
        return unmask(F.trim(_one_line(F.regexp_extract(masked, pattern, group))), pieces)

    def value(pattern: str, group: int) -> Column:
        return unquote(clause(pattern, group))

    return work.select(
        *[c for c in statements.columns if c != column],
        F.regexp_replace(F.col(column), "\n", " ").alias("original_ddl"),
        F.lower(F.regexp_extract(masked, _HEAD, 1)).alias("object_type"),
        clause(_HEAD, 2).alias("full_table_name"),
        clause(_COLUMNS, 3).alias("table_schema"),
        clause(_USING, 2).alias("using"),
        clause(_PARTITION_BY, 2).alias("partition_by"),
        clause(_CLUSTER_BY, 2).alias("cluster_by"),
        F.regexp_extract(masked, _BUCKETS, 1).alias("buckets"),
        clause(_PROPERTIES, 2).alias("table_properties"),
        value(_COMMENT, 2).alias("comment"),
        clause(_OPTIONS, 2).alias("options"),
        value(_LOCATION, 2).alias("location"),
        unmask(F.concat(_template(masked), F.rtrim(_one_line(body))), pieces).alias("dynamic_ddl"),
        _pairs(F.regexp_extract(masked, _PROPERTIES, 2), pieces).alias("properties_map"),
        _pairs(F.regexp_extract(masked, _OPTIONS, 2), pieces).alias("options_map"),
        _name_list(F.regexp_extract(masked, _PARTITION_BY, 2), pieces).alias("partition_cols"),
    )


def _name_list(masked: Column, pieces: Column) -> Column:
    names = F.filter(F.split(F.trim(masked), r"\s*,\s*"), lambda part: part != "")
    return F.transform(names, lambda n: F.regexp_replace(unmask(n, pieces), "^`|`$", ""))


def _pairs(masked: Column, pieces: Column) -> Column:
    """Map of ``'k' = 'v'`` pairs; both sides are quoted pieces."""
    pairs = F.regexp_extract_all(masked, F.lit(r"('\d+'\s*=\s*'\d+')"), F.lit(1))

    def side(pair: Column, pattern: str) -> Column:
        return unquote(F.get(pieces, F.regexp_extract(pair, pattern, 1).try_cast("int")))

    return F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(side(p, r"^'(\d+)'").alias("key"), side(p, r"'(\d+)'$").alias("value")),
        )
    )
