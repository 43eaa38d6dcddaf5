"""Object names: quoting, parsing, defaulting, and catalog resolution."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SESSION_CATALOG = "spark_catalog"
FOLD_SEPARATOR = "__"

_PART = re.compile(r"`((?:[^`]|``)*)`|([^`.]+)")


def quote(part: str) -> str:
    """Back-quote one identifier part."""
    return "`" + part.replace("`", "``") + "`"


def literal(value: str) -> str:
    """Render a Python string as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def require(**arguments) -> None:
    """Reject empty arguments at the API edge."""
    for name, value in arguments.items():
        if value is None or (hasattr(value, "__len__") and len(value) == 0):
            raise ValueError(f"{name} is empty")


@dataclass(frozen=True)
class ObjectName:
    """A three-level name ``catalog.schema.name``."""

    catalog: str
    schema: str
    name: str

    def __post_init__(self):
        require(catalog=self.catalog, schema=self.schema, name=self.name)

    @classmethod
    def parse(cls, text: str | "ObjectName") -> "ObjectName":
        """Parse ``c.s.t`` or ``s.t`` (session catalog); parts may be back-quoted."""
        if isinstance(text, cls):
            return text
        require(name=text)
        parts, rest = [], text
        while rest:
            match = _PART.match(rest)
            if not match:
                raise ValueError(f"not an object name: {text!r}")
            quoted, plain = match.groups()
            parts.append(plain if quoted is None else quoted.replace("``", "`"))
            rest = rest[match.end():]
            if rest and (rest[0] != "." or len(rest) == 1):
                raise ValueError(f"not an object name: {text!r}")
            rest = rest[1:]
        if len(parts) == 2:
            parts.insert(0, SESSION_CATALOG)
        if len(parts) != 3:
            raise ValueError(f"expected catalog.schema.name, got {text!r}")
        return cls(*parts)

    def __str__(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.name}"

    def renamed(self, name: str) -> "ObjectName":
        return ObjectName(self.catalog, self.schema, name)


def is_registered(spark: SparkSession, catalog: str) -> bool:
    """True when ``catalog`` is one Spark can address itself."""
    if catalog == SESSION_CATALOG:
        return True
    return spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


def physical_schema(spark: SparkSession, catalog: str, schema: str) -> tuple[str, str]:
    """Map a logical ``(catalog, schema)`` to one Spark can address.

    A catalog that is not configured lives inside the session catalog, its name
    folded into the database name as ``<catalog>__<schema>``.
    """
    require(catalog=catalog, schema=schema)
    if is_registered(spark, catalog):
        return catalog, schema
    return SESSION_CATALOG, f"{catalog}{FOLD_SEPARATOR}{schema}"


def schema_sql(spark: SparkSession, catalog: str, schema: str) -> str:
    """Quoted SQL text of a schema."""
    return ".".join(quote(p) for p in physical_schema(spark, catalog, schema))


def table_sql(spark: SparkSession, name: str | ObjectName) -> str:
    """Quoted SQL text of a table or view."""
    name = ObjectName.parse(name)
    return f"{schema_sql(spark, name.catalog, name.schema)}.{quote(name.name)}"


def session_sql(spark: SparkSession, name: str | ObjectName) -> str | None:
    """Two-part SQL text of a session-catalog table; None for any other catalog."""
    name = ObjectName.parse(name)
    catalog, schema = physical_schema(spark, name.catalog, name.schema)
    return f"{quote(schema)}.{quote(name.name)}" if catalog == SESSION_CATALOG else None


def target_of(
    source: ObjectName, target_catalog: str, target_schema: str = "", target_table: str = ""
) -> ObjectName:
    """Name of the target object; empty parts default to the source's."""
    require(target_catalog=target_catalog)
    return ObjectName(target_catalog, target_schema or source.schema, target_table or source.name)


def split_names(names: str | list[str] | None) -> list[str]:
    """Split ``"a, b"`` into names; blanks are dropped, order is kept."""
    if not names:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return [p.strip() for p in parts if p.strip()]


def split_names_column(names: Column) -> Column:
    """Column form of :func:`split_names`; an empty text gives an empty array."""
    return F.filter(F.split(F.trim(names), r"\s*,\s*"), lambda part: part != "")


def target_name_column(source: Column, target: Column) -> Column:
    """Column form of name defaulting: the target if given, else the source."""
    return F.coalesce(F.nullif(F.trim(target), F.lit("")), source)
