"""Column functions on storage paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path conventions of the platform the objects come from.
LOCAL_STORAGE_SCHEME = "dbfs:"
PLATFORM_ROOT_SOURCES = ("DatabricksRoot",)
ESCAPED_SPACE = "%20"
REJECTED_SCHEMES = ("wasbs",)
SUPPORTED_SCHEMES = ("abfss",)


def strip_slash(path: Column) -> Column:
    """Drop trailing slashes, so that prefixes end on a segment."""
    return F.regexp_replace(path, "/+$", "")


def unescape_spaces(path: Column) -> Column:
    return F.replace(path, F.lit(ESCAPED_SPACE), F.lit(" "))


def depth(path: Column) -> Column:
    """Number of ``/``-separated segments."""
    return F.size(F.split(path, "/"))


def prefix_at(path: Column, segments: int) -> Column:
    """The first ``segments`` segments; NULL when the path is shorter."""
    return F.when(depth(path) >= segments, F.substring_index(path, "/", segments))


def ancestors(path: Column) -> Column:
    """All segment-aligned prefixes of a path, itself included, shortest first."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def is_under(path: Column, prefix: Column) -> Column:
    """Segment-aligned containment: equal, or below ``prefix``."""
    return (path == prefix) | F.startswith(path, F.concat(prefix, F.lit("/")))


def remainder(path: Column, prefix: Column) -> Column:
    """What follows ``prefix`` in ``path``."""
    return F.substring(path, F.length(prefix) + 1, F.length(path))


def between(text: Column, start: str, end: str) -> Column:
    """Shortest non-empty text between two markers; NULL when there is none.

    The markers are regular expressions; groups in them must not capture.
    """
    return F.nullif(F.regexp_extract(text, f"{start}(.+?){end}", 1), F.lit(""))


def scheme(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
