"""Resolving storage locations against mounts and external locations.

Every prefix test is segment-aligned and becomes an equality join: a path is cut
to the depths that occur on the other side, so no plan here compares all pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.paths import (
    LOCAL_STORAGE_SCHEME,
    PLATFORM_ROOT_SOURCES,
    REJECTED_SCHEMES,
    SUPPORTED_SCHEMES,
    ancestors,
    between,
    depth,
    is_under,
    prefix_at,
    remainder,
    scheme,
    strip_slash,
    unescape_spaces,
)
from tablemove.operators.lookup import Lookup, lookup_join, prepare

MOUNTS = T.StructType(
    [T.StructField("mount_point", T.StringType()), T.StructField("source", T.StringType())]
)
EXTERNAL_LOCATIONS = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]
)

RESOLVED = "RESOLVED"
UNCHANGED = "UNCHANGED"
NEEDS_DATA_MOVEMENT = "NEEDS_DATA_MOVEMENT"
DEFAULT_LOCATION = "DEFAULT_LOCATION"

EQUAL = "EQUAL"
LOCATION_UNDER_MOUNT = "LOCATION_UNDER_MOUNT"
MOUNT_UNDER_LOCATION = "MOUNT_UNDER_LOCATION"
NOT_COVERED = "NOT_COVERED"
AMBIGUOUS = "AMBIGUOUS"

# Name, url and comment of a planned external location.
_LOCATION_NAME = "{prefix}_ext_loc_{container}"
_LOCATION_URL = "abfss://{host}/"
_LOCATION_COMMENT = "Created from mount point {mount_point} with mount source {source}"


def usable_mounts(mounts: DataFrame, ignore_sources: tuple[str, ...] = PLATFORM_ROOT_SOURCES) -> DataFrame:
    """Mounts with normalised slashes, without platform roots, one row per mount point.

    Of several sources of one mount point the smallest counts; ``mount_conflicts`` names such points.
    """
    return _normalised(mounts, ignore_sources).groupBy("mount_point").agg(F.min("source").alias("source")).filter(
        F.col("source").isNotNull()
    )


def _normalised(mounts: DataFrame, ignore_sources: tuple[str, ...]) -> DataFrame:
    kept = mounts.filter(~F.coalesce(F.col("source").isin(*ignore_sources), F.lit(False)))
    return kept.select(
        strip_slash(F.col("mount_point")).alias("mount_point"), strip_slash(F.col("source")).alias("source")
    )


def mount_conflicts(mounts: DataFrame, ignore_sources: tuple[str, ...] = PLATFORM_ROOT_SOURCES) -> DataFrame:
    """Mount points that are listed with several sources, or without any: ``mount_point, sources``."""
    grouped = _normalised(mounts, ignore_sources).groupBy("mount_point").agg(
        F.sort_array(F.collect_set("source")).alias("sources")
    )
    return grouped.filter(F.size("sources") != 1)


def longest_prefix(rows: DataFrame, path: str, prefixes: Lookup, key: str) -> DataFrame:
    """Left join each row to the longest segment-aligned prefix of ``path``.

    ``prefixes`` has unique ``key`` values; its columns are added, NULL without a
    match. When the prefixes are measured small, one broadcast join per depth that occurs
    among them, in a single stage. Else only the distinct paths are shuffled: cut at all those
    depths they meet the prefixes in one salted join, and the longest match of each path goes back to its rows.
    """
    added = prefixes.frame.columns
    sized = prefixes.frame.withColumn("__depth", depth(F.col(key)))
    depths = sorted((r[0] for r in sized.select("__depth").distinct().toLocalIterator()), reverse=True)
    if not depths:
        types = prefixes.frame.schema
        return rows.select("*", *[F.lit(None).cast(types[c].dataType).alias(c) for c in added])
    if not prefixes.small:
        paths = rows.select(F.col(path).alias("__p")).filter("__p IS NOT NULL").distinct()
        cuts = F.array(*[F.struct(F.lit(d).alias("d"), prefix_at(F.col("__p"), d).alias("k")) for d in depths])
        each = paths.select("__p", F.inline(cuts)).filter("k IS NOT NULL")
        whole = sized.select(F.col(key).alias("k"), F.struct(*added).alias("__m"))
        found = lookup_join(each, Lookup(whole, False), ["k"], "inner")
        best = found.groupBy("__p").agg(F.max_by("__m", "d").alias("__best"))
        joined = rows.join(best, rows[path] == best["__p"], "left")
        return joined.select(*rows.columns, *[F.col("__best")[c].alias(c) for c in added])
    result = rows
    for level in depths:
        at_level = sized.filter(F.col("__depth") == level).select(
            F.col(key).alias(f"__k{level}"), F.struct(*added).alias(f"__m{level}")
        )
        result = lookup_join(
            result.withColumn(f"__k{level}", prefix_at(F.col(path), level)),
            Lookup(at_level, prefixes.small),
            [f"__k{level}"],
        ).drop(f"__k{level}")
    best = F.coalesce(*[F.col(f"__m{level}") for level in depths])
    return result.select(*rows.columns, best.alias("__best")).select(
        *rows.columns, *[F.col("__best")[c].alias(c) for c in added]
    )


def _mounted_path(location: Column) -> Column:
    """A location as a path that mount points are prefixes of; plain paths are such already."""
    return F.when(
        _is_local(location), F.substring(location, len(LOCAL_STORAGE_SCHEME) + 1, 1 << 30)
    ).when(F.startswith(location, F.lit("/")), location)


def _is_local(location: Column) -> Column:
    return F.startswith(location, F.lit(LOCAL_STORAGE_SCHEME))


def resolve(objects: DataFrame, mounts: DataFrame, small: bool | None = None) -> DataFrame:
    """Add ``external_location`` and ``resolution`` to rows with ``object_type, location``.

    A location below a mount gets the mount's source in place of the mount (longest
    mount wins) with escaped spaces decoded. Without a mount, platform-local storage
    means the default location for a schema or catalog and data movement for a
    table; any other location is kept.
    """
    usable = usable_mounts(mounts).select(
        F.col("mount_point").alias("__mount_point"), F.col("source").alias("__source")
    )
    located = objects.withColumn("__path", _mounted_path(F.col("location")))
    joined = longest_prefix(located, "__path", prepare(usable, small), "__mount_point")
    path, source = F.col("__path"), F.col("__source")
    is_local = _is_local(F.col("location"))
    is_table = F.lower("object_type") == "table"
    moved = unescape_spaces(F.concat(source, remainder(path, F.col("__mount_point"))))
    return joined.select(
        *objects.columns,
        F.when(source.isNotNull(), moved).when(~is_local, F.col("location")).alias("external_location"),
        F.when(F.col("location").isNull(), F.lit(None))
        .when(source.isNotNull(), RESOLVED)
        .when(~is_local, UNCHANGED)
        .when(is_table, NEEDS_DATA_MOVEMENT)
        .otherwise(DEFAULT_LOCATION)
        .alias("resolution"),
    )


def _with_mount(tables: DataFrame, usable: DataFrame, small: bool | None) -> DataFrame:
    """Left join tables to the mount they are stored under, by point or by source."""
    as_prefix = usable.select(
        F.explode(F.array("mount_point", "source")).alias("__prefix"), "mount_point", "source"
    )
    prefixes = as_prefix.groupBy("__prefix").agg(F.min(F.struct("mount_point", "source")).alias("__mount"))
    located = tables.withColumn(
        "__path", F.coalesce(_mounted_path(F.col("location")), F.col("location"))
    )
    joined = longest_prefix(located, "__path", prepare(prefixes, small), "__prefix")
    return joined.select(
        *tables.columns,
        F.col("__mount.mount_point").alias("mount_point"),
        F.col("__mount.source").alias("mount_source"),
    )


def mounted(tables: DataFrame, mounts: DataFrame, small: bool | None = None) -> DataFrame:
    """Tables stored under any mount, with ``mount_point`` and ``mount_source``."""
    return _with_mount(tables, usable_mounts(mounts), small).filter(F.col("mount_point").isNotNull())


def _sides(
    mounts: DataFrame, external_locations: DataFrame, small: bool | None
) -> tuple[Lookup, Lookup]:
    """Usable mounts and named urls, both persisted and measured."""
    named = external_locations.select("name", strip_slash(F.col("url")).alias("url"))
    return prepare(usable_mounts(mounts), small), prepare(named, small)


def _pairs(usable: Lookup, named: Lookup) -> DataFrame:
    """Distinct sources and urls one of which contains the other, classified."""
    sources, urls = usable.frame.select("source").distinct(), named.frame.select("url").distinct()
    # Location below or equal to a mount: the location's ancestors meet the sources.
    below = lookup_join(
        urls.select("url", F.explode(ancestors(F.col("url"))).alias("source")),
        Lookup(sources, usable.small),
        ["source"],
        "inner",
    )
    # Mount strictly below a location: the source's ancestors meet the urls.
    above = lookup_join(
        sources.select("source", F.explode(ancestors(F.col("source"))).alias("url")).filter(
            F.col("url") != F.col("source")
        ),
        Lookup(urls, named.small),
        ["url"],
        "inner",
    )
    source, url = F.col("source"), F.col("url")
    return (
        below.select("source", "url")
        .unionByName(above.select("source", "url"))
        .select(
            "source",
            "url",
            F.when(source == url, EQUAL)
            .when(is_under(url, source), LOCATION_UNDER_MOUNT)
            .otherwise(MOUNT_UNDER_LOCATION)
            .alias("coverage"),
            F.when(source == url, "")
            .when(is_under(url, source), remainder(url, source))
            .otherwise(remainder(source, url))
            .alias("folder"),
        )
    )


def _per_source(usable: Lookup, named: Lookup) -> Lookup:
    """Per mount source: number of related locations and, if it is one, which."""
    names = named.frame.groupBy("url").agg(F.count(F.lit(1)).alias("names"), F.min("name").alias("name"))
    related = (
        lookup_join(_pairs(usable, named), Lookup(names, named.small), ["url"], "inner")
        .groupBy("source")
        .agg(
            F.sum("names").alias("n_locations"),
            F.min("coverage").alias("coverage"),
            F.min("folder").alias("folder"),
            F.min("name").alias("name"),
        )
    )
    # At most one row per source with one url and one name: bounded by the two sides.
    return Lookup(related, usable.small and named.small)


def coverage(mounts: DataFrame, external_locations: DataFrame, small: bool | None = None) -> DataFrame:
    """How each mount is covered: one row per mount and related external location.

    ``coverage`` is EQUAL, LOCATION_UNDER_MOUNT, MOUNT_UNDER_LOCATION or, for a mount
    without any related location, NOT_COVERED. ``folder`` is the part of the longer
    path below the shorter one.
    """
    usable, named = _sides(mounts, external_locations, small)
    pairs = _pairs(usable, named)
    # Each pair looks its mount up: a mount with most locations is not one task's work.
    related = lookup_join(lookup_join(pairs, usable, ["source"], "inner"), named, ["url"], "inner")
    columns = ["mount_point", "source", "name", "url", "coverage", "folder"]
    bare = usable.frame.join(pairs.select("source").distinct(), "source", "left_anti").select(
        "mount_point",
        "source",
        *[F.lit(None).cast("string").alias(c) for c in ("name", "url")],
        F.lit(NOT_COVERED).alias("coverage"),
        F.lit(None).cast("string").alias("folder"),
    )
    return related.select(*columns).unionByName(bare)


def ambiguous(mounts: DataFrame, external_locations: DataFrame, small: bool | None = None) -> DataFrame:
    """Mounts related to more than one external location, with their number."""
    usable, named = _sides(mounts, external_locations, small)
    related = _per_source(usable, named)
    many = related.frame.filter(F.col("n_locations") > 1)
    return lookup_join(usable.frame, Lookup(many, related.small), ["source"], "inner").select(
        "mount_point", "source", "n_locations"
    )


def table_coverage(
    tables: DataFrame, mounts: DataFrame, external_locations: DataFrame, small: bool | None = None
) -> DataFrame:
    """Coverage of the mount each mounted table lives on.

    Adds ``mount_point, mount_source, external_location_name, coverage, n_locations,
    folder_in_path``. A mount with more than one related location is AMBIGUOUS;
    tables without a mount are NOT_COVERED. ``folder_in_path`` says whether the folder
    of the single related location occurs in the table's path.
    """
    usable, named = _sides(mounts, external_locations, small)
    related = _per_source(usable, named)
    per_source = related.frame.select(
        F.col("source").alias("mount_source"),
        "n_locations",
        F.col("coverage").alias("__class"),
        F.col("folder").alias("__folder"),
        F.col("name").alias("__name"),
    )
    placed = _with_mount(tables, usable.frame, small)
    joined = lookup_join(placed, Lookup(per_source, related.small), ["mount_source"])
    many = F.col("n_locations") > 1
    return joined.select(
        *tables.columns,
        "mount_point",
        "mount_source",
        F.when(~many, F.col("__name")).alias("external_location_name"),
        F.when(many, AMBIGUOUS).otherwise(F.coalesce("__class", F.lit(NOT_COVERED))).alias("coverage"),
        F.coalesce("n_locations", F.lit(0)).alias("n_locations"),
        F.coalesce(
            ~many & (F.col("__folder") != "") & F.contains(F.col("location"), F.col("__folder")),
            F.lit(False),
        ).alias("folder_in_path"),
    )


def plan(
    tables: DataFrame,
    mounts: DataFrame,
    name_prefix: str = "",
    mount_point: str = "",
    small: bool | None = None,
) -> DataFrame:
    """External locations to create: one per container that any table is mounted on.

    Rows have ``name, url, comment, status``; ``status`` is PLANNED, REJECTED (a
    deprecated or unsupported source, or a mount point listed with several) or NAME_CONFLICT
    (one name, several urls).
    ``mount_point`` restricts the plan to one mount.
    """
    if mount_point:
        mounts = mounts.filter(strip_slash(F.col("mount_point")) == mount_point.rstrip("/"))
    used = mounted(tables, mounts, small)
    # Distinct pairs first: a hash aggregation leaves one row per mount before the shuffle.
    pairs = used.select("mount_source", "mount_point").distinct()
    sources = pairs.groupBy("mount_source").agg(F.min("mount_point").alias("mount_point"))
    source = F.concat(F.col("mount_source"), F.lit("/"))
    kind = scheme(F.col("mount_source"))
    container, host = between(source, "//", "@"), between(source, "//", "/")
    supported = kind.isin(*SUPPORTED_SCHEMES) & container.isNotNull() & host.isNotNull()
    candidates = sources.select(
        F.when(supported, _fill(_LOCATION_NAME, prefix=F.lit(name_prefix), container=container)).alias("name"),
        F.when(supported, _fill(_LOCATION_URL, host=host)).alias("url"),
        F.struct("mount_point", F.col("mount_source").alias("source")).alias("__from"),
        F.when(kind.isin(*REJECTED_SCHEMES), f"deprecated scheme, remount as {SUPPORTED_SCHEMES[0]}")
        .when(~supported, "unsupported source")
        .alias("reason"),
    )
    accepted = (
        candidates.filter("reason IS NULL").groupBy("name", "url").agg(F.min("__from").alias("__from"))
    )
    per_name = accepted.groupBy("name").agg(F.count(F.lit(1)).alias("__urls"))
    planned = lookup_join(accepted, prepare(per_name, small), ["name"], "inner").select(
        "name",
        "url",
        "__from",
        F.when(F.col("__urls") > 1, "NAME_CONFLICT").otherwise("PLANNED").alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    rejected = candidates.filter("reason IS NOT NULL").select(
        "name", "url", "__from", F.lit("REJECTED").alias("status"), "reason"
    )
    conflicts = mount_conflicts(mounts).select(
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("url"),
        F.struct("mount_point", F.concat_ws(", ", "sources").alias("source")).alias("__from"),
        F.lit("REJECTED").alias("status"),
        F.lit("mount point without a single source").alias("reason"),
    )
    return planned.unionByName(rejected).unionByName(conflicts).select(
        "name",
        "url",
        _fill(
            _LOCATION_COMMENT, mount_point=F.col("__from.mount_point"), source=F.col("__from.source")
        ).alias("comment"),
        "status",
        "reason",
    )


def _fill(template: str, **values: Column) -> Column:
    """Column form of ``str.format``."""
    parts, rest = [], template
    while "{" in rest:
        before, rest = rest.split("{", 1)
        key, rest = rest.split("}", 1)
        parts += [F.lit(before), values[key]]
    return reduce(lambda a, b: F.concat(a, b), [*parts, F.lit(rest)])
