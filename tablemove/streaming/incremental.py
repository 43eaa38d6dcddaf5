"""Incremental clones: only files of the source that changed since the last run are copied.

A clone's state is a map from each file of the source to the files of the clone that hold its rows.
Every task of a copy reads one source file, or a part of one, so each file that it writes
belongs to that file alone. A run lists the source, copies files that are new or were rewritten to a
folder that readers don't see, checks them there, moves them into the table, deletes the clone's files of
rewritten and removed source files, and writes the map last. A run that was broken off has left a
note; the next one puts the table back to what the map says and goes on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemove.functions.names import ObjectName, quote, table_sql
from tablemove.operators import markers
from tablemove.operators.copy import (
    STATE_PROPERTY,
    create_like,
    measured,
    measured_fingerprint,
    own_properties,
    publish,
    repair,
)
from tablemove.operators.outcome import CLONE, Outcome, attempt
from tablemove.operators.validate import LEVELS, require_equal, require_no_difference, take_fingerprint
from tablemove.sources.formats import effective_format
from tablemove.sources.inventory import VIEW, describe, exists
from tablemove.sources.workspace import (
    children,
    move,
    new_area,
    read_note,
    remove,
    shared_root,
    unique,
    write_note,
)

#: Paths that are handed to a reader at a time.
FILES_PER_READ = 10_000
LISTING_TASKS = 1000
FILE_THREADS = 16
#: Maps of earlier runs that are kept.
KEPT_MAPS = 2

_VERSION = ["path", "modificationTime", "length"]
_LISTED = "path string, modificationTime timestamp, length long"
#: ``file`` is relative to the clone's location, and NULL for a source file without rows.
_MAP = f"{_LISTED}, file string, rows long, run string"
#: How the names of a clone's own files begin.
_OWN = r"^run_[0-9a-f]{12}-"


@dataclass(frozen=True)
class State:
    """Folder of one generation of a clone, of which every rebuild starts a new one."""

    folder: str

    def files(self, spark: SparkSession) -> DataFrame:
        """The map after the last run that ended."""
        ended = [n for n in self._maps(spark) if "_SUCCESS" in children(spark, f"{self.folder}/map/{n}")]
        if not ended:
            return spark.createDataFrame([], _MAP)
        return spark.read.schema(_MAP).parquet(f"{self.folder}/map/{ended[-1]}")

    def save(self, spark: SparkSession, files: DataFrame) -> None:
        """The commit of a run: a new map, written whole, so that state never grows with the number of runs."""
        maps = self._maps(spark)
        number = int(maps[-1]) + 1 if maps else 1
        files.write.parquet(f"{self.folder}/map/{number:08d}")
        for old in maps[: max(0, len(maps) + 1 - KEPT_MAPS)]:
            remove(spark, f"{self.folder}/map/{old}")

    def _maps(self, spark: SparkSession) -> list[str]:
        return sorted(children(spark, f"{self.folder}/map"))

    def begin(self, spark: SparkSession, run: str) -> None:
        write_note(spark, f"{self.folder}/begun/{run}", run)

    def end(self, spark: SparkSession, run: str) -> None:
        remove(spark, f"{self.folder}/begun/{run}")

    def broken_off(self, spark: SparkSession) -> list[str]:
        return [n for n in children(spark, f"{self.folder}/begun") if not n.startswith(".")]

    def own(self, spark: SparkSession, target: ObjectName) -> None:
        write_note(spark, f"{self.folder}/owner", str(target))

    def owner(self, spark: SparkSession) -> str:
        return read_note(spark, f"{self.folder}/owner")


def _listing_session(spark: SparkSession) -> SparkSession:
    """A session of its own, since listing tasks are cheap and need not follow file sizes."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionNum", LISTING_TASKS)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def list_files(spark: SparkSession, location: str) -> DataFrame:
    """Path, modification time and size of the data files below a location.

    Contents are not read, as no content column is selected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    return files.select(*_VERSION)


def _listed(spark: SparkSession, location: str, area: str, label: str) -> DataFrame:
    """A listing that stays as it is, however often it is read."""
    session = _listing_session(spark)
    path = f"{area}/{label}"
    list_files(session, location).write.parquet(path)
    return session.read.schema(_LISTED).parquet(path)


def _path_chunks(files: DataFrame) -> Iterator[list[str]]:
    paths = (r["path"] for r in files.select("path").toLocalIterator())
    while chunk := list(islice(paths, FILES_PER_READ)):
        yield [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in chunk]


def _one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session like the given one whose reading tasks never hold more than one file."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    # A file counts as long as a whole task, so that no other one is put beside it.
    session.conf.set("spark.sql.files.openCostInBytes", session.conf.get("spark.sql.files.maxPartitionBytes"))
    session.conf.unset("spark.sql.files.maxPartitionNum")
    return session


def _reader(spark: SparkSession, about: dict, fmt: str, schema: T.StructType, files: DataFrame) -> Callable:
    """Reads the given files of a table, with the columns that a function takes from each part."""
    options = {k: v for k, v in about["options"].items() if k.lower() != "path"}
    reader = spark.read.format(fmt).options(**options).option("basePath", about["location"]).schema(schema)
    chunks = list(_path_chunks(files))

    def read(*columns: Column) -> DataFrame:
        return reduce(DataFrame.unionByName, [reader.load(chunk).select(*columns) for chunk in chunks])

    return read


def _plain_path(column: Column) -> Column:
    """A path of file metadata as a listing has it: not percent-encoded, local ones with one slash."""
    decoded = F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def clone_append(
    spark: SparkSession,
    source: str | ObjectName,
    target: str | ObjectName,
    state_root: str | None = None,
    level: str = "count",
) -> Outcome:
    """Bring a clone up to date with the files of its source.

    Rows of new files are added. A file that was rewritten or removed takes its own rows along, and no other
    file of the clone is touched. Columns that are new in the source are added to the clone; its older rows
    have NULL there. If columns went away or changed, or the partitioning or format did, the clone is
    built anew beside the old one and takes its place once it is checked. ``level`` is the check of
    the rows of this run, made before they are visible. State is kept below ``state_root`` and belongs to this
    target alone; a table that carries the state of another one is refused.
    """
    source, target = ObjectName.parse(source), ObjectName.parse(target)

    def work(outcome: Outcome) -> None:
        if level not in LEVELS:
            raise ValueError(f"level must be one of {', '.join(LEVELS)}")
        spark.catalog.refreshTable(table_sql(spark, source))
        about = describe(spark, source)
        outcome.source_object_type, outcome.action = about["object_type"], CLONE
        if about["object_type"] == VIEW:
            raise ValueError(f"{source} is a view; clone copies tables")
        fmt = effective_format(about["provider"], about["serde"])
        state = current_state(spark, target)
        area = new_area(spark, "clone_run")
        try:
            current = _listed(spark, about["location"], area, "source")
            if state is None or not _same_layout(spark, source, about, fmt, target):
                root = state_root or f"{shared_root(spark)}/tablemove/clones/{target.schema}/{target.name}"
                rows = _rebuild(spark, source, about, fmt, target, State(f"{root}/{unique('run')}"), current, level)
                outcome.description = "all files copied"
            else:
                *rows, outcome.description = _update(spark, source, about, fmt, target, state, current, area, level)
        finally:
            remove(spark, area)
        spark.sql(f"REFRESH TABLE {table_sql(spark, target)}")
        outcome.source_rows, outcome.target_rows = rows
        markers.mark(spark, source, "clone", str(target), "incremental clone")

    return attempt("clone", source, target, work)


def current_state(spark: SparkSession, target: ObjectName) -> State | None:
    """The state that a table carries; None if there is no such table."""
    if not exists(spark, target):
        return None
    folder = describe(spark, target)["properties"].get(STATE_PROPERTY)
    if folder is None:
        raise ValueError(f"{target} exists and is not an incremental clone")
    state = State(folder)
    if (owner := state.owner(spark)) != str(target):
        raise ValueError(f"{target} carries the state of {owner}")
    return state


def _columns(spark: SparkSession, table: ObjectName) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in spark.table(table_sql(spark, table)).schema}


def _same_layout(spark: SparkSession, source: ObjectName, about: dict, fmt: str, target: ObjectName) -> bool:
    """True if the clone can take the source's files as it is, or with some more columns."""
    copied = describe(spark, target)
    lowered = lambda names: [n.lower() for n in names or []]
    mine, theirs = _columns(spark, target), _columns(spark, source)
    return (
        (copied["provider"] or "").lower() == fmt
        and lowered(copied["partition_cols"]) == lowered(about["partition_cols"])
        and (copied["n_buckets"], lowered(copied["bucket_cols"])) == (about["n_buckets"], lowered(about["bucket_cols"]))
        and all(n in theirs and theirs[n].dataType == f.dataType for n, f in mine.items())
    )


def _add_columns(spark: SparkSession, source: ObjectName, target: ObjectName) -> None:
    mine = _columns(spark, target)
    new = [f for n, f in _columns(spark, source).items() if n not in mine]
    if new:
        listed = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table_sql(spark, target)} ADD COLUMNS ({listed})")


@dataclass
class _Copied:
    """Files copied to a hidden folder: ``path, staged, file, rows``, and the checked numbers of rows."""

    files: DataFrame
    wrote: int
    read: int


def _copied(
    spark: SparkSession, source: ObjectName, about: dict, fmt: str, target: ObjectName, files: DataFrame, run: str, level: str, area: str
) -> _Copied:
    """Copy files into a hidden folder of the target and check them there."""
    own, copied = _one_file_a_task(spark), describe(spark, target)
    staging = f"{copied['location']}/_{run}"
    theirs, mine = (spark.table(table_sql(spark, t)).schema for t in (source, target))
    read = _reader(own, about, fmt, theirs, files)
    frame = read(*[F.col(quote(f.name)) for f in mine])
    counted, observation = measured(frame, level)
    options = {k: v for k, v in copied["options"].items() if k.lower() != "path"}
    counted.write.format(fmt).options(**options).partitionBy(*copied["partition_cols"]).save(staging)
    wrote = measured_fingerprint(observation)
    staged = own.read.format(fmt).options(**options).schema(mine).load(staging)
    found = (staged.count(),) if level == "count" else take_fingerprint(staged)
    if wrote != found:
        # The observation is not trusted alone to refuse a copy: ask the source.
        wrote = (frame.count(),) if level == "count" else take_fingerprint(frame)
    require_equal(wrote, found)
    if level == "diff":
        require_no_difference(frame, staged)

    # A task has one number, which is also in the names of the files it writes.
    read_by = read(F.col("_metadata.file_path").alias("path")).select(F.spark_partition_id().alias("task"), _plain_path(F.col("path")).alias("path"))
    read_by = read_by.groupBy("task", "path").agg(F.count("*").alias("rows"))
    name = F.element_at(F.split(_plain_path(F.col("_metadata.file_path")), f"/_{run}/"), 2)
    written_by = staged.select(name.alias("staged")).groupBy("staged").agg(F.count("*").alias("rows"))
    written_by = written_by.withColumn("task", F.regexp_extract("staged", r"part-(\d+)-", 1).cast("int"))
    pairs = read_by.withColumnRenamed("rows", "given").join(written_by, "task", "full_outer")
    folder, file = F.regexp_extract("staged", "^(.*/)?[^/]*$", 1), F.element_at(F.split("staged", "/"), -1)
    if about["n_buckets"]:
        # The bucket is in the names of the source's files, and has to be in those of the clone's.
        bucket = F.regexp_extract("path", r"(_\d+)(?:\.[^/]*)?$", 1)
        file = F.concat(F.regexp_extract(file, r"^[^.]*", 0), bucket, F.regexp_extract(file, r"^[^.]*(.*)$", 1))
    pairs = pairs.withColumn("file", F.concat(folder, F.lit(f"{run}-"), file))
    pairs.write.parquet(f"{area}/copied")
    pairs = spark.read.schema(pairs.schema).parquet(f"{area}/copied")
    off = pairs.groupBy("task").agg(F.sum("rows").alias("rows"), F.max("given").alias("given"), F.count_distinct("path").alias("files"))
    if not off.filter("NOT (rows <=> given AND files = 1)").isEmpty():
        raise AssertionError("the files written could not be told apart by the files they were read from")
    return _Copied(pairs.select("path", "staged", "file", "rows"), wrote[0], found[0])


def _each(work: Callable, items: Iterable) -> None:
    """File operations from a bounded number of threads; the driver holds a part of the names at a time."""
    items = iter(items)
    with ThreadPoolExecutor(FILE_THREADS) as pool:
        while chunk := list(islice(items, FILES_PER_READ)):
            list(pool.map(work, chunk))


def _move_in(spark: SparkSession, location: str, run: str, copied: DataFrame) -> None:
    """The copied files become visible, under names that begin with the run's."""
    rows = copied.select("staged", "file").toLocalIterator()
    _each(lambda r: move(spark, f"{location}/_{run}/{r['staged']}", f"{location}/{r['file']}"), rows)
    remove(spark, f"{location}/_{run}")


def _delete(spark: SparkSession, location: str, files: DataFrame) -> None:
    _each(lambda r: remove(spark, f"{location}/{r['file']}"), files.filter("file IS NOT NULL").select("file").toLocalIterator())


def _mapped(files: DataFrame, copied: DataFrame, run: str) -> DataFrame:
    """Map rows of newly copied files, those without rows included."""
    return files.join(copied.drop("staged"), "path", "left").select(*_VERSION, "file", "rows", F.lit(run).alias("run"))


def _rebuild(
    spark: SparkSession,
    source: ObjectName,
    about: dict,
    fmt: str,
    target: ObjectName,
    state: State,
    current: DataFrame,
    level: str,
) -> tuple[int, int]:
    """A clone from all listed files, whose state is complete before it is visible."""
    run = unique("run")
    state.own(spark, target)
    area = new_area(spark, "clone_rebuild")

    def write(name: ObjectName, where: str | None) -> tuple[int, ...]:
        properties = {**own_properties(about["properties"]), STATE_PROPERTY: state.folder}
        create_like(spark, source, name, None, properties, None if about["provider"] else fmt)
        if current.isEmpty():
            return (0,)
        made = _copied(spark, source, about, fmt, name, current, run, level, area)
        _move_in(spark, describe(spark, name)["location"], run, made.files.filter("staged IS NOT NULL"))
        repair(spark, name, bool(about["partition_cols"]))
        state.save(current.sparkSession, _mapped(current, made.files, run))
        return (made.wrote,)

    try:
        # Rows were checked at the wanted level before they were moved in; their number is enough here.
        frame = spark.table(table_sql(spark, source))
        _, wrote, read = publish(spark, target, None, write, frame, bool(about["partition_cols"]), "count")
    except Exception:
        remove(spark, state.folder)
        raise
    finally:
        remove(spark, area)
    return wrote, read


def _put_back(spark: SparkSession, location: str, state: State, area: str) -> DataFrame:
    """After a run that was broken off: own files that the map doesn't know go; returns what is left of the map."""
    for run in state.broken_off(spark):
        remove(spark, f"{location}/_{run}")
    listed = _listed(spark, location, area, "target")
    session = listed.sparkSession
    base = re.sub("^file:/+", "file:/", location).rstrip("/")
    present = listed.select(F.expr("path").alias("path")).withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    present = present.select(F.expr(f"substring(path, {len(base) + 2})").alias("file"))
    known = state.files(session)
    ours = present.filter(F.element_at(F.split("file", "/"), -1).rlike(_OWN))
    _delete(spark, location, ours.join(known, "file", "left_anti"))
    # A source file of which a file is missing has to be copied again.
    lost = known.filter("file IS NOT NULL").join(present, "file", "left_anti").select("path").distinct()
    return known.join(lost, "path", "left_anti")


def _update(
    spark: SparkSession,
    source: ObjectName,
    about: dict,
    fmt: str,
    target: ObjectName,
    state: State,
    current: DataFrame,
    area: str,
    level: str,
) -> tuple[int, int, str]:
    """Copy what is new, replace what was rewritten, and drop what was removed."""
    location, session = describe(spark, target)["location"].rstrip("/"), current.sparkSession
    known = state.files(session)
    if broken := state.broken_off(spark):
        kept = _put_back(spark, location, state, area)
        # The rest of a lost source file goes too, as it comes back whole.
        _delete(spark, location, known.join(kept, "path", "left_anti"))
        known = kept
    fresh = current.join(known, _VERSION, "left_anti")
    stale = known.join(current, _VERSION, "left_anti")
    some_fresh, some_stale = not fresh.isEmpty(), not stale.isEmpty()
    if not broken and not some_fresh and not some_stale:
        return 0, 0, "new files appended"
    _add_columns(spark, source, target)
    run = unique("run")
    state.begin(spark, run)
    made = None
    if some_fresh:
        try:
            made = _copied(spark, source, about, fmt, target, fresh, run, level, area)
        except Exception:
            # Nothing is visible yet, so that nothing has to be put back later.
            remove(spark, f"{location}/_{run}")
            state.end(spark, run)
            raise
        _move_in(spark, location, run, made.files.filter("staged IS NOT NULL"))
        repair(spark, target, bool(about["partition_cols"]))
    _delete(spark, location, stale)
    after = known.join(stale.select("path").distinct(), "path", "left_anti")
    if made:
        after = after.unionByName(_mapped(fresh, made.files, run))
    state.save(session, after)
    for note in {run, *broken}:
        state.end(spark, note)
    description = "changed files replaced" if some_stale else "new files appended"
    return (made.wrote, made.read, description) if made else (0, 0, description)
