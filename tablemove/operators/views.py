"""Syncing views between catalogs: rewriting, comparing and creating them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.functions.names import (
    ObjectName,
    is_registered,
    require,
    table_sql,
)
from tablemove.functions.viewtext import mentions, rewrite
from tablemove.operators.drift import CREATE, IN_SYNC, ORPHAN, REPLACE
from tablemove.operators.outcome import Outcome, attempt
from tablemove.plans.report import run_batch, write_report
from tablemove.sources.inventory import filter_kind

_UNQUALIFIED = "the rewritten text still names the source catalog"


def rewritten(text: Column, source_catalog: str, target_catalog: str, folded: bool = False) -> Column:
    """View text for the target catalog; folded names are rewritten as well."""
    result = rewrite(text, source_catalog, target_catalog)
    return rewrite(result, source_catalog, target_catalog, folded=True) if folded else result


def classify(
    source: DataFrame,
    target: DataFrame,
    source_catalog: str,
    target_catalog: str,
    folded: bool = False,
    target_schema: str = "",
) -> DataFrame:
    """Action per view of two inventories: CREATE, REPLACE, IN_SYNC or ORPHAN.

    Views are matched in ``target_schema``, or in the schema of the source. Adds ``view_text``,
    the text the target should have, ``view_namespace``, where unqualified names in it are
    looked up, and ``still_names``, whether it goes on naming the source catalog.
    """

    def moved(column: str) -> Column:
        return rewritten(F.col(column), source_catalog, target_catalog, folded).alias(column)

    wanted = filter_kind(source, "view").select(
        F.lower("schema").alias("__schema"),
        (F.lower(F.lit(target_schema)) if target_schema else F.lower("schema")).alias("schema"),
        F.lower("name").alias("name"),
        moved("view_text"),
        moved("view_namespace"),
        F.lit(True).alias("__wanted"),
    )
    present = filter_kind(target, "view").select(
        F.lower("schema").alias("schema"),
        F.lower("name").alias("name"),
        F.col("view_text").alias("__current"),
        F.lit(True).alias("__present"),
    )
    joined = wanted.join(present, ["schema", "name"], "full_outer")
    naming = mentions(F.col("view_text"), source_catalog)
    if folded:
        naming = naming | mentions(F.col("view_text"), source_catalog, folded=True)
    return joined.select(
        F.coalesce("__schema", "schema").alias("schema"),
        "name",
        "view_text",
        "view_namespace",
        F.when(F.col("__wanted").isNull(), ORPHAN)
        .when(F.col("__present").isNull(), CREATE)
        .when(F.col("view_text").eqNullSafe(F.col("__current")), IN_SYNC)
        .otherwise(REPLACE)
        .alias("action"),
        (naming & F.lit(source_catalog != target_catalog)).alias("still_names"),
    )


def create_view(spark: SparkSession, name: str | ObjectName, text: str) -> str:
    """Create or replace a view; returns the statement."""
    require(text=text)
    statement = f"CREATE OR REPLACE VIEW {table_sql(spark, name)} AS {text}"
    spark.sql(statement)
    return statement


def apply(
    spark: SparkSession,
    source: ObjectName,
    target: ObjectName,
    action: str,
    text: str,
    namespace: str | None = None,
    still_names: bool = False,
) -> Outcome:
    """Bring one classified view about.

    The view is created in a session of its own whose current schema is ``namespace``,
    so unqualified names never meet the caller's schema or temporary views.
    """

    def work(outcome: Outcome) -> None:
        outcome.source_object_type, outcome.action = "VIEW", action
        if action == IN_SYNC:
            outcome.description = "views have the same definition"
            return
        if still_names:
            raise ValueError(f"{_UNQUALIFIED} {source.catalog}")
        session = spark.newSession()
        if namespace:
            session.sql(f"USE {namespace}")
        outcome.statement = create_view(session, target, text)
        spark.sql(f"REFRESH TABLE {table_sql(spark, target)}")
        outcome.description = "view created" if action == CREATE else "view replaced, texts differed"

    return attempt("view_sync", source, target, work)


def references(plan: DataFrame) -> DataFrame:
    """Which views of a plan name which others: ``schema, name, uses``.

    Words of a text that are names of other views; a word may mean something else, so
    this orders the work and decides nothing.
    """
    words = plan.select(
        "schema",
        "name",
        F.explode(
            F.array_distinct(F.regexp_extract_all(F.lower("view_text"), F.lit(r"(\w+)"), F.lit(1)))
        ).alias("uses"),
    )
    names = plan.select(F.col("name").alias("uses")).distinct()
    return words.join(names, "uses", "left_semi").filter(F.col("uses") != F.col("name"))


def sync_all(
    spark: SparkSession,
    source: DataFrame,
    target: DataFrame,
    source_catalog: str,
    target_catalog: str,
    target_schema: str = "",
    on_error: str = "continue",
    report_table: str | None = None,
) -> list[Outcome]:
    """Sync all views of an inventory, views that others read first.

    A pass takes the views that name no other view still to do, or all of them if
    there are none such; failed ones are tried again as long as a pass gets further.
    What still fails then is reported, with ``on_error='stop'`` the first such view only.
    The views of a pass are created from a thread pool, and reported after it.
    """
    if on_error not in ("stop", "continue"):
        raise ValueError("on_error is 'stop' or 'continue'")
    folded = not is_registered(spark, source_catalog)
    plan = classify(source, target, source_catalog, target_catalog, folded, target_schema)
    plan = plan.filter(F.col("action") != ORPHAN)
    uses: dict[tuple[str, str], set[str]] = {}
    for row in references(plan.filter(F.col("action") != IN_SYNC)).toLocalIterator():
        uses.setdefault((row["schema"], row["name"]), set()).add(row["uses"])
    todo = {
        (row["schema"], row["name"]): (
            ObjectName(source_catalog, row["schema"], row["name"]),
            ObjectName(target_catalog, target_schema or row["schema"], row["name"]),
            row["action"],
            # The text of a view that stays isn't needed.
            row["view_text"],
            row["view_namespace"],
            bool(row["still_names"]),
        )
        for row in plan.withColumn("view_text", F.when(F.col("action") != IN_SYNC, F.col("view_text")))
        .orderBy("schema", "name")
        .toLocalIterator()
    }
    done: list[Outcome] = []

    def report(outcomes: list[Outcome]) -> None:
        done.extend(outcomes)
        if report_table and outcomes:
            write_report(spark, outcomes, report_table)

    while todo:
        waiting = {name for _, name in todo}
        ready = [key for key in todo if not uses.get(key, set()) & waiting] or list(todo)
        steps = (lambda key=key: apply(spark, *todo[key]) for key in ready)
        tried = dict(zip(ready, run_batch(spark, steps, "continue"), strict=True))
        succeeded = [key for key, outcome in tried.items() if not outcome.failed]
        if not succeeded and len(ready) == len(todo):
            failed = list(tried.values())
            report(failed[:1] if on_error == "stop" else failed)
            return done
        if not succeeded:
            # Names were misread or a view is broken: from here on try all that is left.
            uses.clear()
        report([tried[key] for key in succeeded])
        todo = {key: view for key, view in todo.items() if key not in succeeded}
    return done
