"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemove.llm.common import WORD, saved, text_of

WEIGHTS = (3, 1, 2)
SHARE_PCT = 150
MAX_EPOCHS = 2
SEED = "mix-1"
#: Documents of a source are dealt to this many groups by their seeded digest, so that running
#: sums are taken over the groups of a source and over the documents of a group.
GROUP_DIGITS = 3


def sizes(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size`` in words, and the seeded digest that decides the order of taking."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return documents.select(
        "doc_id",
        "source",
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), name)).alias("ticket"),
    )


def water_fill(sources: DataFrame, share_pct: int = SHARE_PCT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for rows of ``source, source_size, weight``.

    All targets together are ``share_pct`` percent of all sizes, in proportion to the weights;
    a target stops at ``max_epochs`` times its source, and what is above is shared again by
    weight among the others. The level at which this settles is found from running sums: a
    source is capped if and only if its own level ``cap / weight`` isn't above the level that
    remains for it and all sources with a higher one. One row per source is all this sees.
    """
    filled = sources.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = filled.select(
        "*",
        (
            F.lit(share_pct) * F.sum("source_size").over(everything)
            - F.lit(100) * F.coalesce(F.sum("cap").over(before), F.lit(0))
        ).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"),
    )
    capped = level.withColumn("capped", F.col("cap") * 100 * F.col("weights") <= F.col("left") * F.col("weight"))
    free = F.when(~F.col("capped"), F.struct("weights", "left"))
    # Of the sources that aren't capped, the first in the order sees all of them.
    first = capped.withColumn("water", F.max(free).over(everything))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("water.left") / (F.lit(100) * F.col("water.weights"))
    )
    return first.select("source", "source_size", "weight", target.alias("target"))


def source_targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_pct: int = SHARE_PCT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Weights go round the sources in code-point order, NULL last; then the level is found."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    place = (F.row_number().over(order) - 1) % len(weights)
    table = F.array(*[F.lit(w).cast("long") for w in weights])
    return water_fill(totals.withColumn("weight", F.element_at(table, (place + 1).cast("int"))), share_pct, max_epochs)


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_pct: int = SHARE_PCT,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per row of ``documents``: ``doc_id, source, size, source_size, target, copies, part, taken``.

    The words to take from a source are its target, rounded. Every document is repeated as
    many whole times as the target holds the source; what is left is filled with documents
    in the order of a seeded digest, each once more; of the document that would go beyond
    it, only ``part`` words are taken, so that each source meets its target to the word and no
    document is taken more than ``max_epochs`` times. NULL texts and texts without words have
    size 0 and are taken 0 words; NULL is a source of its own; repeated rows are documents of
    their own; an empty table gives no rows.
    """
    # Read the texts once; what follows needs only their sizes.
    sized = saved(sizes(documents, seed), "sizes")
    grouped = sized.withColumn("group", F.substring("ticket", 1, GROUP_DIGITS))
    targets = source_targets(sized, weights, share_pct, max_epochs)

    # Where each group starts in its source: at most 16 ** GROUP_DIGITS rows per source.
    group_totals = grouped.groupBy("source", "group").agg(F.sum("size").alias("group_size"))
    ahead = Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = group_totals.withColumn("start", F.coalesce(F.sum("group_size").over(ahead), F.lit(0)))
    wanted = F.round("target").cast("long")
    plan = (
        starts.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0))
        .withColumn("rest", wanted - F.col("whole") * F.col("source_size"))
        .select("source", "group", "start", "group_size", "source_size", "target", "whole", "rest")
    )

    inside = Window.partitionBy("source", "group").orderBy("ticket", "size")
    joined = grouped.join(
        plan.withColumnsRenamed({"source": "p_source", "group": "p_group"}),
        F.col("source").eqNullSafe(F.col("p_source")) & (F.col("group") == F.col("p_group")),
    ).drop("p_source", "p_group")
    begin = F.col("start") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    filled = joined.withColumn("begin", begin).withColumn(
        "fill", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("begin")))
    )
    full = (F.col("fill") == F.col("size")) & (F.col("size") > 0)
    return filled.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("whole") + full.cast("long")).otherwise(0).alias("copies"),
        F.when(full, F.lit(0)).otherwise(F.col("fill")).cast("long").alias("part"),
        (F.col("whole") * F.col("size") + F.col("fill")).cast("long").alias("taken"),
    )
