"""URL filters: host rules, and a tree of path templates judged by labelled purity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemove.llm.common import saved

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``rule`` is a host and a path, such as ``net/``; ``verdict`` is block or allow."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


@dataclass(frozen=True)
class Purity:
    """Parameters of the template tree.

    ``levels`` path segments are told apart in any case; below them, those of templates with labels of
    both kinds, to any depth. Numbers stay literal as rare segments do, against all of their shape. What is longer below a template without is one tail. A segment
    with at least ``min_share`` of its parent's pages stays literal below it unless its share of bad
    labels is within ``z`` standard errors of the parent's. A rarer one stays literal if
    its labels would be that far from the parent's by chance with a probability of ``risk`` at most,
    for all segments of the parent together. A template is blocked if its share of bad labels, smoothed by
    ``prior`` pages of the host's and the host's by as many of the whole table's, is above ``limit``.
    """

    levels: int = 4
    min_share: float = 0.02
    z: float = 1.96
    risk: float = 0.05
    prior: float = 5.0
    limit: float = 0.5


def parsed(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in ASCII, and path of a url; empty where there is no ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """A segment with its long hexadecimal strings and its numbers as typed wildcards."""
    hexes = F.regexp_replace(segment, "(?i)(?=[0-9a-f]*[0-9])[0-9a-f]{8,}", "{x}")
    return F.regexp_replace(hexes, "[0-9]+", "{n}")


def _told_apart(purity: Purity, among: str = "p") -> Column:
    """Whether a segment's labels differ from those it is one of: Chernoff's bound, over all segments."""
    pairs = ((f"{among}_bad", f"{among}_labelled"), ("bad", "labelled"))
    rate, own = (F.col(b) / F.greatest(F.col(n), F.lit(1)) for b, n in pairs)

    def part(share: Column, of: Column) -> Column:
        return F.when(share > 0, share * F.log(share / of)).otherwise(0.0)

    surprise = F.col("labelled") * (part(own, rate) + part(1 - own, 1 - rate))
    return (F.col("labelled") > 0) & (surprise >= F.log(2 * F.col(f"{among}_segments") / purity.risk))


def template_tree(paths: DataFrame, purity: Purity = Purity()) -> DataFrame:
    """Templates for rows of ``host, path, n, labelled, bad``, one per distinct path.

    Level by level, segments below the same host and template are counted; those that the labels
    don't tell from their parent are merged, rare ones into the wildcard ``*``, others into ``~``. Numbers in a segment
    are typed wildcards unless its labels tell it from the others of its shape.
    Below the levels that all templates have, a round goes on at the next segment in which the paths of a template differ,
    so that rounds follow branchings and not depths.
    All statistics are sums over (host, template, segment), added up before the shuffle, so that
    a hot host is never in one task; the join back has hot keys only on its large side, which
    adaptive execution splits.
    """
    pieces = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = paths.withColumn("segments", pieces).withColumn("template", F.lit("")).withColumn("level", F.lit(0))
    settled = []
    # Each round reads the one before it several times: without a cut, plans double.
    for _ in range(min(purity.levels, tree.agg(F.max(F.size("segments"))).first()[0] or 0)):
        tree = saved(_with_level(tree, purity), "url_level")
    while True:
        further = F.size("segments") > F.col("level")
        rest = F.slice("segments", F.col("level") + 1, F.greatest(F.size("segments") - F.col("level"), F.lit(0)))
        sums = [F.sum(F.when(further, F.col(c)).otherwise(0)).alias(c) for c in ("labelled", "bad")]
        nodes = tree.groupBy("host", "template").agg(
            F.count(F.when(further, 1)).alias("paths"), F.min(rest).alias("low"), F.max(rest).alias("high"), *sums
        )
        # The labels of one path can't be split, nor can those that are all alike.
        mixed = nodes.filter("paths > 1 AND bad > 0 AND bad < labelled")
        # What the smallest and the largest path share, all between them do.
        apart = F.expr("array_position(zip_with(low, high, (a, b) -> a <=> b), false)")
        shared = F.when(apart > 0, apart - 1).otherwise(F.least(F.size("low"), F.size("high"))).cast("int")
        mixed = saved(mixed.select("host", "template", shared.alias("shared")), "url_nodes")
        left = tree.join(mixed, ["host", "template"], "left_anti")
        tail = F.when(further, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
        settled.append(left.withColumn("template", tail))
        if mixed.isEmpty():
            break
        tree = tree.join(mixed, ["host", "template"])
        along = F.concat("template", F.repeat(F.lit("/~"), F.col("shared")))
        tree = tree.withColumn("template", along).withColumn("level", F.col("level") + F.col("shared")).drop("shared")
        tree = saved(_with_level(tree, purity), "url_level")
    tree = settled[0]
    for part in settled[1:]:
        tree = tree.unionByName(part)
    return tree.drop("segments", "level")


def _with_level(tree: DataFrame, purity: Purity) -> DataFrame:
    """The tree with one more segment in its templates."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]

    def summed(prefix: str) -> list[Column]:
        return [F.count("*").alias(f"{prefix}_segments"), *[F.sum(c).alias(f"{prefix}_{c}") for c in ("n", "labelled", "bad")]]

    node = ["host", "template"]
    raw = F.coalesce(F.get("segments", F.col("level")), F.lit(""))
    at = tree.withColumn("raw", raw)
    each = at.groupBy(*node, "raw").agg(*sums).withColumn("shape", _shape(F.col("raw")))
    # Without a number a segment is its shape; of one with numbers, the labels decide.
    shapes = each.filter("raw <> shape").groupBy(*node, "shape").agg(*summed("s"))
    each = each.join(shapes, [*node, "shape"], "left")
    literal = (F.col("raw") == F.col("shape")) | _told_apart(purity, "s")
    each = each.withColumn("segment", F.when(literal, F.col("raw")).otherwise(F.col("shape")))
    each = saved(each.select(*node, "raw", "segment", "n", "labelled", "bad"), "url_segments")
    child = each.groupBy(*node, "segment").agg(*sums)
    parent = child.groupBy(*node).agg(*summed("p"))
    rate = F.col("p_bad") / F.greatest(F.col("p_labelled"), F.lit(1))
    error = F.sqrt(rate * (1 - rate) / F.greatest(F.col("labelled"), F.lit(1)))
    similar = F.abs(F.col("bad") - rate * F.col("labelled")) <= purity.z * error * F.col("labelled")
    label = (
        F.when(F.col("segment") == "", "")
        .when((F.col("n") < purity.min_share * F.col("p_n")) & ~_told_apart(purity), "/*")
        .when(F.col("n") < purity.min_share * F.col("p_n"), F.concat(F.lit("/"), F.col("segment")))
        .when(similar, "/~")
        .otherwise(F.concat(F.lit("/"), F.col("segment")))
    )
    names = child.join(parent, node).select(*node, "segment", label.alias("label"))
    names = each.join(names, [*node, "segment"]).select(*node, "raw", "label")
    return (
        at.join(names, [*node, "raw"])
        .withColumn("template", F.concat("template", "label"))
        .withColumn("level", F.col("level") + 1)
        .drop("raw", "label")
    )


def judged_templates(tree: DataFrame, purity: Purity = Purity()) -> DataFrame:
    """``host, template, labelled, bad, purity`` with the smoothed share of good labels as purity."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    templates = tree.groupBy("host", "template").agg(*sums)
    hosts = templates.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("bad").alias("h_bad"))
    whole = hosts.agg(F.sum("h_bad").alias("bad"), F.sum("h_labelled").alias("labelled")).first()
    overall = (whole["bad"] or 0) / max(whole["labelled"] or 0, 1)
    host_bad = (F.col("h_bad") + purity.prior * overall) / (F.col("h_labelled") + purity.prior)
    bad = (F.col("bad") + purity.prior * host_bad) / (F.col("labelled") + purity.prior)
    return templates.join(hosts, "host").select("host", "template", "labelled", "bad", (1 - bad).alias("purity"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, purity: Purity = Purity()
) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict, template``.

    ``labels`` has ``page_id`` and ``bad`` (boolean); NULL labels count as not given, several
    of one page as so many. The verdict is that of the longest fitting rule, else block where
    the purity of the page's template is too low, else allow. NULL urls and those without
    ``://`` have an empty host and path, and share the empty template; repeated rows stay.
    """
    host, path = parsed(F.col("url"))
    given = pages.select("page_id", host.alias("host"), path.alias("path"))
    counted = (
        labels.filter(F.col("bad").isNotNull())
        .groupBy("page_id")
        .agg(F.count("*").alias("labelled"), F.sum(F.col("bad").cast("long")).alias("bad"))
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    paths = (
        given.join(counted, "page_id", "left")
        .groupBy("host", "path")
        .agg(F.count("*").alias("n"), zero("labelled"), zero("bad"))
    )
    tree = saved(template_tree(saved(paths, "url_paths"), purity), "url_templates")
    judged = judged_templates(tree, purity).select("host", "template", "purity")
    verdicts = tree.join(judged, ["host", "template"]).select(
        "host", "path", "template", F.when(F.col("purity") < 1 - purity.limit, "block").otherwise("allow").alias("own")
    )
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return given.join(verdicts, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.col("own")).alias("verdict"),
        "template",
    )
