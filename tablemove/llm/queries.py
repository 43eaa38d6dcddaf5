"""The registered queries of the operators in this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablemove.llm import (
    chat,
    contamination,
    credentials,
    documents_near,
    lines,
    merkle,
    mixing,
    prefixes,
    quality,
    repeats,
    tokens,
    urls,
    warc,
)
from tablemove.llm.common import table
from tablemove.sources.workspace import new_area

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the equivalent SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query()
def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    size = F.octet_length(F.coalesce("row.text", F.lit(""))).cast("long")
    return found.select(
        "row.doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is kept, with U+FFFD where a removed run has cut a character.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query()
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_near.duplicate_classes(table(spark, sf_dir, "documents"))


@query()
def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return urls.filter_urls(table(spark, sf_dir, "pages"), labels)


@query()
def op4_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "at", "windows", "of_windows", "same_values")


_SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, {_SQL_WORDS} AS w FROM documents
    ), m AS (
        SELECT doc_id, len(w) AS n_words,
               coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l,
               list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g,
               len(list_filter(w, lambda x: strlen(x) > 100)) AS n_long
        FROM d
    ), r AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
              FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w3) AS c
                    FROM (SELECT doc_id, unnest(g) AS w3, generate_subscripts(g, 1) AS i FROM m))
              WHERE c > 1)
        GROUP BY doc_id
    ), v AS (
        SELECT m.doc_id, n_words, word_chars, n_symbols, len(l) AS n_lines, n_long,
               len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM m LEFT JOIN r USING (doc_id)
    ), b AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM v
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines
                OR word_chars > 15 * n_words OR word_chars < 2 * n_words OR 100 * n_long > 5 * n_words) AS kept,
           (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END)
           + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
           + (CASE WHEN word_chars > 15 * n_words OR word_chars < 2 * n_words THEN 16 ELSE 0 END)
           + (CASE WHEN 100 * n_long > 5 * n_words THEN 32 ELSE 0 END)
           + (CASE WHEN n_lines <= 1 AND n_words > 2000 THEN 64 ELSE 0 END) AS failures
    FROM b
    """
)
def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base = quality.Policy("base", quality.BASE_RULES)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.accepts(base)).alias("base_failed"),
        quality.accepts(quality.CURRENT).alias("kept"),
        "failures",
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.load())


@query(
    """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
    ), d AS (
        SELECT h, min(page_id) AS first,
               string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1), '' ORDER BY j, s DESC)
                   AS digest
        FROM (SELECT h, min(page_id) AS page_id, j, s, ('0x' || substr(h, 5 * j::INT + 1, 5))::BIGINT AS v
              FROM p, (SELECT unnest(range(8)) AS j), (SELECT unnest([15, 10, 5, 0]) AS s)
              GROUP BY h, j, s)
        GROUP BY h
    )
    SELECT page_id, payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to, true AS verified
    FROM p JOIN d USING (h)
    """
)
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_area(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


@query()
def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query(
    rf"""
    WITH sized AS (
        SELECT doc_id, source, len({_SQL_WORDS}) AS size, md5('mix-1:' || doc_id) AS ticket FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
        FROM sized GROUP BY source
    ), o AS (
        SELECT *, 150 * sum(source_size) OVER () - 100 * coalesce(sum(2 * source_size) OVER b, 0) AS rest,
               sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weights
        FROM s WINDOW b AS (ORDER BY 2 * source_size / weight, source
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), c AS (
        SELECT *, 200 * source_size * weights <= rest * weight AS capped FROM o
    ), t AS (
        SELECT source, source_size,
               CASE WHEN capped THEN (2 * source_size)::DOUBLE
                    ELSE (weight * (SELECT arg_max(rest, weights) FROM c WHERE NOT capped))::BIGINT::DOUBLE
                         / (100 * (SELECT max(weights) FROM c WHERE NOT capped))::BIGINT::DOUBLE END AS target
        FROM c
    ), w AS (
        SELECT sized.*, source_size, target, round(target)::BIGINT // greatest(source_size, 1) AS whole,
               round(target)::BIGINT - round(target)::BIGINT // greatest(source_size, 1) * source_size AS rest,
               sum(size) OVER (PARTITION BY sized.source ORDER BY ticket, size ROWS UNBOUNDED PRECEDING) - size AS start
        FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
    ), f AS (
        SELECT *, greatest(0, least(size, rest - start))::BIGINT AS fill FROM w
    )
    SELECT doc_id, size, source_size, target, (whole * size + fill)::BIGINT AS taken,
           CASE WHEN size = 0 THEN 0 ELSE whole + (fill = size)::BIGINT END AS copies
    FROM f
    """
)
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


_CONTROLS = r"s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|BODY\]|/ROLE\]"


@query(
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), e AS (
        SELECT *, CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
                       ELSE 19 + length(role) END
               + length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:{_CONTROLS})')) AS chars,
               coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), 'start') AS before,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after
        FROM c
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
               AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars,
           bool_and(before || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant',
                                              'assistant>user')
                    AND (after IS NOT NULL OR role = 'assistant')) AS valid
    FROM e GROUP BY conv_id
    """
)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], given.schema)
    return chat.digest_chats(chat.format_chats(given.unionByName(own)))


def _sql_crc32(text: str) -> str:
    """CRC-32 of a short ASCII text in SQL, bit by bit."""
    bits = (
        f"flatten(list_transform(string_split({text}, ''), "
        "lambda c: list_transform(range(8), lambda b: ((ascii(c) >> b::INT) & 1)::BIGINT)))"
    )
    step = "(c >> 1) ^ (((c ^ b) & 1) * 3988292384)"
    return f"xor(list_reduce({bits}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)".replace(
        step, "xor(c >> 1, (xor(c, b) & 1) * 3988292384)"
    )


@query(
    rf"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h
        FROM conversations WHERE conv_id IS NOT NULL
    ), o AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, h) AS p FROM t
    ), c AS (
        SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {_sql_crc32("conv_id::VARCHAR")} % 9 AS taken FROM o
    ), r AS (
        SELECT c.conv_id, 0 AS part, p, h, text FROM c JOIN o ON o.conv_id = c.base AND p <= taken
        UNION ALL
        SELECT c.conv_id, 1 AS part, p, h, text FROM c JOIN o ON o.conv_id = c.conv_id AND p > taken
    ), k AS (
        SELECT conv_id, strlen(text) AS bytes, row_number() OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS n,
               string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key
        FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
        UNION ALL
        SELECT conv_id, 0, 0, (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id), '' FROM c
    ), g AS (
        SELECT key, depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
               left(key, greatest(64 * (depth - 1), 0)) AS parent,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256
        FROM k GROUP BY key, depth
    ), f AS (
        SELECT parent, count(*) AS n FROM g WHERE depth > 0 GROUP BY parent
    ), b AS (
        SELECT left(key, 64 * unnest(range(depth + 1))::INT) AS key, (f.n IS NULL)::INT AS leaf, (n_convs - 1) * bytes AS saved
        FROM g LEFT JOIN f ON f.parent = g.key
    ), s AS (
        SELECT key, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM b GROUP BY key
    )
    SELECT g.conv_id, g.depth, CASE WHEN g.depth > 0 THEN u.conv_id END AS parent_conv_id, g.n_convs,
           coalesce(f.n, 0) AS n_children, n_leaves, saved_tokens, g.ends_sha256
    FROM g JOIN s USING (key) LEFT JOIN f ON f.parent = g.key JOIN g u ON u.key = g.parent
    """
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.turns_of(table(spark, sf_dir, "conversations"))
    return prefixes.trie(prefixes.branched(turns)).expanded()


def _sql_field(column: str) -> str:
    value = f"({column})::VARCHAR"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def _sql_merkle(depth: int = 8) -> str:
    """The tree level by level, for up to 16 to the power ``depth`` rows in a source, and as many sources."""
    fields = [_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaves = [f"sha256({' || '.join([*fields, _sql_field(t)])})" for t in ("text", "low")]
    parts = [
        f"""
    WITH t AS (
        SELECT *, CASE WHEN {_sql_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {lowered} ELSE text END AS low
        FROM documents
    ), l AS (
        SELECT doc_id, source AS g, {leaves[0]} AS leaf, {leaves[1]} AS now FROM t
    ), a0 AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l
    ), n0 AS (
        SELECT g, i, leaf AS d, count(*) OVER (PARTITION BY g) AS n FROM a0
    ), f0 AS (
        SELECT doc_id, g, leaf, now, '' AS proof, i FROM a0
    )"""
    ]

    def level(k: int, nodes: str, folds: str) -> list[str]:
        up = f"""{nodes}{k + 1} AS (
        SELECT g, i // 16 AS i, any_value((n + 15) // 16) AS n,
               CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
        FROM {nodes}{k} GROUP BY g, i // 16
    )"""
        runs = f"""r_{nodes}{k} AS (
        SELECT g, i, string_agg(d, '' ORDER BY i) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
               string_agg(d, '' ORDER BY i) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
        FROM {nodes}{k} WHERE n > 1 WINDOW w AS (PARTITION BY g, i // 16 ORDER BY i)
    )"""
        fold = f"""{folds}{k + 1} AS (
        SELECT f.* REPLACE (
            CASE WHEN r.i IS NULL THEN now ELSE sha256(coalesce(before, '') || now || coalesce(after, '')) END AS now,
            proof || coalesce(before, '') || coalesce(after, '') AS proof, f.i // 16 AS i)
        FROM {folds}{k} f LEFT JOIN r_{nodes}{k} r ON f.g IS NOT DISTINCT FROM r.g AND f.i = r.i
    )"""
        return [up, runs, fold]

    for k in range(depth):
        parts += level(k, "n", "f")
    parts.append(
        f"""s AS (
        SELECT g AS source, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM n{depth}
    ), m0 AS (
        SELECT 0 AS g, i, d, count(*) OVER () AS n FROM s
    ), h0 AS (
        SELECT f.doc_id, 0 AS g, s.d AS subroot, leaf, now, proof, s.i
        FROM f{depth} f JOIN s ON f.g IS NOT DISTINCT FROM s.source
    )"""
    )
    for k in range(depth):
        parts += level(k, "m", "h")
    return (
        ", ".join(parts)
        + f"""
    SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = d AS verified
    FROM h{depth}, m{depth}
    """
    )


@query(_sql_merkle())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return merkle.manifest(documents, merkle.every_fifth_lowered()).folded()


@query()
def op13_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = credentials.scan(documents, credentials.train(documents))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    return found.select(
        "row.doc_id",
        *[F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in credentials.KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*credentials.KINDS))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
