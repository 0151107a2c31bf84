"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid.llm import chunk_dedup, suffix_dedup
from pricegrid.llm.decontamination import leaks
from pricegrid.llm.hard_negatives import hard_negatives
from pricegrid.llm.jaccard_join import Overlap, jaccard_components
from pricegrid.llm.near_duplicates import Similarity, near_duplicates
from pricegrid.llm.packing import Tokenizer, pack_documents
from pricegrid.llm.periodic_runs import Repetition, periodic_runs
from pricegrid.llm.quality_classifier import quality_scores
from pricegrid.llm.quality_rules import Vocabulary, quality_rules
from pricegrid.llm.secret_scan import find_secrets
from pricegrid.llm.site_style import main_text
from pricegrid.llm.zip_archive import archive_round_trip

TOKENIZER = Tokenizer(
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
)

VOCABULARIES = [
    Vocabulary("piece", public_tokenizers.path("piece_bpe_32k.model"), "sentencepiece"),
    Vocabulary("byte", public_tokenizers.path("byte_bpe_50k.tiktoken"), "tiktoken"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op4_site_style_tree(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op5_chunk_dedup(spark, sf_dir):
    return chunk_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_zip_archive(spark, sf_dir):
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"), VOCABULARIES)


def op9_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), Similarity(words=3, percent=85))


def op10_decontamination(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; every tenth document by its id's CRC goes on repeating its words from some word on."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    numbered = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    numbered = numbered.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    numbered = numbered.selectExpr("*", "h div 10 as g")
    placed = numbered.selectExpr("*", "if(n > 0, g % n, null) as a")
    placed = placed.selectExpr("*", "1 + (n - a) div (3 + g % 8) as p")
    tail = "slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a))"
    return placed.selectExpr("doc_id", f"case when a is null then text else array_join(concat(slice(w, 1, int(a)), {tail}), ' ') end as text")


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(repeated_tails(table(spark, sf_dir, "documents")), Repetition(min_words=24, min_periods=3))
    # the lists are by start and period: of equal exponents the first one stays
    best = F.expr(
        "aggregate(runs, cast(null as struct<start bigint, length bigint, period bigint>), "
        "(b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95, scale=256)


def op13_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), Overlap(words=3, percent=90))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_site_style_tree": op4_site_style_tree,
    "op5_chunk_dedup": op5_chunk_dedup,
    "op6_packing": op6_packing,
    "op7_zip_archive": op7_zip_archive,
    "op8_quality_rules": op8_quality_rules,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_jaccard_join": op13_jaccard_join,
}
ORACLES: dict[str, str] = {
    "op3_suffix_dedup": r"""
        WITH raw AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), starts AS (
            SELECT doc_id, unnest(range(0, n - 399)) AS p, h FROM raw WHERE n >= 400
        ), digests AS (
            SELECT doc_id, p, md5(h[2 * p + 1 : 2 * p + 800]) AS d FROM starts
        ), again AS (
            SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY d) AS k FROM digests) WHERE k > 1
        ), marked AS (
            SELECT *, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400, true) AS opens FROM again
        ), numbered AS (
            SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
        ), spans AS (
            SELECT doc_id, span, min(p) AS b, max(p) + 400 AS e FROM numbered GROUP BY doc_id, span
        ), gaps AS (
            SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e FROM spans
            UNION ALL SELECT doc_id, max(e), NULL FROM spans GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(h[2 * b + 1 : 2 * coalesce(e, n)], '' ORDER BY b) AS h FROM gaps JOIN raw USING (doc_id) GROUP BY doc_id
        ), totals AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept.h, raw.h))) AS kept_sha256
        FROM raw LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    # the tables' pages keep their article in an element of that name, in blocks of two kinds
    "op4_site_style_tree": r"""
        WITH blocks AS (
            SELECT page_id, url, string_split_regex(
                replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' '), '</?(?:p|h1)>') AS b
            FROM pages
        ), plain AS (
            SELECT page_id, url, [trim(regexp_replace(regexp_replace(
                replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) FOR x IN b] AS b
            FROM blocks
        ), texts AS (SELECT page_id, url, array_to_string([x FOR x IN b IF x <> ''], chr(10)) AS text FROM plain)
        SELECT page_id, url, text, length(text) AS n_chars FROM texts
    """,
    "op7_zip_archive": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
        ), typed AS (
            SELECT *, payload_bytes >= 100 AND first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL AS again FROM firsts
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to
        FROM typed
    """,
    "op9_near_duplicates": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE
                WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
            FROM worded
        ), held AS (
            SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN least USING (doc_id)
    """,
    # every pair of equal words on every diagonal, and the tails made from the ids' CRC, bit by bit
    "op11_periodic_runs": r"""
        WITH ids AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   [CAST(unicode(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')] AS b FROM documents
        ), sums AS (
            SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: list_reduce(
                list_prepend(xor(c, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda d, z: xor(d >> 1, 3988292384 * (d & 1))))) AS h FROM ids
        ), placed AS (
            SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM sums
        ), texts AS (
            SELECT doc_id, n, CASE WHEN n > 0 AND h % 10 = 0
                THEN [w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] FOR i IN range(n)] ELSE w END AS w FROM placed
        ), words AS (
            SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS x FROM texts
        ), met AS (
            SELECT u.doc_id, u.i, u.i - v.i AS lag FROM words u JOIN words v ON u.doc_id = v.doc_id AND u.x = v.x AND u.i > v.i
        ), diagonals AS (
            SELECT doc_id, lag, min(i) - lag AS start, count(*) + lag AS length FROM (
                SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM met)
            GROUP BY doc_id, lag, island
        ), runs AS (
            SELECT doc_id, start, length, min(lag) AS period FROM diagonals
            WHERE length >= 24 AND length >= 3 * lag GROUP BY doc_id, start, length
        ), dropped AS (
            SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
        ), kept AS (
            SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
        ), best AS (
            SELECT * FROM (SELECT *, row_number() OVER (
                PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS k FROM runs) WHERE k = 1
        ), lines AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
            FROM runs GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
        FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN best USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
            FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT a, b AS positive_id, s AS positive_score
            FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS k FROM scores WHERE same) WHERE k <= 5
        ), negatives AS (
            SELECT p.*, n.b AS negative_id, n.s AS negative_score,
                   row_number() OVER (PARTITION BY p.a, positive_id ORDER BY n.s DESC, n.b) AS k
            FROM positives p JOIN scores n ON p.a = n.a AND NOT n.same
             AND 50 * positive_score <= 100 * n.s AND 100 * n.s <= 95 * positive_score
        )
        SELECT a AS anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM negatives WHERE k <= 3
    """,
}
# the same join at another threshold, without the decision
ORACLES["op13_jaccard_join"] = ORACLES["op9_near_duplicates"].replace(">= 85 *", ">= 90 *").replace(", doc_id = component_id AS kept", "")
