"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.llm import bpe, convrepair, htmltext, lexical, linedup, mixing, neardup, quality, spotsigs, suffix, tokencount, toxicity, warc
from callgrid.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.allot(table(spark, sf_dir, "documents"))


ORACLE["op1_mixing"] = mixing.ORACLE


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.classes(table(spark, sf_dir, "documents"))


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier place, and the document that has them first."""
    found = suffix.passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"))


ORACLE["op4_suffix_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, md5(array_to_string(w[p + 1 : p + 50], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 49, 0))) AS p FROM d)),
r AS (SELECT doc_id, p, f FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST, p) AS k,
                                       first_value(doc_id) OVER (PARTITION BY h ORDER BY doc_id NULLS LAST, p) AS f FROM g) WHERE k > 1),
j AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS opens FROM r),
s AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM j)
SELECT doc_id, arg_min(f, p) AS first_doc_id, CAST(min(p) AS INTEGER) AS start_word, CAST(max(p) + 50 AS INTEGER) AS end_word
FROM s GROUP BY doc_id, k
"""


@_query
def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    return spotsigs.compare_edits(table(spark, sf_dir, "documents"))


ORACLE["op6_spotsigs"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM d),
e AS (SELECT doc_id, length(text) AS n, text, next,
             left(text, length(text) - length(text) // 2) || left(next, length(text) // 2) AS edited FROM n),
x AS (SELECT doc_id, 0 AS k, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e UNION ALL SELECT doc_id, 2, next FROM e),
w AS (SELECT doc_id, k, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w FROM x),
a AS (SELECT doc_id, k, w, list_filter([CASE WHEN list_contains(c, w[i]) THEN
        array_to_string(list_prepend(w[i], list_filter(w[i + 1 : i + {spotsigs.REACH}], lambda y: NOT list_contains(c, y))[1 : {spotsigs.CHAIN}]), ' ') END
        FOR i IN range(1, len(w) + 1)], lambda s: s IS NOT NULL AND contains(s, ' ')) AS s
      FROM w, (SELECT {spotsigs.COMMON} AS c)),
s AS (SELECT doc_id, k, list_sort(list_distinct(list_transform(
        CASE WHEN len(s) > 0 THEN s WHEN len(w) > 0 THEN ['all ' || array_to_string(w, ' ')] ELSE [] END,
        lambda y: left(md5(y), {spotsigs.DIGITS})))) AS s FROM a),
p AS (SELECT e.doc_id, e.n, e.edited, s0.s AS s0, s1.s AS s1, s2.s AS s2 FROM e JOIN s s0 ON s0.doc_id = e.doc_id AND s0.k = 0
      JOIN s s1 ON s1.doc_id = e.doc_id AND s1.k = 1 JOIN s s2 ON s2.doc_id = e.doc_id AND s2.k = 2)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s0, '') AS fingerprint,
       array_to_string(s1, '') AS edited_fingerprint,
       CASE WHEN len(s0) = 0 AND len(s1) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(s0, s1))::DOUBLE / (len(s0) + len(s1) - len(list_intersect(s0, s1))) END AS near_edited,
       CASE WHEN len(s0) = 0 AND len(s2) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(s0, s2))::DOUBLE / (len(s0) + len(s2) - len(list_intersect(s0, s2))) END AS near_next
FROM p
"""


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives that it was written to."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLE["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted between the separators of flat token files."""
    return tokencount.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its digest of every damaged conversation."""
    return convrepair.report(convrepair.damage(table(spark, sf_dir, "conversations")))


ORACLE["op11_conversation_repair"] = convrepair.ORACLE


@_query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and what is left without those that later documents hold too."""
    return linedup.report(table(spark, sf_dir, "documents"))


ORACLE["op12_line_dedup"] = linedup.ORACLE


@_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = lexical.ORACLE
