"""Report documents and the report manifest read back as DataFrames (S-8, S-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrid.operators.flatten import sub

# The shape contract a per-queue report document must meet.
QUEUE_DOCUMENT_RULES = (
    ("queue_id", "string"), ("total_calls", "number"), ("daily_volume", "array"),
    ("hourly_volume", "array"), ("agent_leaderboard", "array"), ("top_callers", "array"),
)
# The shape contract of a period document.
REPORT_RULES = (
    ("period", "string"), ("date_range.start", "string"), ("date_range.end", "string"), ("queues", "object"),
    ("crossqueue.agents", "array"), ("crossqueue.callers", "array"), ("crossqueue.same_hour_no_answer", "array"),
    ("crossqueue.same_day_volume", "array"), ("anomalies", "array"), ("source_gaps", "array"), ("validation", "object"),
)
FUNNEL_LANGUAGES = ("English", "French")


def report_rules(queue_ids: Sequence[str]) -> tuple[tuple[str, str], ...]:
    """Rules of a period document over the given queues."""
    per_queue = tuple((f"queues['{q}'].{name}", kind) for q in queue_ids for name, kind in QUEUE_DOCUMENT_RULES[1:])
    per_language = tuple((f"crossqueue.funnels.{x}.{name}", "number") for x in FUNNEL_LANGUAGES
                         for name in ("routing_match", "effective_answer_rate"))
    return REPORT_RULES + per_queue + per_language


MANIFEST_FIELDS = ("key", "label", "start", "end", "path", "source")


def _kind(v) -> F.Column:
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit("missing"))
            .when(t.startswith("OBJECT"), F.lit("object")).when(t.startswith("ARRAY"), F.lit("array"))
            .when(t == "STRING", F.lit("string"))
            .when(t.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT") | t.startswith("DECIMAL"),
                  F.lit("number"))
            .when(t == "BOOLEAN", F.lit("boolean")).otherwise(F.lower(t)))


def shape_violations(docs: DataFrame, rules: Sequence[tuple[str, str]] = QUEUE_DOCUMENT_RULES,
                     id_col: str = "queue_id", doc_col: str = "document") -> DataFrame:
    """S-8: one row per (document, path) whose value is not of the required kind."""
    v = docs.select(id_col, F.parse_json(doc_col).alias("_d"))
    checks = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(k).alias("expected"), _kind(sub("_d", p)).alias("found"))
                       for p, k in rules])
    return (v.select(id_col, F.explode(checks).alias("c")).select(id_col, "c.*")
            .filter(F.col("expected") != F.col("found")))


def scan_manifest(manifest_text: DataFrame, base: str, column: str = "value") -> DataFrame:
    """S-9: entries of ``{"reports": [...]}``; every field a non-empty string (else the job
    fails), relative paths prefixed with ``base``, newest first (``rank``)."""
    entries = manifest_text.select(F.explode(F.from_json(
        column, "struct<reports: array<map<string, string>>>")["reports"]).alias("e"))
    cols = []
    for f in MANIFEST_FIELDS:
        val = F.col("e")[f]
        bad = val.isNull() | (val == "")
        cols.append(F.when(bad, F.raise_error(F.lit(f"Report manifest {f} must be a string."))).otherwise(val).alias(f))
    out = entries.select(*cols)
    out = out.withColumn("path", F.when(F.col("path").rlike(r"^(/|https?://)"), F.col("path"))
                         .otherwise(F.concat(F.lit(base.rstrip("/")), F.lit("/"), F.col("path"))))
    from pyspark.sql import Window
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("start"), F.asc("key"))))
