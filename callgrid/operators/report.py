"""Report-level operators: period summary (A-19), run row (A-22), period resolution and
labels (F-21, F-22, F-25), threshold status (F-23), weekday occurrences (F-24), the
comparative series table (SNK-9), the long-format export (U-3), the manifest merge
(SNK-3) and the per-queue report documents (SNK-2).

Everything stays a DataFrame. Documents are assembled per queue from metric tables
whose size is bounded by the period (days, hours, weekdays), the agent roster or a
top-k; the unbounded caller pivot stays a table and is never folded into one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.functions.exprs import json_number, safe_ratio

# Threshold rules (direction, good, watch) of the three status metrics.
THRESHOLDS = {
    "reached_an_agent": ("higher-is-better", 0.9, 0.8),
    "missed_call_rate": ("lower-is-better", 0.05, 0.1),
    "right_language_routing": ("higher-is-better", 0.95, 0.85),
}
# Display labels of anomaly kinds (others are title-cased).
ANOMALY_KIND_LABELS = {
    "volume_spike": "Volume spike",
    "volume_drop": "Volume drop",
    "cross_queue_caller": "Caller hit multiple queues",
    "no_agent_outlier": "Unusual missed-call rate",
    "routing_mismatch": "Wrong-language routing",
}
EXPORT_COLUMNS = ("period", "date_start", "date_end", "section", "queue_id", "queue_name", "language", "role",
                  "entity_type", "entity", "date", "hour", "dow", "metric", "value", "details")


# --- periods and labels ------------------------------------------------------------------

def previous_month(today: Column) -> tuple[Column, Column]:
    """F-21: the calendar month before ``today`` (a DATE already in the reporting zone)."""
    start = F.trunc(F.add_months(today, -1), "MM")
    return start, F.last_day(start)


def month_label(start: Column) -> Column:
    """F-22: "April 2026"."""
    return F.date_format(start, "MMMM yyyy")


def period_key(start: Column) -> Column:
    return F.substring(F.date_format(start, "yyyy-MM-dd"), 1, 7)


def hour_label(hour: Column) -> Column:
    """F-25: ``HH:00``; "n/a" when missing."""
    return F.coalesce(F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00")), F.lit("n/a"))


def duration_label(seconds: Column) -> Column:
    """F-25: ``Xs`` under a minute, else ``Xm YYs`` (rounded seconds); "n/a" when missing."""
    total = F.round(seconds).cast("bigint")
    m, s = F.floor(total / 60).cast("bigint"), total % 60
    return F.coalesce(F.when(m <= 0, F.concat(s.cast("string"), F.lit("s")))
                      .otherwise(F.concat(m.cast("string"), F.lit("m "), F.lpad(s.cast("string"), 2, "0"),
                                          F.lit("s"))), F.lit("n/a"))


def integer_label(value: Column) -> Column:
    """F-25: thousands grouping; "0" when missing."""
    return F.coalesce(F.format_number(value.cast("bigint"), 0), F.lit("0"))


def decimal_label(value: Column, digits: int = 1) -> Column:
    """F-25: fixed digits with thousands grouping, halves rounded up; "0.0" when missing."""
    return F.coalesce(F.format_number(F.round(value, digits), digits), F.lit("0.0"))


def short_date_label(date: Column) -> Column:
    """F-25: "Jan 5"."""
    return F.date_format(date, "MMM d")


def title_case(text: Column) -> Column:
    """F-25: underscores to spaces, each word's first letter in upper case, the rest as it is."""
    words = F.split(F.replace(text, F.lit("_"), F.lit(" ")), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1 << 30))), " ")


def percent_label(rate: Column, digits: int = 1) -> Column:
    """F-25: ``12.3%`` with thousands grouping; "0.0%" when missing."""
    return F.concat(F.format_number(F.coalesce(rate, F.lit(0.0)) * 100, digits), F.lit("%"))


def phone_label(value: Column) -> Column:
    """F-25: ``+1 (AAA) BBB-CCCC`` for 10 digits or 11 digits starting with 1, else unchanged."""
    d = F.regexp_replace(value, r"[^0-9]", "")
    ten = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).when(F.length(d) == 10, d)
    return F.when(ten.isNotNull(), F.concat(F.lit("+1 ("), F.substring(ten, 1, 3), F.lit(") "),
                                            F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4))
                  ).otherwise(value)


def anomaly_kind_label(kind: Column) -> Column:
    """F-25: fixed label, else the kind title-cased."""
    labels = F.create_map(*[x for k, v in ANOMALY_KIND_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(labels, kind), title_case(kind))


def threshold_status(metric_id: Column, value: Column) -> Column:
    """F-23: good / watch / at-risk with inclusive bounds; unknown metric -> null."""
    out = None
    for mid, (direction, good, watch) in THRESHOLDS.items():
        if direction == "higher-is-better":
            st = F.when(value >= good, "good").when(value >= watch, "watch").otherwise("at-risk")
        else:
            st = F.when(value <= good, "good").when(value <= watch, "watch").otherwise("at-risk")
        out = F.when(metric_id == mid, st) if out is None else out.when(metric_id == mid, st)
    return out


def weekday_occurrences(spark: SparkSession, start: str, end: str) -> DataFrame:
    """F-24: how often each weekday occurs in [start, end] (at most 7 rows)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return days.groupBy(F.date_format("d", "EEEE").alias("dow")).agg(F.count(F.lit(1)).alias("occurrences"))


def dow_average(dow: DataFrame, spark: SparkSession, start: str, end: str) -> DataFrame:
    """F-24: weekday calls and the average per occurrence of that weekday in the period."""
    occ = weekday_occurrences(spark, start, end)
    return (dow.join(F.broadcast(occ), "dow", "left")
            .select("queue_id", "dow", "calls", F.coalesce("occurrences", F.lit(0)).alias("occurrences"),
                    F.when(F.col("occurrences") > 0, F.col("calls") / F.col("occurrences"))
                    .alias("avg_calls_per_occurrence")))


# --- summaries ---------------------------------------------------------------------------

def period_summary(headline: DataFrame, funnel: DataFrame, anomalies: DataFrame, gaps: DataFrame,
                   start: str) -> DataFrame:
    """A-19: one row; the four inputs are aggregated to one row each and stacked, so no
    join between them is needed."""
    parts = (headline.agg(F.sum("total_calls").alias("total_calls"))
             .unionByName(funnel.agg(F.sum("primary_calls").alias("_p"),
                                     F.sum(F.col("primary_answered") + F.col("overflow_answered")).alias("_a")),
                          allowMissingColumns=True)
             .unionByName(anomalies.agg(F.count(F.lit(1)).alias("anomaly_count")), allowMissingColumns=True)
             .unionByName(gaps.agg(F.count(F.lit(1)).alias("source_gap_count")), allowMissingColumns=True))
    one = parts.agg(*[F.max(c).alias(c) for c in ("total_calls", "_p", "_a", "anomaly_count", "source_gap_count")])
    return one.select(
        month_label(F.lit(start).cast("date")).alias("period_label"),
        F.coalesce("total_calls", F.lit(0)).cast("bigint").alias("total_calls"),
        safe_ratio("_a", "_p").alias("reached_rate"),
        F.coalesce("anomaly_count", F.lit(0)).cast("bigint").alias("anomaly_count"),
        F.coalesce("source_gap_count", F.lit(0)).cast("bigint").alias("source_gap_count"))


def run_row(start: str, end: str, source_mode: str, status: Column, validation_json: Column,
            spark: SparkSession) -> DataFrame:
    """A-22: the run row of a period (written last: it is the publish point)."""
    return spark.range(1).select(
        F.lit(start).cast("date").alias("period_start"), F.lit(end).cast("date").alias("period_end"),
        F.lit(source_mode).alias("source_mode"), status.alias("status"), validation_json.alias("validation_json"),
        F.localtimestamp().alias("generated_at"))


def threshold_rows(funnel: DataFrame, headline: DataFrame, summary: DataFrame) -> DataFrame:
    """F-23 applied where the report shows a status: language reach and routing, queue
    missed-call rate, period reach."""
    lang = funnel.select(F.lit("language").alias("scope"), F.col("language").alias("entity"),
                         F.stack(F.lit(2), F.lit("reached_an_agent"), F.col("effective_answer_rate"),
                                 F.lit("right_language_routing"), F.col("routing_match")).alias("metric_id", "value"))
    queue = headline.select(F.lit("queue").alias("scope"), F.col("queue_id").alias("entity"),
                            F.lit("missed_call_rate").alias("metric_id"), F.col("no_agent_rate").alias("value"))
    period = summary.select(F.lit("period").alias("scope"), F.col("period_label").alias("entity"),
                            F.lit("reached_an_agent").alias("metric_id"), F.col("reached_rate").alias("value"))
    out = lang.unionByName(queue).unionByName(period)
    return out.withColumn("status", threshold_status(F.col("metric_id"), F.col("value")))


def comparative_series(same_hour: DataFrame, same_day: DataFrame) -> DataFrame:
    """SNK-9: the two cross-queue series in one table, bucket = hour or date as text."""
    h = same_hour.select(F.lit("same_hour_no_answer").alias("series_name"), "queue_id",
                         F.col("hour").cast("string").alias("bucket"), "calls", "no_answer_count", "no_answer_rate")
    d = same_day.select(F.lit("same_day_volume").alias("series_name"), "queue_id",
                        F.date_format("date", "yyyy-MM-dd").alias("bucket"), "calls",
                        F.lit(None).cast("bigint").alias("no_answer_count"),
                        F.lit(None).cast("double").alias("no_answer_rate"))
    return h.unionByName(d)


# --- long-format export (U-3) -----------------------------------------------------------

def _long(df: DataFrame, section: str, entity_type: str | Column, metrics: Sequence[str], *,
          queue: str | None = "queue_id",
          entity: Column | None = None, date: Column | None = None, hour: Column | None = None,
          dow: Column | None = None, details: Column | None = None, text_metrics: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``metrics`` of one grain into export rows; ``value`` is a VARIANT of each metric's own type."""
    e = F.lit("")
    base = df.select(
        (F.col(queue) if queue else F.lit(None).cast("string")).alias("queue_id"),
        F.lit(section).alias("section"),
        (F.lit(entity_type) if isinstance(entity_type, str) else entity_type).alias("entity_type"),
        (entity if entity is not None else e).alias("entity"),
        (date if date is not None else e).alias("date"),
        (hour if hour is not None else e).alias("hour"),
        (dow if dow is not None else e).alias("dow"),
        (details if details is not None else e).alias("details"),
        *[(F.col(m).cast("string") if m in text_metrics else json_number(F.col(m))).cast("variant").alias(m) for m in metrics])
    stacked = F.stack(F.lit(len(metrics)), *[x for m in metrics for x in (F.lit(m), F.col(m))])
    return base.select("queue_id", "section", "entity_type", "entity", "date", "hour", "dow", "details",
                       stacked.alias("metric", "value"))


def long_export(tables: dict[str, DataFrame], dim: DataFrame, period: str, start: str, end: str,
                generated_at: str | None = None) -> DataFrame:
    """U-3: one row per (section, entity, metric) over the report's tables.

    ``tables`` holds headline, busiest, daily, weekly, hourly, dow_avg, reasons, leaderboard,
    top_callers, funnel, agents, callers (long: caller, queue_id, calls), same_hour, same_day,
    anomalies and gaps.
    """
    t = tables
    d = F.date_format("date", "yyyy-MM-dd")
    hl = F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00"))
    parts = [
        _long(t["headline"], "queue_summary", "queue",
              ["total_calls", "handled_calls", "answer_rate", "no_agent_calls", "no_agent_rate", "days_with_calls",
               "avg_calls_per_active_day"]),
        _long(t["busiest"], "queue_summary", "queue", ["busiest_day_calls"],
              date=F.date_format("busiest_date", "yyyy-MM-dd")),
        _long(t["busiest"], "queue_summary", "queue", ["quietest_day_calls"],
              date=F.date_format("quietest_date", "yyyy-MM-dd")),
        _long(t["daily"], "queue_daily_volume", "date", ["calls"], entity=d, date=d),
        _long(t["weekly"], "queue_weekly_volume", "week", ["calls"],
              entity=F.concat(F.date_format("week_start", "yyyy-MM-dd"), F.lit(" to "),
                              F.date_format("week_end", "yyyy-MM-dd"))),
        _long(t["hourly"], "queue_hourly_volume", "hour", ["calls", "no_answer_count", "no_answer_rate", "avg_agent_sec"],
              entity=hl, hour=F.col("hour").cast("string")),
        _long(t["dow_avg"], "queue_dow_volume", "day_of_week", ["calls", "avg_calls_per_occurrence"],
              entity=F.col("dow"), dow=F.col("dow")),
        _long(t["reasons"].filter("reason_type = 'queue'"), "queue_release_reasons", "queue_reason", ["calls"],
              entity=F.col("reason")),
        _long(t["reasons"].filter("reason_type = 'agent'"), "agent_release_reasons", "agent_reason", ["calls"],
              entity=F.col("reason")),
        _long(t["leaderboard"], "queue_agent_leaderboard", "agent",
              ["calls", "avg_sec", "median_sec", "total_sec", "pct_of_answered"], entity=F.col("agent_name")),
        _long(t["top_callers"], "queue_top_callers", "caller", ["calls"], entity=F.col("caller_number_norm")),
        _long(t["funnel"], "crossqueue_funnel", "language",
              ["primary_calls", "primary_answered", "primary_failed", "primary_no_agent_calls", "primary_no_agent_rate",
               "overflow_received", "routing_match", "overflow_answered", "overflow_failed", "lost", "lost_rate",
               "effective_answer_rate", "unaccounted", "final_dropped_available", "final_dropped_calls",
               "drop_definition"],
              queue=None, entity=F.col("language"), text_metrics=("final_dropped_available", "drop_definition")),
        _long(t["agents"], "crossqueue_agents", "agent", ["total_calls"], queue=None, entity=F.col("agent_name")),
        _long(t["agents_long"], "crossqueue_agents", "agent", ["queue_calls"], entity=F.col("agent_name")),
        _long(t["callers"], "crossqueue_callers", "caller", ["total_calls"], queue=None,
              entity=F.col("caller_number_norm")),
        _long(t["callers_long"], "crossqueue_callers", "caller", ["queue_calls"], entity=F.col("caller_number_norm")),
        _long(t["same_hour"], "crossqueue_same_hour_no_answer", "hour", ["calls", "no_answer_count", "no_answer_rate"],
              entity=hl, hour=F.col("hour").cast("string")),
        _long(t["same_day"], "crossqueue_same_day_volume", "date", ["calls"], entity=d, date=d),
        _long(t["anomalies"].withColumn("severity_text", F.col("severity")), "anomalies", F.col("kind"),
              ["severity_text"], entity=F.col("target_json"), details=F.col("description"),
              text_metrics=("severity_text",)),
        _long(t["gaps"].withColumn("message_text", F.col("message")), "source_gaps", "source_gap", ["message_text"],
              text_metrics=("message_text",)),
    ]
    if generated_at is not None:  # report_metadata: when the run produced the report
        meta = t["headline"].sparkSession.range(1).select(F.lit(None).cast("string").alias("queue_id"),
                                                           F.lit(generated_at).alias("generated_at"))
        parts.append(_long(meta, "report_metadata", "report", ["generated_at"], text_metrics=("generated_at",)))
    if "qv" in t:  # CSV runs: cleaning counts in the queue summary and the validation block
        qv = t["qv"].withColumn("reconciled_text", F.col("answered_no_agent_reconciled").cast("string"))
        parts.append(_long(qv, "queue_summary", "queue", ["raw_rows", "cleaned_calls", "duplicate_rows_removed"]))
        parts.append(_long(qv.withColumn("answered_no_agent_reconciled", F.col("reconciled_text")), "queue_summary",
                           "queue", ["answered_no_agent_reconciled", "dedupe_key", "calculation_source"],
                           text_metrics=("answered_no_agent_reconciled", "dedupe_key", "calculation_source")))
        parts.append(_long(qv, "report_validation", "queue_validation",
                           ["raw_rows", "cleaned_calls", "duplicate_rows_removed", "answered_calls", "no_agent_calls",
                            "answered_plus_no_agent"]))
        parts.append(_long(qv.withColumn("answered_no_agent_reconciled", F.col("reconciled_text")),
                           "report_validation", "queue_validation",
                           ["answered_no_agent_reconciled", "dedupe_key", "calculation_source"],
                           text_metrics=("answered_no_agent_reconciled", "dedupe_key", "calculation_source")))
    if "rv" in t:
        rv = t["rv"].withColumns({
            "answered_plus_no_agent_reconciles": F.col("answered_plus_no_agent_reconciles").cast("string"),
            "queues_included": F.to_json(F.split("queues_included", ","))})
        parts.append(_long(rv, "report_validation", "validation",
                           ["raw_row_count", "cleaned_row_count", "duplicate_rows_removed", "answered_count",
                            "no_agent_count", "answered_plus_no_agent"], queue=None))
        texts = ["status", "answered_plus_no_agent_reconciles", "date_range_used", "timezone_used", "queues_included",
                 "dedupe_key_used", "calculation_source_used"]
        parts.append(_long(rv, "report_validation", "validation", texts, queue=None, text_metrics=tuple(texts)))
    if "stats_diagnostics" in t:  # API runs: source statistics next to the cleaned metrics
        sd = t["stats_diagnostics"]
        parts.append(_long(sd, "api_queue_stats_diagnostic", "queue",
                           ["calls_offered", "calls_forwarded", "abandoned_calls", "calls_handled", "call_volume",
                            "derived_no_agent_calls", "derived_handled_calls"]))
        parts.append(_long(sd, "api_queue_stats_diagnostic", "queue", ["note"], text_metrics=("note",)))
    if "stats_funnel" in t:
        sf = t["stats_funnel"].withColumn("final_dropped_available", F.col("final_dropped_available").cast("string"))
        parts.append(_long(sf, "api_stats_funnel_diagnostic", "language",
                           ["primary_calls", "primary_answered", "primary_failed", "primary_no_agent_calls",
                            "primary_no_agent_rate", "overflow_received", "routing_match", "overflow_answered",
                            "overflow_failed", "lost", "lost_rate", "effective_answer_rate", "unaccounted",
                            "final_dropped_calls", "final_dropped_available", "drop_definition"],
                           queue=None, entity=F.col("language"),
                           text_metrics=("final_dropped_available", "drop_definition")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.withColumn("metric", F.when(F.col("metric") == "severity_text", F.lit("severity"))
                           .when(F.col("metric") == "message_text", F.lit("message")).otherwise(F.col("metric")))
    meta = F.broadcast(dim.select("queue_id", "queue_name", "language", "role"))
    out = rows.join(meta, "queue_id", "left").select(
        F.lit(period).alias("period"), F.lit(start).alias("date_start"), F.lit(end).alias("date_end"), "section",
        F.coalesce("queue_id", F.lit("")).alias("queue_id"), F.coalesce("queue_name", F.lit("")).alias("queue_name"),
        F.coalesce("language", F.lit("")).alias("language"), F.coalesce("role", F.lit("")).alias("role"),
        "entity_type", F.coalesce("entity", F.lit("")).alias("entity"), "date", "hour", "dow", "metric",
        "value", "details")
    return out


def pivot_to_long(pivot: DataFrame, key: str, ids: Sequence[str]) -> DataFrame:
    """Per-queue columns of a consolidated pivot back to (key, queue_id, queue_calls)."""
    return pivot.select(key, F.stack(F.lit(len(ids)), *[x for q in ids for x in (F.lit(q), F.col(f"`{q}`"))])
                        .alias("queue_id", "queue_calls"))


# --- manifest (SNK-3) and documents (SNK-2) ----------------------------------------------

def manifest_entry(start: Column, end: Column, source: Column, status: Column) -> Column:
    return F.struct(period_key(start).alias("key"), month_label(start).alias("label"),
                    F.date_format(start, "yyyy-MM-dd").alias("start"), F.date_format(end, "yyyy-MM-dd").alias("end"),
                    F.concat(F.lit("month_"), F.date_format(start, "yyyy-MM-dd"), F.lit("_"),
                             F.date_format(end, "yyyy-MM-dd"), F.lit("/metrics.json")).alias("path"),
                    source.alias("source"), status.alias("validation_status"))


def manifest_upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """SNK-3 / J-8: replace entries by month key, newest first (``rank`` = position)."""
    merged = existing.join(new.select("key"), "key", "left_anti").unionByName(new)
    from pyspark.sql import Window
    return merged.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("start"), F.asc("key"))))


def _clean(df: DataFrame, column: str) -> Column:
    return json_number(column) if dict(df.dtypes)[column] == "double" else F.col(column)


def _nest(df: DataFrame, name: str, fields: Sequence[str], order: Sequence[str], key: str = "queue_id") -> DataFrame:
    """Rows of each key as an ordered list of records. The rows come from a table bounded by the period, the
    agent roster or a top-k."""
    s = F.struct(*[F.col(o).alias(f"_{i}") for i, o in enumerate(order)],
                 F.struct(*[_clean(df, f).alias(f) for f in sorted(fields)]).alias("v"))
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(s)), lambda x: x["v"]).alias(name))


#: Lists of a queue document: name, fields and order of each.
QUEUE_LISTS = (
    ("daily_volume", ("date", "calls"), ("date",)),
    ("weekly_volume", ("week_start", "week_end", "calls"), ("week_start",)),
    ("hourly_volume", ("hour", "calls", "no_answer_count", "no_answer_rate", "avg_agent_sec"), ("hour",)),
    ("dow_volume", ("dow", "calls"), ("dow",)),
    ("agent_leaderboard", ("agent_name", "calls", "avg_sec", "median_sec", "total_sec", "pct_of_answered"), ("rank",)),
    ("top_callers", ("caller_number_norm", "calls"), ("rank",)),
)
#: Callers that a period document shows itself.
DOCUMENT_CALLERS = 1000
DISTRIBUTION_FIELDS = ("count", "mean", "std", "min", "p25", "median", "p75", "max")


def queue_documents(curated: DataFrame, cube: DataFrame, dim: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """SNK-2: one JSON document per queue (keys sorted, NaN/inf nulled, nulls kept; lists are never null).

    ``counts`` (J-5: queue_id and the run's validation counts) adds its columns to the documents.
    """
    from callgrid.operators import cube as C
    from callgrid.operators import queue_metrics as M
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    tables = {
        "daily_volume": C.daily_volume(cube).select("queue_id", day("date"), "calls"),
        "weekly_volume": C.weekly_volume(cube).select("queue_id", day("week_start"), day("week_end"), "calls"),
        "hourly_volume": C.hourly_volume(cube), "dow_volume": C.dow_volume(cube),
        "agent_leaderboard": M.agent_leaderboard(curated), "top_callers": M.top_callers(curated),
    }
    docs = C.headline(cube, dim)
    if counts is not None:
        docs = docs.join(counts.select("queue_id", *[c for c in counts.columns if c not in docs.columns]), "queue_id", "left")
    for name, fields, order in QUEUE_LISTS:
        docs = docs.join(_nest(tables[name], name, fields, order), "queue_id", "left").withColumn(
            name, F.coalesce(name, F.array()))
    days = C.busiest_quietest_day(cube)
    pick = lambda d: F.when(F.col(f"{d}_date").isNotNull(), F.struct(
        F.col(f"{d}_calls").alias("calls"), F.date_format(f"{d}_date", "yyyy-MM-dd").alias("date"))).alias(f"{d}_day")
    docs = docs.join(days.select("queue_id", pick("busiest"), pick("quietest")), "queue_id", "left")
    dist = M.duration_distribution(curated, dim)
    body = F.struct(*[_clean(dist, f).alias(f) for f in sorted(DISTRIBUTION_FIELDS)])
    per_measure = [F.first(F.when(F.col("measure") == m, body), ignorenulls=True).alias(m) for m in sorted(M.MEASURES)]
    dist = dist.groupBy("queue_id").agg(F.struct(*per_measure).alias("duration_distributions"))
    reasons = _nest(M.release_reasons(curated).withColumn("kind", F.concat_ws("|", "queue_id", "reason_type")),
                    "rows", ("reason", "calls"), ("rank",), "kind")
    reasons = reasons.select(F.split_part("kind", F.lit("|"), F.lit(1)).alias("queue_id"),
                             F.split_part("kind", F.lit("|"), F.lit(2)).alias("reason_type"), "rows")
    lists = [F.coalesce(F.first(F.when(F.col("reason_type") == t, F.col("rows")), ignorenulls=True), F.array()).alias(t)
             for t in ("agent", "queue")]
    reasons = reasons.groupBy("queue_id").agg(F.struct(*lists).alias("release_reasons"))
    empty = F.from_json(F.lit('{"agent": [], "queue": []}'), reasons.schema["release_reasons"].dataType.simpleString())
    docs = docs.join(dist, "queue_id", "left").join(reasons, "queue_id", "left").withColumn(
        "release_reasons", F.coalesce("release_reasons", empty))
    names = sorted(docs.columns)
    return docs.select("queue_id", F.to_json(F.struct(*[_clean(docs, c).alias(c) for c in names]),
                                             {"ignoreNullFields": "false"}).alias("document"))


def period_document(queue_docs: DataFrame, funnel: DataFrame, agents: DataFrame, callers: DataFrame, hourly: DataFrame,
                    daily: DataFrame, anomalies: DataFrame, gaps: DataFrame, validation: DataFrame, period: str,
                    start: str, end: str, generated_at: str, caller_parts: DataFrame | None = None) -> DataFrame:
    """SNK-2: the document of a whole period: queues, cross-queue tables, anomalies, gaps and validation.

    A report is one document; every part comes from a table of a row a queue, language,
    agent, hour, day or anomaly. Callers have no such bound: the document shows the
    ``DOCUMENT_CALLERS`` most frequent ones and names every part file of the whole ordered list
    (``caller_parts``: file, rows, first and last caller; a row a part), so all of them can be reached from it.
    """
    callers = callers.orderBy(F.desc("total_calls"), "caller_number_norm").limit(DOCUMENT_CALLERS)

    def text(df: DataFrame) -> Column:
        cols = [(F.date_format(c, "yyyy-MM-dd") if t == "date" else _clean(df, c)).alias(c) for c, t in sorted(df.dtypes)]
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})

    def listed(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
        by = [(F.col(o) if isinstance(o, str) else o).alias(f"_{i}") for i, o in enumerate(order)]
        rows = F.array_sort(F.collect_list(F.struct(*by, text(df).alias("v"))))
        return df.agg(F.transform(rows, lambda x: F.parse_json(x["v"])).alias(name))

    def keyed(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
        return df.agg(F.map_from_entries(F.transform(rows, lambda x: F.struct(x["k"], F.parse_json(x["v"])))).alias(name))

    parts = [
        keyed(queue_docs, "queue_id", F.col("document"), "queues"), keyed(funnel, "language", text(funnel), "funnels"),
        listed(agents, [-F.col("total_calls"), "agent_name"], "agents"), listed(callers, [-F.col("total_calls"), "caller_number_norm"], "callers"),
        *([listed(caller_parts, ["file"], "caller_parts")] if caller_parts is not None else []),
        listed(hourly, ["hour", "queue_id"], "same_hour_no_answer"), listed(daily, ["date", "queue_id"], "same_day_volume"),
        listed(anomalies, ["kind", "queue_id", "description"], "anomalies"), listed(gaps, ["queue_id"], "source_gaps"),
        validation.agg(F.parse_json(F.coalesce(F.first(text(validation)), F.lit('{"status":"success"}'))).alias("validation")),
    ]
    doc = parts[0].withColumn("_k", F.lit(1))
    for p in parts[1:]:  # each part is one row
        doc = doc.join(p.withColumn("_k", F.lit(1)), "_k")
    crossqueue = F.struct("agents", *(["caller_parts"] if caller_parts is not None else []), "callers", "funnels", "same_day_volume", "same_hour_no_answer").alias("crossqueue")
    return doc.select(F.to_json(F.struct(
        "anomalies", crossqueue, F.struct(F.lit(end).alias("end"), F.lit(start).alias("start")).alias("date_range"),
        F.lit(generated_at).alias("generated_at"), F.lit(period).alias("period"), "queues", "source_gaps", "validation"),
        {"ignoreNullFields": "false"}).alias("document"))
