"""Query family: report-level views and exports.

A-19, A-22, F-21…F-25, SNK-2, SNK-3, SNK-9, U-3.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.operators import anomaly as N
from callgrid.operators import cross as X
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators import report as R
from callgrid.operators import validate as V
from callgrid.operators.curate import csv_pipeline, filter_period_csv
from callgrid.operators.flatten import field_inventory
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.plans.q_api import FIELD_INVENTORY_SQL
from callgrid.plans.q_core import CURATED_SELECT, FUNNEL_SQL, HEADLINE_SQL, HOURLY_SQL
from callgrid.plans.q_rules import (CALLER_RULE_SQL, HOURLY_RULE_SQL, RULE_INPUTS, SINGLE_SQL, SYSTEM_SQL)
from callgrid.session import ensure_checkpoint_dir, table_path
from callgrid.sinks.export import (export_text, read_parts, write_csv_file, write_inventory_document, write_ordered_parts,
                                   write_queue_exports)
from callgrid.sources.csv_legs import load_csv_legs
from callgrid.sources.testdata import api_records_from_tables

PERIOD_LABEL = "January 2024"
ANOMALIES_CTE = ",\nanomalies AS (" + "\nUNION ALL\n".join([SYSTEM_SQL, SINGLE_SQL, HOURLY_RULE_SQL, CALLER_RULE_SQL]) + ")"
GAPS_CTE = """,
gaps AS (SELECT queue_id FROM {dim} WHERE queue_id NOT IN (SELECT DISTINCT queue_id FROM legs))""".format(dim=O.DIM)


def _parts(spark, sf_dir):
    cur = ctx.curated_shared(spark, sf_dir)
    cube = ctx.cube_shared(spark, sf_dir)
    dim = ctx.dim(spark)
    head = C.headline(cube, dim)
    funnel = X.language_funnel(cube, dim)
    hourly = C.hourly_volume(cube, with_avg=False)
    anomalies = N.all_anomalies(M.agent_leaderboard(cur), hourly, X.consolidated_callers(cur, ctx.QUEUE_IDS))
    gaps = V.source_gaps(ctx.legs(spark, sf_dir).select("queue_id"), dim, "events")
    return cur, cube, dim, head, funnel, anomalies, gaps


SUMMARY_SQL = O.with_curated(HEADLINE_SQL + FUNNEL_SQL + RULE_INPUTS + ANOMALIES_CTE + GAPS_CTE + f""",
summary AS (
  SELECT '{PERIOD_LABEL}' AS period_label, (SELECT CAST(sum(total_calls) AS BIGINT) FROM headline) AS total_calls,
    (SELECT {O.ratio('sum(primary_answered + overflow_answered)', 'sum(primary_calls)')} FROM funnel) AS reached_rate,
    (SELECT count(*) FROM anomalies) AS anomaly_count, (SELECT count(*) FROM gaps) AS source_gap_count)""")


@register("period_summary", SUMMARY_SQL + "\nSELECT * FROM summary")
def period_summary(spark, sf_dir):
    """A-19: total calls, reach rate over primary calls, anomaly and gap counts."""
    cur, cube, dim, head, funnel, anomalies, gaps = _parts(spark, sf_dir)
    return R.period_summary(head, funnel, anomalies, gaps, ctx.PERIOD_START)


def _status_sql(metric: str, value: str) -> str:
    parts = []
    for mid, (direction, good, watch) in R.THRESHOLDS.items():
        op = ">=" if direction == "higher-is-better" else "<="
        parts.append(f"WHEN {metric} = '{mid}' THEN (CASE WHEN {value} {op} {good} THEN 'good' "
                     f"WHEN {value} {op} {watch} THEN 'watch' ELSE 'at-risk' END)")
    return "CASE " + " ".join(parts) + " END"


@register("threshold_status", SUMMARY_SQL + f""",
t AS (
  SELECT 'language' AS scope, language AS entity, 'reached_an_agent' AS metric_id, effective_answer_rate AS value FROM funnel
  UNION ALL SELECT 'language', language, 'right_language_routing', routing_match FROM funnel
  UNION ALL SELECT 'queue', queue_id, 'missed_call_rate', no_agent_rate FROM headline
  UNION ALL SELECT 'period', period_label, 'reached_an_agent', reached_rate FROM summary)
SELECT *, {_status_sql('metric_id', 'value')} AS status FROM t""")
def threshold_status(spark, sf_dir):
    """F-23: good / watch / at-risk where the report shows a status."""
    cur, cube, dim, head, funnel, anomalies, gaps = _parts(spark, sf_dir)
    summary = R.period_summary(head, funnel, anomalies, gaps, ctx.PERIOD_START)
    return R.threshold_rows(funnel, head, summary)


DOW_AVG_CTE = f""",
dv AS (SELECT queue_id, dow, count(*) AS calls FROM curated GROUP BY 1, 2),
occ AS (SELECT strftime(d, '%A') AS dow, count(*) AS occurrences
        FROM (SELECT unnest(generate_series(DATE '{O.PERIOD_START}', DATE '{O.PERIOD_END}', INTERVAL 1 DAY)) AS d)
        GROUP BY 1),
dow_avg AS (SELECT dv.queue_id, dv.dow, dv.calls, coalesce(occ.occurrences, 0) AS occurrences,
       CASE WHEN occ.occurrences > 0 THEN CAST(dv.calls AS DOUBLE) / occ.occurrences END AS avg_calls_per_occurrence
     FROM dv LEFT JOIN occ USING (dow))"""


@register("dow_average", O.with_curated(DOW_AVG_CTE + "\nSELECT * FROM dow_avg"))
def dow_average(spark, sf_dir):
    """F-24: weekday calls and average per occurrence of that weekday in the period."""
    return R.dow_average(C.dow_volume(ctx.cube(spark, sf_dir)), spark, ctx.PERIOD_START, ctx.PERIOD_END)


@register("hour_labels", O.with_curated(f"""
, h AS (SELECT queue_id, hour, avg(CASE WHEN is_handled THEN agent_sec END) AS avg_agent_sec FROM curated GROUP BY 1, 2),
r AS (SELECT *, CAST(round(avg_agent_sec) AS BIGINT) AS tot FROM h)
SELECT queue_id, hour, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
  coalesce(CASE WHEN tot // 60 <= 0 THEN CAST(tot % 60 AS VARCHAR) || 's'
    ELSE CAST(tot // 60 AS VARCHAR) || 'm ' || lpad(CAST(tot % 60 AS VARCHAR), 2, '0') || 's' END, 'n/a') AS duration_label
FROM r"""))
def hour_labels(spark, sf_dir):
    """F-25: hour and duration labels of the hourly table."""
    h = C.hourly_volume(ctx.cube(spark, sf_dir))
    return h.select("queue_id", "hour", R.hour_label(F.col("hour")).alias("hour_label"),
                    R.duration_label(F.col("avg_agent_sec")).alias("duration_label"))


@register("day_labels", O.with_curated(f"""
, d AS (SELECT queue_id, date, count(*) AS calls, count(*) FILTER (WHERE NOT is_handled) AS no_answer FROM curated GROUP BY 1, 2)
SELECT queue_id, strftime(date, '%Y-%m-%d') AS date, strftime(date, '%b %-d') AS date_label, format('{{:,}}', calls * 1000) AS integer_label,
  format('{{:,.1f}}', round(calls * 100.25, 1)) AS decimal_label, format('{{:,.1f}}', round({O.ratio('no_answer', 'calls')} * 100, 1)) || '%' AS rate_label
FROM d"""))
def day_labels(spark, sf_dir):
    """F-25: short-date, integer, decimal and percent labels of every day's volume."""
    d = C.daily_volume(ctx.cube(spark, sf_dir), with_no_answer=True)
    return d.select("queue_id", F.date_format("date", "yyyy-MM-dd").alias("date"), R.short_date_label(F.col("date")).alias("date_label"),
                    R.integer_label(F.col("calls") * 1000).alias("integer_label"),
                    R.decimal_label(F.col("calls") * 100.25).alias("decimal_label"),
                    R.percent_label(F.round(F.col("no_answer_rate"), 3)).alias("rate_label"))


@register("caller_labels", O.with_curated("""
, cc AS (SELECT caller_number_norm, count(*) AS calls FROM curated
         WHERE NOT starts_with(caller_number_norm, '__restricted__:') GROUP BY 1),
d AS (SELECT *, regexp_replace(caller_number_norm, '[^0-9]', '', 'g') AS dg FROM cc),
t AS (SELECT *, CASE WHEN length(dg) = 11 AND starts_with(dg, '1') THEN substr(dg, 2, 10)
                     WHEN length(dg) = 10 THEN dg END AS ten FROM d)
SELECT caller_number_norm, calls, CASE WHEN ten IS NOT NULL THEN '+1 (' || substr(ten, 1, 3) || ') ' ||
  substr(ten, 4, 3) || '-' || substr(ten, 7, 4) ELSE caller_number_norm END AS phone_label FROM t"""))
def caller_labels(spark, sf_dir):
    """F-25: phone labels of every non-restricted caller."""
    cc = M.caller_counts(ctx.curated(spark, sf_dir)).groupBy("caller_number_norm").agg(F.sum("calls").alias("calls"))
    return cc.select("caller_number_norm", "calls", R.phone_label(F.col("caller_number_norm")).alias("phone_label"))


@register("anomaly_labels", O.with_curated(RULE_INPUTS + ANOMALIES_CTE + """
SELECT kind, count(*) AS anomalies,
  CASE kind WHEN 'volume_spike' THEN 'Volume spike' ELSE
    array_to_string(list_transform(string_split(kind, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS kind_label
FROM anomalies GROUP BY kind"""))
def anomaly_labels(spark, sf_dir):
    """F-25: display label per anomaly kind."""
    cur, cube, dim, head, funnel, anomalies, gaps = _parts(spark, sf_dir)
    return anomalies.groupBy("kind").agg(F.count(F.lit(1)).alias("anomalies")).withColumn(
        "kind_label", R.anomaly_kind_label(F.col("kind")))


@register("comparative_series", O.with_curated(f"""
SELECT 'same_hour_no_answer' AS series_name, queue_id, CAST(hour AS VARCHAR) AS bucket, count(call_id) AS calls,
  count(*) FILTER (WHERE NOT is_handled) AS no_answer_count,
  {O.ratio('count(*) FILTER (WHERE NOT is_handled)', 'count(call_id)')} AS no_answer_rate
FROM curated GROUP BY queue_id, hour
UNION ALL
SELECT 'same_day_volume', queue_id, strftime(date, '%Y-%m-%d'), count(*), NULL, NULL FROM curated GROUP BY queue_id, date"""
    .replace("count(*) FILTER (WHERE NOT is_handled) AS no_answer_count",
             "CAST(count(*) FILTER (WHERE NOT is_handled) AS DOUBLE) AS no_answer_count")))
def comparative_series(spark, sf_dir):
    """SNK-9: same-hour and same-day series stacked with a text bucket (the sparse no-answer
    count is returned as double so missing values compare the same on both engines)."""
    cube = ctx.cube(spark, sf_dir)
    out = R.comparative_series(C.hourly_volume(cube, with_avg=False), C.daily_volume(cube))
    return out.withColumn("no_answer_count", F.col("no_answer_count").cast("double"))


@register("period_resolver", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders),
p AS (SELECT run_date, CAST(date_trunc('month', run_date - INTERVAL 1 MONTH) AS DATE) AS s FROM d)
SELECT run_date, s AS start, last_day(s) AS "end", strftime(s, '%B %Y') AS label, strftime(s, '%Y-%m') AS key
FROM p""", dates=("run_date", "start", "end"))
def period_resolver(spark, sf_dir):
    """F-21 / F-22: for every order date as a run date, the previous calendar month and its label/key."""
    d = spark.read.parquet(table_path(sf_dir, "orders")).select(F.to_date("o_orderdate").alias("run_date")).distinct()
    start, end = R.previous_month(F.col("run_date"))
    return d.select("run_date", start.alias("start"), end.alias("end"), R.month_label(start).alias("label"),
                    R.period_key(start).alias("key"))


MANIFEST_SQL = """WITH months AS (
  SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS s, 'api' AS source FROM orders
  UNION SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE), 'api' FROM events),
fresh AS (SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS s, 'csv' AS source FROM events),
e AS (
  SELECT strftime(s, '%Y-%m') AS key, strftime(s, '%B %Y') AS label, strftime(s, '%Y-%m-%d') AS start,
    strftime(last_day(s), '%Y-%m-%d') AS "end",
    'month_' || strftime(s, '%Y-%m-%d') || '_' || strftime(last_day(s), '%Y-%m-%d') || '/metrics.json' AS path,
    source, 'success' AS validation_status FROM months),
n AS (
  SELECT strftime(s, '%Y-%m') AS key, strftime(s, '%B %Y') AS label, strftime(s, '%Y-%m-%d') AS start,
    strftime(last_day(s), '%Y-%m-%d') AS "end",
    'month_' || strftime(s, '%Y-%m-%d') || '_' || strftime(last_day(s), '%Y-%m-%d') || '/metrics.json' AS path,
    source, 'success' AS validation_status FROM fresh),
m AS (SELECT * FROM e WHERE key NOT IN (SELECT key FROM n) UNION ALL SELECT * FROM n)
SELECT *, CAST(row_number() OVER (ORDER BY start DESC, key ASC) AS INTEGER) AS rank FROM m"""


@register("manifest_upsert", MANIFEST_SQL)
def manifest_upsert(spark, sf_dir):
    """SNK-3: existing month entries (every month of orders and events) upserted with the events
    month from a new run; newest first."""
    orders = spark.read.parquet(table_path(sf_dir, "orders")).select(F.col("o_orderdate").alias("ts"))
    events = spark.read.parquet(table_path(sf_dir, "events")).select("ts")
    month = lambda df: df.select(F.to_date(F.date_trunc("month", "ts")).alias("s")).distinct()
    ok = F.lit("success")
    existing = month(orders.unionByName(events)).select(
        R.manifest_entry(F.col("s"), F.last_day("s"), F.lit("api"), ok).alias("e")).select("e.*")
    new = month(events).select(R.manifest_entry(F.col("s"), F.last_day("s"), F.lit("csv"), ok).alias("e")).select("e.*")
    return R.manifest_upsert(existing, new)


# --- SNK-2 documents, exploded to one row a value ------------------------------------------

_DAILY_SQL = "SELECT queue_id, strftime(date, '%Y-%m-%d') AS date, count(*) AS calls FROM curated GROUP BY 1, 2"
_LISTS_SQL = {
    "daily_volume": (_DAILY_SQL, "date"),
    "weekly_volume": ("SELECT queue_id, strftime(date_trunc('week', date), '%Y-%m-%d') AS week_start, "
                      "strftime(date_trunc('week', date) + INTERVAL 6 DAY, '%Y-%m-%d') AS week_end, count(*) AS calls "
                      "FROM curated GROUP BY 1, 2, 3", "week_start"),
    "hourly_volume": (HOURLY_SQL, "hour"),
    "dow_volume": ("SELECT queue_id, dow, count(*) AS calls FROM curated GROUP BY 1, 2", "dow"),
    "agent_leaderboard": ("SELECT * FROM leaderboard", "rank"),
    "top_callers": ("SELECT * FROM topc", "rank"),
}
_REASONS_SQL = f"""SELECT *, row_number() OVER (PARTITION BY queue_id, kind ORDER BY calls DESC, reason ASC) AS rank FROM (
  SELECT queue_id, kind, {O.trim_ws('raw')} AS reason, count(*) AS calls FROM (
    SELECT queue_id, 'queue' AS kind, queue_release_reason AS raw FROM curated
    UNION ALL SELECT queue_id, 'agent', agent_release_reason FROM curated)
  WHERE coalesce({O.has_value('raw')}, false) GROUP BY 1, 2, 3)"""
_TEXTS = {"date", "week_start", "week_end", "dow", "agent_name", "caller_number_norm", "reason"}
HEADLINE_FIELDS = ("total_calls", "handled_calls", "no_agent_calls", "answer_rate", "no_agent_rate", "days_with_calls",
                   "avg_calls_per_active_day")


def _document_sql() -> str:
    from callgrid.plans.q_queue import DIST_SQL, LEADERBOARD_CTE, TOP_CALLERS_CTE

    def rows(table: str, section: str, fields, item: str) -> list[str]:
        return [f"SELECT queue_id, {section} AS section, CAST({item} AS INTEGER) AS item, '{f}' AS name, "
                + (f"CAST({f} AS VARCHAR) AS text, NULL::DOUBLE AS number" if f in _TEXTS
                   else f"NULL::VARCHAR AS text, round(CAST({f} AS DOUBLE), 6) AS number")
                + f" FROM {table}" for f in fields]

    ctes, parts = [], []
    for name, fields, _ in R.QUEUE_LISTS:
        sql, order = _LISTS_SQL[name]
        ctes.append(f"l_{name} AS (SELECT *, row_number() OVER (PARTITION BY queue_id ORDER BY {order}) - 1 AS item FROM ({sql}))")
        parts += rows(f"l_{name}", f"'{name}'", fields, "item")
    ctes.append(f"l_reasons AS ({_REASONS_SQL})")
    parts += rows("l_reasons", "'release_reasons.' || kind", ("reason", "calls"), "rank - 1")
    parts += rows("headline", "'total'", HEADLINE_FIELDS, "0")
    dist_ctes, dist = DIST_SQL[len(O.curated_ctes()):].strip().rsplit("SELECT g.queue_id", 1)
    ctes.append(f"l_dist AS (SELECT g.queue_id{dist})")
    parts += rows("l_dist", "'duration_distributions.' || measure", R.DISTRIBUTION_FIELDS, "0")
    for word, order in (("busiest", "calls DESC, date"), ("quietest", "calls, date")):
        ctes.append(f"l_{word} AS (SELECT * FROM ({_DAILY_SQL}) QUALIFY row_number() OVER (PARTITION BY queue_id ORDER BY {order}) = 1)")
        parts += rows(f"l_{word}", f"'{word}_day'", ("date", "calls"), "0")
    return O.with_curated(HEADLINE_SQL + LEADERBOARD_CTE + TOP_CALLERS_CTE + dist_ctes.rstrip() + ",\n"
                          + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(parts))


def queue_document_rows(docs):
    """One row a value of queue documents: (queue_id, section, item, name, text, number)."""
    record = lambda fields: "struct<" + ",".join(f"{f}:{'string' if f in _TEXTS else 'double'}" for f in fields) + ">"
    lists = {name: fields for name, fields, _ in R.QUEUE_LISTS}
    reason, day = ("reason", "calls"), ("date", "calls")
    schema = ("struct<" + ",".join([
        *(f"{n}:array<{record(f)}>" for n, f in lists.items()), *(f"{f}:double" for f in HEADLINE_FIELDS),
        f"release_reasons:struct<queue:array<{record(reason)}>,agent:array<{record(reason)}>>",
        "duration_distributions:struct<" + ",".join(f"{m}:{record(R.DISTRIBUTION_FIELDS)}" for m in M.MEASURES) + ">",
        f"busiest_day:{record(day)}", f"quietest_day:{record(day)}"]) + ">")
    c = F.col("d")

    def rows(section, item, value, fields):
        return F.array(*[F.struct(
            F.lit(section).alias("section"), item.alias("item"), F.lit(f).alias("name"),
            (value[f] if f in _TEXTS else F.lit(None).cast("string")).alias("text"),
            (F.lit(None).cast("double") if f in _TEXTS else F.round(value[f], 6)).alias("number")) for f in fields])

    def each(section, values, fields):
        return F.flatten(F.transform(values, lambda r, i: rows(section, i, r, fields)))

    zero = F.lit(0)
    parts = [*[each(n, c[n], f) for n, f in lists.items()],
             *[each(f"release_reasons.{t}", c["release_reasons"][t], reason) for t in ("queue", "agent")],
             *[rows(f"duration_distributions.{m}", zero, c["duration_distributions"][m], R.DISTRIBUTION_FIELDS) for m in M.MEASURES],
             rows("total", zero, c, HEADLINE_FIELDS),
             *[F.filter(rows(f"{w}_day", zero, c[f"{w}_day"], day), lambda x: c["total_calls"] > 0) for w in ("busiest", "quietest")]]
    d = docs.select("queue_id", F.from_json("document", schema).alias("d"))
    return d.select("queue_id", F.inline(F.concat(*parts)))


def _queue_documents(spark, sf_dir):
    return R.queue_documents(ctx.curated_shared(spark, sf_dir), ctx.cube_shared(spark, sf_dir), ctx.dim(spark))


@register("report_document", _document_sql())
def report_document(spark, sf_dir):
    """SNK-2: the JSON document of each queue, parsed again and given as one row a value."""
    return queue_document_rows(_queue_documents(spark, sf_dir))


def _leaderboard_cte() -> str:
    from callgrid.plans.q_queue import LEADERBOARD_CTE
    return LEADERBOARD_CTE


@register("report_heads", O.with_curated(_leaderboard_cte() + f"""
, r AS ({_REASONS_SQL})
SELECT queue_id, 'agent' AS head, agent_name AS name, calls, rank FROM leaderboard WHERE rank <= 10
UNION ALL SELECT queue_id, kind || '_reason', reason, calls, CAST(rank AS INTEGER) FROM r WHERE rank <= 8"""))
def report_heads(spark, sf_dir):
    """O-3: the ten agents and eight reasons that head each queue's lists."""
    cur = ctx.curated_shared(spark, sf_dir)
    agents = M.agent_leaderboard(cur).filter("rank <= 10").select("queue_id", F.lit("agent").alias("head"), F.col("agent_name").alias("name"), "calls", "rank")
    reasons = M.release_reasons(cur).filter("rank <= 8").select(
        "queue_id", F.concat("reason_type", F.lit("_reason")).alias("head"), F.col("reason").alias("name"), "calls", "rank")
    return agents.unionByName(reasons)


def period_report(spark, sf_dir):
    """SNK-2: the document of the whole period."""
    cur, cube, dim, head, funnel, anomalies, gaps = _parts(spark, sf_dir)
    filtered = filter_period_csv(ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END)
    validation = V.run_validation(V.queue_validation(filtered, cur, dim), ctx.PERIOD_START, ctx.PERIOD_END, "America/Toronto")
    return R.period_document(
        _queue_documents(spark, sf_dir), funnel, X.consolidated_agents(cur, ctx.QUEUE_IDS),
        X.consolidated_callers(cur, ctx.QUEUE_IDS), C.hourly_volume(cube, with_avg=False), C.daily_volume(cube), anomalies,
        gaps, validation, "month", ctx.PERIOD_START, ctx.PERIOD_END, f"{ctx.PERIOD_END}T23:59:59Z")


@register("manifest_scan", MANIFEST_SQL.replace(
    "SELECT *, CAST(row_number() OVER (ORDER BY start DESC, key ASC) AS INTEGER) AS rank FROM m",
    "SELECT key, label, start, \"end\", '/data/reports/' || path AS path, source, "
    "CAST(row_number() OVER (ORDER BY start DESC, key ASC) AS INTEGER) AS rank FROM m"))
def manifest_scan(spark, sf_dir):
    """S-9: the upserted manifest written as one document and read back (bounded: one entry per month)."""
    from callgrid.sources.documents import scan_manifest
    m = manifest_upsert(spark, sf_dir).drop("rank")
    doc = m.agg(F.to_json(F.struct(F.collect_list(F.struct(*m.columns)).alias("reports"))).alias("value"))
    return scan_manifest(doc, "/data/reports")


@register("report_contract", O.with_curated(f"""
, slots AS (SELECT DISTINCT date, hour FROM curated),
have AS (SELECT DISTINCT date, hour, queue_id FROM curated)
SELECT strftime(s.date, '%Y-%m-%d') || ' ' || CAST(s.hour AS VARCHAR) AS report,
  'queues[''' || q.queue_id || '''].' || r.name AS path, r.kind AS expected, 'missing' AS found
FROM slots s CROSS JOIN {O.DIM} q
CROSS JOIN (VALUES ('total_calls', 'number'), ('daily_volume', 'array'), ('hourly_volume', 'array'),
            ('agent_leaderboard', 'array'), ('top_callers', 'array')) r(name, kind)
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.date = s.date AND h.hour = s.hour AND h.queue_id = q.queue_id)"""))
def report_contract(spark, sf_dir):
    """S-8: what reports of each single hour lack of the report contract: the queues without a call in it."""
    from callgrid.sources.documents import report_rules, shape_violations
    none = F.array().cast("array<string>")
    queue = F.struct("queue_id", F.struct("total_calls", *[none.alias(n) for n in (
        "daily_volume", "hourly_volume", "agent_leaderboard", "top_callers")]))
    hours = ctx.curated(spark, sf_dir).groupBy("date", "hour", "queue_id").agg(F.count(F.lit(1)).alias("total_calls"))
    docs = hours.groupBy("date", "hour").agg(F.map_from_entries(F.collect_list(queue)).alias("queues"))  # a row a queue at most
    docs = docs.select(F.concat_ws(" ", F.date_format("date", "yyyy-MM-dd"), "hour").alias("report"),
                       F.to_json(F.struct("queues")).alias("document"))
    rules = tuple(r for r in report_rules(ctx.QUEUE_IDS) if r[0].startswith("queues["))
    return shape_violations(docs, rules, "report")


def _long_sql() -> str:
    from callgrid.plans.q_rules import QV_SQL
    qv_part = QV_SQL[len(O.curated_ctes()):].rstrip()
    rv_select = f"""SELECT 'success' AS status, CAST(sum(raw_rows) AS BIGINT) AS raw_row_count,
  CAST(sum(cleaned_calls) AS BIGINT) AS cleaned_row_count,
  CAST(sum(raw_rows) - sum(cleaned_calls) AS BIGINT) AS duplicate_rows_removed,
  CAST(sum(answered_calls) AS BIGINT) AS answered_count, CAST(sum(no_agent_calls) AS BIGINT) AS no_agent_count,
  CAST(sum(answered_calls) + sum(no_agent_calls) AS BIGINT) AS answered_plus_no_agent,
  sum(answered_calls) + sum(no_agent_calls) = sum(cleaned_calls) AS answered_plus_no_agent_reconciles,
  '{O.PERIOD_START} 00:00:00 through {O.PERIOD_END} 23:59:59' AS date_range_used,
  'America/Toronto' AS timezone_used, string_agg(queue_id, ',' ORDER BY queue_id) AS queues_included,
  'Orig CallID; keep last row after date filtering' AS dedupe_key_used,
  'csv_cleaned_queue_level_calls' AS calculation_source_used FROM qv"""
    from callgrid.plans.q_cross import AGENTS_SQL
    from callgrid.plans.q_queue import TOP_CALLERS_CTE
    from callgrid.plans.q_core import HOURLY_SQL
    ids = ctx.QUEUE_IDS
    e = "''"

    def row(section, etype, metric, num="NULL", text="NULL", queue="queue_id", entity=e, date=e, hour=e, dow=e,
            details=e, src="x"):
        return (f"SELECT {queue} AS qid, '{section}' AS section, {etype} AS entity_type, {entity} AS entity, "
                f"{date} AS date, {hour} AS hour, {dow} AS dow, '{metric}' AS metric, "
                f"CAST({num} AS DOUBLE) AS value_num, CAST({text} AS VARCHAR) AS value_text, {details} AS details "
                f"FROM {src}")

    d = "strftime(date, '%Y-%m-%d')"
    hl = "lpad(CAST(hour AS VARCHAR), 2, '0') || ':00'"
    parts = []
    for m in ("total_calls", "handled_calls", "answer_rate", "no_agent_calls", "no_agent_rate", "days_with_calls",
              "avg_calls_per_active_day"):
        parts.append(row("queue_summary", "'queue'", m, num=m, src="headline"))
    parts.append(row("queue_summary", "'queue'", "busiest_day_calls", num="busiest_calls",
                     date="strftime(busiest_date, '%Y-%m-%d')", src="bq"))
    parts.append(row("queue_summary", "'queue'", "quietest_day_calls", num="quietest_calls",
                     date="strftime(quietest_date, '%Y-%m-%d')", src="bq"))
    parts.append(row("queue_daily_volume", "'date'", "calls", num="calls", entity=d, date=d, src="daily"))
    parts.append(row("queue_weekly_volume", "'week'", "calls", num="calls",
                     entity="strftime(week_start, '%Y-%m-%d') || ' to ' || strftime(week_end, '%Y-%m-%d')",
                     src="weekly"))
    for m in ("calls", "no_answer_count", "no_answer_rate", "avg_agent_sec"):
        parts.append(row("queue_hourly_volume", "'hour'", m, num=m, entity=hl, hour="CAST(hour AS VARCHAR)",
                         src="hourly_q"))
    for m in ("calls", "avg_calls_per_occurrence"):
        parts.append(row("queue_dow_volume", "'day_of_week'", m, num=m, entity="dow", dow="dow", src="dow_avg"))
    parts.append(row("queue_release_reasons", "'queue_reason'", "calls", num="calls", entity="reason",
                     src="(SELECT * FROM reasons WHERE reason_type = 'queue')"))
    parts.append(row("agent_release_reasons", "'agent_reason'", "calls", num="calls", entity="reason",
                     src="(SELECT * FROM reasons WHERE reason_type = 'agent')"))
    for m in ("calls", "avg_sec", "median_sec", "total_sec", "pct_of_answered"):
        parts.append(row("queue_agent_leaderboard", "'agent'", m, num=m, entity="agent_name", src="leaderboard"))
    parts.append(row("queue_top_callers", "'caller'", "calls", num="calls", entity="caller_number_norm", src="topc"))
    for m in ("primary_calls", "primary_answered", "primary_failed", "primary_no_agent_calls", "primary_no_agent_rate",
              "overflow_received", "routing_match", "overflow_answered", "overflow_failed", "lost", "lost_rate",
              "effective_answer_rate", "unaccounted", "final_dropped_calls"):
        parts.append(row("crossqueue_funnel", "'language'", m, num=m, queue="NULL", entity="language", src="funnel"))
    for m in ("final_dropped_available", "drop_definition"):
        parts.append(row("crossqueue_funnel", "'language'", m, text=m, queue="NULL", entity="language", src="funnel"))
    parts.append(row("crossqueue_agents", "'agent'", "total_calls", num="total_calls", queue="NULL",
                     entity="agent_name", src="agents"))
    parts.append(row("crossqueue_agents", "'agent'", "queue_calls", num="queue_calls", queue="q",
                     entity="agent_name", src="agents_long"))
    parts.append(row("crossqueue_callers", "'caller'", "total_calls", num="total_calls", queue="NULL",
                     entity="caller_number_norm", src="callers"))
    parts.append(row("crossqueue_callers", "'caller'", "queue_calls", num="queue_calls", queue="q",
                     entity="caller_number_norm", src="callers_long"))
    for m in ("calls", "no_answer_count", "no_answer_rate"):
        parts.append(row("crossqueue_same_hour_no_answer", "'hour'", m, num=m, entity=hl,
                         hour="CAST(hour AS VARCHAR)", src="hourly"))
    parts.append(row("crossqueue_same_day_volume", "'date'", "calls", num="calls", entity=d, date=d, src="daily"))
    parts.append(row("anomalies", "kind", "severity", text="severity", entity="target_json", details="description",
                     src="anomalies"))
    for m in ("raw_rows", "cleaned_calls", "duplicate_rows_removed"):
        parts.append(row("queue_summary", "'queue'", m, num=m, src="qv"))
    for m, txt in (("answered_no_agent_reconciled", "CAST(answered_no_agent_reconciled AS VARCHAR)"),
                   ("dedupe_key", "dedupe_key"), ("calculation_source", "calculation_source")):
        parts.append(row("queue_summary", "'queue'", m, text=txt, src="qv"))
        parts.append(row("report_validation", "'queue_validation'", m, text=txt, src="qv"))
    for m in ("raw_rows", "cleaned_calls", "duplicate_rows_removed", "answered_calls", "no_agent_calls",
              "answered_plus_no_agent"):
        parts.append(row("report_validation", "'queue_validation'", m, num=m, src="qv"))
    for m in ("raw_row_count", "cleaned_row_count", "duplicate_rows_removed", "answered_count", "no_agent_count",
              "answered_plus_no_agent"):
        parts.append(row("report_validation", "'validation'", m, num=m, queue="NULL", src="rv"))
    for m, txt in (("status", "status"),
                   ("answered_plus_no_agent_reconciles", "CAST(answered_plus_no_agent_reconciles AS VARCHAR)"),
                   ("date_range_used", "date_range_used"), ("timezone_used", "timezone_used"),
                   ("queues_included", "CAST(to_json(string_split(queues_included, ',')) AS VARCHAR)"),
                   ("dedupe_key_used", "dedupe_key_used"), ("calculation_source_used", "calculation_source_used")):
        parts.append(row("report_validation", "'validation'", m, text=txt, queue="NULL", src="rv"))
    parts.append(row("source_gaps", "'source_gap'", "message", text="'No CSV found for queue ' || queue_id || ' in events'",
                     src="gaps"))
    unpivot = lambda src, key: " UNION ALL ".join(
        f"SELECT {key}, '{q}' AS q, \"{q}\" AS queue_calls FROM {src}" for q in ids)
    ctes = (HEADLINE_SQL + FUNNEL_SQL + RULE_INPUTS + ANOMALIES_CTE + GAPS_CTE + DOW_AVG_CTE + TOP_CALLERS_CTE + f""",
bq AS (SELECT queue_id, arg_max(date, calls * 100000 - (date - DATE '1970-01-01')) AS busiest_date, max(calls) AS busiest_calls,
  arg_min(date, calls * 100000 + (date - DATE '1970-01-01')) AS quietest_date, min(calls) AS quietest_calls
  FROM (SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY 1, 2) GROUP BY queue_id),
daily AS (SELECT queue_id, date, count(*) AS calls FROM curated GROUP BY 1, 2),
weekly AS (SELECT queue_id, CAST(date_trunc('week', date) AS DATE) AS week_start,
  CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, count(*) AS calls FROM curated GROUP BY 1, 2),
hourly_q AS ({HOURLY_SQL}),
reasons AS (
  SELECT queue_id, reason_type, {O.trim_ws('raw')} AS reason, count(*) AS calls
  FROM (SELECT queue_id, 'queue' AS reason_type, queue_release_reason AS raw FROM curated
        UNION ALL SELECT queue_id, 'agent', agent_release_reason FROM curated)
  WHERE raw IS NOT NULL AND {O.trim_ws('raw')} <> '' AND lower({O.trim_ws('raw')}) <> 'null' GROUP BY 1, 2, 3),
agents AS ({AGENTS_SQL}){qv_part},
rv AS ({rv_select}),
agents_long AS ({unpivot('agents', 'agent_name')}),
callers_long AS ({unpivot('callers', 'caller_number_norm')}),
rows AS ({' UNION ALL '.join(parts)})""")
    return O.with_curated(ctes + f"""
SELECT 'month' AS period, '{O.PERIOD_START}' AS date_start, '{O.PERIOD_END}' AS date_end, r.section,
  coalesce(r.qid, '') AS queue_id, coalesce(d.queue_name, '') AS queue_name, coalesce(d.language, '') AS language,
  coalesce(d.role, '') AS role, r.entity_type, coalesce(r.entity, '') AS entity, r.date, r.hour, r.dow, r.metric,
  coalesce(r.value_text, CASE WHEN r.value_num = floor(r.value_num) THEN CAST(CAST(r.value_num AS BIGINT) AS VARCHAR)
    ELSE CAST(r.value_num AS VARCHAR) END, '') AS value, r.details
FROM rows r LEFT JOIN {O.DIM} d ON d.queue_id = r.qid""")


def long_export_tables(spark, sf_dir):
    """The metric tables of the long export of one CSV period run."""
    from callgrid.operators.cross import consolidated_agents
    cur, cube, dim, head, funnel, anomalies, gaps = _parts(spark, sf_dir)
    ids = ctx.QUEUE_IDS
    agents = consolidated_agents(cur, ids)
    callers = X.consolidated_callers(cur, ids)
    busiest = C.busiest_quietest_day(cube).withColumnsRenamed(
        {"busiest_calls": "busiest_day_calls", "quietest_calls": "quietest_day_calls"})
    tables = {
        "headline": head, "busiest": busiest, "daily": C.daily_volume(cube), "weekly": C.weekly_volume(cube),
        "hourly": C.hourly_volume(cube), "dow_avg": R.dow_average(C.dow_volume(cube), spark, ctx.PERIOD_START,
                                                                   ctx.PERIOD_END),
        "reasons": M.release_reasons(cur), "leaderboard": M.agent_leaderboard(cur), "top_callers": M.top_callers(cur),
        "funnel": funnel, "agents": agents, "agents_long": R.pivot_to_long(agents, "agent_name", ids),
        "callers": callers, "callers_long": R.pivot_to_long(callers, "caller_number_norm", ids),
        "same_hour": C.hourly_volume(cube, with_avg=False), "same_day": C.daily_volume(cube),
        "anomalies": anomalies, "gaps": gaps,
    }
    filtered = filter_period_csv(ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END)
    tables["qv"] = V.queue_validation(filtered, cur, dim)
    tables["rv"] = V.run_validation(tables["qv"], ctx.PERIOD_START, ctx.PERIOD_END, "America/Toronto")
    return tables, dim


@register("long_export", _long_sql())
def long_export(spark, sf_dir):
    """U-3 / F-26: the long-format export (one row per section, entity and metric) with its values as text."""
    tables, dim = long_export_tables(spark, sf_dir)
    rows = R.long_export(tables, dim, "month", ctx.PERIOD_START, ctx.PERIOD_END)
    return rows.withColumn("value", export_text(F.col("value")))


@register("export_file", _long_sql())
def export_file(spark, sf_dir):
    """SNK-11 / SNK-12: the long export written as one CSV file under its name, and that file read back."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    path = write_csv_file(long_export(spark, sf_dir), root, ctx.PERIOD_START, ctx.PERIOD_END, R.EXPORT_COLUMNS, ("section", "queue_id", "entity"))
    back = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return back.fillna("")


@register("inventory_document", f"SELECT '{O.PERIOD_START}' AS start, '{O.PERIOD_END}' AS \"end\", (SELECT count(*) FROM (" + FIELD_INVENTORY_SQL
          + ")) AS field_count, path AS field, 'success' AS status FROM (" + FIELD_INVENTORY_SQL + ")")
def inventory_document(spark, sf_dir):
    """SNK-10 / F-13: the field inventory written as one JSON document under its name, and each field read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/inventory-{uuid.uuid4().hex}/field_inventory_{ctx.PERIOD_START}_{ctx.PERIOD_END}.json"
    write_inventory_document(field_inventory(api_records_from_tables(spark, sf_dir)), path, ctx.PERIOD_START, ctx.PERIOD_END)
    doc = spark.read.schema("date_range struct<start string, end string>, field_count long, fields array<string>, validation struct<status string>").json(path)
    return doc.select("date_range.start", "date_range.end", "field_count", F.explode("fields").alias("field"), "validation.status")


@register("csv_roundtrip", O.with_curated(f"SELECT {CURATED_SELECT} FROM curated").replace(
    "queue_release_reason, handled_flag FROM curated", "nullif(queue_release_reason, '') AS queue_release_reason, handled_flag FROM curated"),
    dates=("date",))
def csv_roundtrip(spark, sf_dir):
    """S-1, S-2, U-1, P-4: the legs written as one export a queue, found by name, read by one scan and curated.
    A CSV file does not tell an empty field from a missing one: both are null."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports-{uuid.uuid4().hex}"
    write_queue_exports(ctx.legs(spark, sf_dir), root, "2024-01")
    legs, gaps = load_csv_legs(spark, root, multiline=False)
    if gaps:
        raise ValueError(f"no export of {[g['queue_id'] for g in gaps]}")
    return csv_pipeline(legs, ctx.PERIOD_START, ctx.PERIOD_END).drop("is_handled")


def _callers_sql() -> str:
    from callgrid.plans.q_cross import CALLERS_SQL
    return O.with_curated(f", c AS ({CALLERS_SQL})\nSELECT caller_number_norm, total_calls, CAST((SELECT count(*) FROM c) AS BIGINT) AS listed FROM c")


@register("report_callers", _callers_sql())
def report_callers(spark, sf_dir):
    """SNK-2: every caller of the period, read from the part files that the list's directory names, next to its count."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/callers-{uuid.uuid4().hex}"
    callers = X.consolidated_callers(ctx.curated(spark, sf_dir), ctx.QUEUE_IDS)
    directory = write_ordered_parts(callers, folder, [F.desc("total_calls"), F.asc("caller_number_norm")], "caller_number_norm")
    listed = directory.agg(F.sum("rows").alias("listed"))
    found = read_parts(spark, folder, directory, callers.schema).select("caller_number_norm", "total_calls")
    return found.withColumn("listed", listed.scalar())


@register("rejected_rows", f"""WITH {O.LEGS.split('legs0 AS')[0].rstrip().rstrip(',')},
q AS (SELECT event_id AS leg_no, event_id, CASE WHEN k < 70 THEN (CASE WHEN user_id % 2 = 0 THEN '8020' ELSE '8021' END)
         ELSE (CASE WHEN user_id % 2 = 0 THEN '8030' ELSE '8031' END) END AS queue_id FROM ev)
SELECT leg_no, queue_id, 'orig_call_id' AS "column", ' ' AS value, 'missing_call_id' AS reason FROM q WHERE event_id % 7 = 3
UNION ALL SELECT leg_no, queue_id, 'call_time', 'soon', 'bad_call_time' FROM q WHERE event_id % 11 = 5
UNION ALL SELECT leg_no, queue_id, 'hold_time', 'a while', 'bad_duration' FROM q WHERE event_id % 5 = 1""")
def rejected_rows(spark, sf_dir):
    """Strict mode of P-10, F-2 and F-1: legs with damaged ids, times and durations, each value with its reason."""
    put = lambda c, n, left, bad: F.when(F.col("leg_no") % n == left, bad).otherwise(F.col(c))
    legs = ctx.legs(spark, sf_dir).withColumns({"orig_call_id": put("orig_call_id", 7, 3, " "), "call_time": put("call_time", 11, 5, "soon"),
                                                "hold_time": put("hold_time", 5, 1, "a while")})
    return V.rejected_legs(legs)


@register("period_replace_roundtrip", O.with_curated("""
SELECT '2024-01-01' AS period_start, queue_id, count(*) AS calls,
  count(*) FILTER (WHERE handled_flag = 'Handled') AS handled FROM curated GROUP BY queue_id"""))
def period_replace_roundtrip(spark, sf_dir):
    """SNK-5…SNK-7: curated calls and headline written as a new version under the shared
    checkpoint folder, published, and read back through the latest published run."""
    from callgrid.session import ensure_checkpoint_dir
    from callgrid.sinks.store import PeriodStore, new_run_id
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/callgrid-store/{new_run_id()}"
    store = PeriodStore(spark, root)
    cur = ctx.curated(spark, sf_dir)
    store.replace({"curated_calls": cur}, ctx.PERIOD_START, ctx.PERIOD_END, "csv")
    return store.read("curated_calls").groupBy("period_start", "queue_id").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("handled_flag") == "Handled").alias("handled"))


def _stored_sql() -> str:
    from callgrid.plans.q_cross import AGENTS_SQL, CALLERS_SQL
    from callgrid.plans.q_queue import TOP_CALLERS_CTE

    def one(name: str, body: str, total: str = "NULL") -> str:
        return f"SELECT '{name}' AS name, count(*) AS stored_rows, CAST({total} AS DOUBLE) AS json_total FROM ({body}) AS t"

    tables = [
        one("curated_calls", "SELECT * FROM curated"),
        one("raw_call_legs", "SELECT * FROM filtered", "count(DISTINCT orig_call_id)"),
        one("queue_dim", f"SELECT * FROM {O.DIM}"), one("queue_period_metrics", "SELECT * FROM headline", "sum(total_calls)"),
        one("queue_daily_metrics", _DAILY_SQL), one("queue_hourly_metrics", HOURLY_SQL),
        one("queue_dow_metrics", _LISTS_SQL["dow_volume"][0]), one("agent_queue_metrics", "SELECT * FROM leaderboard", "sum(calls)"),
        one("caller_queue_metrics", "SELECT * FROM topc"), one("release_reason_metrics", _REASONS_SQL),
        one("funnel_language_metrics", "SELECT language, count(*) FILTER (WHERE role = 'primary') AS n FROM curated GROUP BY 1", "sum(n)"),
        one("crossqueue_agent_metrics", AGENTS_SQL, "sum(total_calls)"), one("crossqueue_caller_metrics", CALLERS_SQL, "sum(total_calls)"),
        one("comparative_series", f"SELECT queue_id, calls FROM ({HOURLY_SQL}) UNION ALL SELECT queue_id, calls FROM ({_DAILY_SQL})", "sum(calls)"),
        one("anomalies", "SELECT * FROM anomalies", "sum(rule_order)"),
        "SELECT 'report_runs' AS name, 1 AS stored_rows, CAST((SELECT count(*) FROM filtered) AS DOUBLE) AS json_total",
    ]
    return O.with_curated(HEADLINE_SQL + RULE_INPUTS + ANOMALIES_CTE + TOP_CALLERS_CTE + "\n" + "\nUNION ALL ".join(tables))


# where each stored table keeps a number in its JSON
_JSON_NUMBERS = {"queue_period_metrics": ("metrics_json", "total_calls"), "agent_queue_metrics": ("metrics_json", "calls"),
                 "funnel_language_metrics": ("metrics_json", "primary_calls"), "crossqueue_agent_metrics": ("metrics_json", "total_calls"),
                 "crossqueue_caller_metrics": ("metrics_json", "total_calls"), "comparative_series": ("metrics_json", "calls"),
                 "anomalies": ("anomaly_json", "rule_order"), "report_runs": ("validation_json", "raw_row_count")}


@register("stored_period", _stored_sql())
def stored_period(spark, sf_dir):
    """SNK-4…SNK-9, F-17: all tables of a period run written, published and read back, each with its row count and
    the total of a number kept in its JSON (for raw legs, the distinct call ids in it)."""
    from callgrid.plans.run import run_csv_period
    from callgrid.session import ensure_checkpoint_dir
    from callgrid.sinks.store import PeriodStore, new_run_id
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/callgrid-store/{new_run_id()}"
    run_csv_period(spark, ctx.legs(spark, sf_dir), ctx.PERIOD_START, ctx.PERIOD_END, store_root=root)
    store = PeriodStore(spark, root)
    out = None
    for name in ("curated_calls", "raw_call_legs", "queue_dim", "queue_period_metrics", "queue_daily_metrics", "queue_hourly_metrics",
                 "queue_dow_metrics", "agent_queue_metrics", "caller_queue_metrics", "release_reason_metrics",
                 "funnel_language_metrics", "crossqueue_agent_metrics", "crossqueue_caller_metrics", "comparative_series", "anomalies", "report_runs"):
        total = F.lit(None).cast("double")
        if name in _JSON_NUMBERS:
            column, key = _JSON_NUMBERS[name]
            total = F.sum(F.get_json_object(column, f"$.{key}").cast("double"))
        elif name == "raw_call_legs":
            total = F.count_distinct(F.get_json_object("raw_json", "$.orig_call_id")).cast("double")
        row = store.read(name).agg(F.count(F.lit(1)).alias("stored_rows"), total.alias("json_total")).select(
            F.lit(name).alias("name"), "stored_rows", "json_total")
        out = row if out is None else out.unionByName(row)
    return out
