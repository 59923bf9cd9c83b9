"""Cleaned-export ("sheet") variants: header detection (S-10), curated rows (S-11),
loose parsers (F-27), the variant metrics (A-25) and supplied-summary overrides (A-26).

Sheets are re-aimed at delimited text: every line is an array of cells with a line
number; the header is the first line holding all required headers of any group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrid.functions.exprs import ws_trim
from callgrid.operators.cross import funnel_measures, pivot_by_queue
from callgrid.operators.queue_metrics import MEASURES, value_statistics
from callgrid.schemas import Queue

BLANK_REASON = "(blank)"
UNKNOWN_CALLER = "Unknown"
RESTRICTED_CALLER = "Restricted"
SHEET_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "M/d/yyyy h:mm a")


# --- F-27 loose parsers -------------------------------------------------------------------

def sheet_text(col: str | Column) -> Column:
    """Trimmed text; blank and "null" -> null."""
    t = ws_trim(col)
    return F.when((t != "") & (F.lower(t) != "null"), t)


def sheet_seconds(col: str | Column) -> Column:
    """Numbers as they are, ``MM:SS`` / ``HH:MM:SS`` as seconds, anything else 0."""
    t = ws_trim(col)
    parts = F.filter(F.split(t, ":"), lambda p: p != "")
    n = F.size(parts)
    num = lambda i: F.get(parts, i).try_cast("bigint")
    as_number = t.try_cast("double")
    clock = (F.when((n == 2) & num(0).isNotNull() & num(1).isNotNull(), num(0) * 60 + num(1))
             .when((n == 3) & num(0).isNotNull() & num(1).isNotNull() & num(2).isNotNull(),
                   num(0) * 3600 + num(1) * 60 + num(2)))
    return F.coalesce(as_number, clock.cast("double"), F.lit(0.0))


def sheet_time(col: str | Column) -> Column:
    """First format that parses (ISO-like, then US with AM/PM)."""
    t = ws_trim(col)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in SHEET_FORMATS]).cast("timestamp_ntz")


def sheet_caller(col: str | Column) -> Column:
    """"Unknown" / "Restricted" buckets that do aggregate; else digits, else the text."""
    t = sheet_text(col)
    digits = F.regexp_replace(t, r"(?U)\D+", "")
    return (F.when(t.isNull(), F.lit(UNKNOWN_CALLER)).when(F.lower(t) == "restricted", F.lit(RESTRICTED_CALLER))
            .when(digits != "", digits).otherwise(t))


# --- S-10 header detection ---------------------------------------------------------------

def detect_header(lines: DataFrame, required_groups: Sequence[Sequence[str]], sheet: str = "sheet",
                  line_no: str = "line_no", cells: str = "cells") -> DataFrame:
    """Rows after each sheet's header line as ``(sheet, line_no, record map<header, value>)``.

    Duplicate headers get ``_1``, ``_2`` …; null headers are dropped; all-null rows are
    skipped. A sheet without a header row fails the job. There is one header row per sheet.
    """
    has_group = None
    for group in required_groups:
        cond = F.lit(True)
        for h in group:
            cond = cond & F.array_contains(F.col(cells), h)
        has_group = cond if has_group is None else (has_group | cond)
    hdr = (lines.filter(has_group).groupBy(sheet)
           .agg(F.min_by(F.struct(F.col(line_no).alias("h_line"), F.col(cells).alias("h_cells")), F.col(line_no))
                .alias("h"))
           .select(sheet, "h.h_line", "h.h_cells"))
    # unique header names: the n-th repeat of a name gets suffix _n
    pos = hdr.select(sheet, F.posexplode("h_cells").alias("i", "name"))
    w = Window.partitionBy(sheet, "name").orderBy("i")
    pos = pos.withColumn("k", F.row_number().over(w) - 1).withColumn(
        "uname", F.when(F.col("name").isNull(), F.lit(None))
        .when(F.col("k") == 0, F.col("name")).otherwise(F.concat("name", F.lit("_"), F.col("k").cast("string"))))
    names = pos.groupBy(sheet).agg(F.sort_array(F.collect_list(F.struct("i", "uname"))).alias("_n"))
    hdr = hdr.join(names, sheet).select(sheet, "h_line", F.transform("_n", lambda x: x["uname"]).alias("headers"))
    missing = F.raise_error(F.concat(F.lit("no header row in sheet "), F.col(sheet))).cast("boolean")
    body = lines.join(hdr, sheet, "left").filter(F.when(F.col("h_line").isNull(), missing)
                                                 .otherwise(F.col(line_no) > F.col("h_line")))
    body = body.filter(F.exists(F.col(cells), lambda x: x.isNotNull()))
    pairs = F.filter(F.arrays_zip(F.col("headers").alias("k"), F.col(cells).alias("v")), lambda e: e["k"].isNotNull())
    return body.select(sheet, line_no, F.map_from_entries(
        F.transform(pairs, lambda e: F.struct(e["k"], e["v"]))).alias("record"))


# --- S-11 curated rows from a cleaned export ---------------------------------------------

def sheet_curated(records: DataFrame, dim: DataFrame, queue: Queue | None = None) -> DataFrame:
    """Single-queue layout (``queue`` given) or all-queues layout (queue columns present,
    missing name/language/role filled from the dimension)."""
    r = F.col("record")
    g = lambda k: F.try_element_at(r, F.lit(k))
    if queue is not None:
        base = records.select(F.lit(queue.queue_id).alias("queue_id"), "record")
    else:
        base = records.select(g("Queue ID").try_cast("double").cast("bigint").cast("string").alias("queue_id"), "record")
    ts = F.coalesce(sheet_time(g("Call Datetime")), sheet_time(g("Call Time")))
    secs = lambda k: F.when(F.coalesce(sheet_seconds(g(f"{k} Seconds")), F.lit(0.0)) != 0,
                            sheet_seconds(g(f"{k} Seconds"))).otherwise(sheet_seconds(g(k)))
    out = base.join(F.broadcast(dim.select("queue_id", F.col("queue_name").alias("_qn"), F.col("language").alias("_lang"),
                                           F.col("role").alias("_role"))), "queue_id", "left").select(
        "queue_id",
        F.coalesce(sheet_text(g("Queue Name")), F.col("_qn")).alias("queue_name"),
        F.coalesce(sheet_text(g("Language")), F.col("_lang")).alias("language"),
        F.lower(F.coalesce(g("Queue Role"), F.col("_role"))).alias("role"),
        g("Orig CallID").alias("call_id"), ts.alias("call_datetime"), F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"), F.date_format(ts, "EEEE").alias("dow"),
        sheet_caller(g("Caller Number")).alias("caller_number_norm"),
        sheet_text(g("Agent Name")).alias("agent_name"), sheet_text(g("Agent Extension")).alias("agent_extension"),
        secs("Time in Queue").alias("queue_sec"), secs("Agent Time").alias("agent_sec"),
        secs("Hold Time").alias("hold_sec"),
        sheet_text(g("Queue Release Reason")).alias("queue_release_reason"),
        sheet_text(g("Agent Release Reason")).alias("agent_release_reason"))
    return out.withColumn("is_handled", F.col("agent_sec") > 0)


# --- A-25 variant metrics ----------------------------------------------------------------

def sheet_reasons(curated: DataFrame) -> DataFrame:
    """Blank reasons count as "(blank)"; calls desc, reason asc."""
    long = curated.select("queue_id", F.stack(F.lit(2), F.lit("queue"), F.col("queue_release_reason"),
                                              F.lit("agent"), F.col("agent_release_reason")).alias("reason_type", "r"))
    counted = long.groupBy("queue_id", "reason_type", F.coalesce("r", F.lit(BLANK_REASON)).alias("reason")).agg(
        F.count(F.lit(1)).alias("calls"))
    w = Window.partitionBy("queue_id", "reason_type").orderBy(F.desc("calls"), F.asc("reason"))
    return counted.withColumn("rank", F.row_number().over(w))


def sheet_top_callers(curated: DataFrame, k: int = 100) -> DataFrame:
    """Top ``k`` callers per queue, Unknown / Restricted included."""
    c = curated.groupBy("queue_id", "caller_number_norm").agg(F.count(F.lit(1)).alias("calls"))
    w = Window.partitionBy("queue_id").orderBy(F.desc("calls"), F.asc("caller_number_norm"))
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def sheet_leaderboard(curated: DataFrame) -> DataFrame:
    """Handled calls with a name; share = calls / all such calls of the queue. Exact medians from counted values."""
    h = curated.filter(F.col("is_handled") & F.col("agent_name").isNotNull())
    stats = value_statistics(h, ["queue_id", "agent_name"], "agent_sec", (0.5,))
    lb = stats.select("queue_id", "agent_name", F.col("count").alias("calls"), F.col("mean").alias("avg_sec"),
                      F.col("quantiles")[0].alias("median_sec"), F.col("sum").alias("total_sec"))
    return lb.withColumn("pct_of_answered", F.col("calls") / F.sum("calls").over(Window.partitionBy("queue_id")))


def sheet_distribution(curated: DataFrame, dim: DataFrame) -> DataFrame:
    """Statistics of every queue time, and of agent and hold times above 0; a row for each queue and measure."""
    def one(name: str, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(name).alias("measure"), F.col(name).alias("value")))

    cells = F.array(one("queue_sec", F.lit(True)), one("agent_sec", F.col("agent_sec") > 0), one("hold_sec", F.col("hold_sec") > 0))
    values = curated.select("queue_id", F.inline(F.array_compact(cells)))
    stats = value_statistics(values, ["queue_id", "measure"], "value", (0.25, 0.5, 0.75))
    grid = dim.select("queue_id", F.explode(F.array(*map(F.lit, MEASURES))).alias("measure"))
    at = lambda i, name: F.get("quantiles", F.lit(i)).alias(name)
    return grid.join(stats, ["queue_id", "measure"], "left").select(
        "queue_id", "measure", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min",
        at(0, "p25"), at(1, "median"), at(2, "p75"), "max")


def sheet_callers(curated: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Calls per caller pivoted by queue + total, Unknown / Restricted included."""
    return pivot_by_queue(curated.where(F.col("queue_id").isin(*ids)), "caller_number_norm", ids)


def supplied_override(computed: DataFrame, supplied: DataFrame | None, unit: Sequence[str] = ("queue_id",)) -> DataFrame:
    """A-26: the supplied summary rows replace the computed ones of each ``unit`` (a queue; for reasons a queue and
    reason type) that has any supplied row; the others keep the computed rows."""
    if supplied is None:
        return computed
    kept = computed.join(supplied.select(*unit).distinct(), list(unit), "left_anti")
    return kept.unionByName(supplied.select(*computed.columns))


def sheet_funnel(cube: DataFrame) -> DataFrame:
    """The sheet funnel: always "available" (lost = overflow failed) even without overflow calls."""
    prim, ovf = F.col("role") == "primary", F.col("role") == "overflow"
    base = cube.groupBy("language").agg(
        F.sum(F.when(prim, F.col("rows")).otherwise(0)).alias("primary_calls"),
        F.sum(F.when(prim, F.col("handled")).otherwise(0)).alias("primary_answered"),
        F.sum(F.when(ovf, F.col("rows")).otherwise(0)).alias("overflow_received"),
        F.sum(F.when(ovf, F.col("handled")).otherwise(0)).alias("overflow_answered"))
    f = funnel_measures(base, ["language"])
    of = F.col("overflow_received") - F.col("overflow_answered")
    return f.withColumns({"lost": of, "lost_rate": F.coalesce(F.try_divide(of, F.col("primary_calls")), F.lit(0.0)),
                          "effective_answer_rate": F.when(F.col("primary_calls") != 0, F.lit(1.0) - F.try_divide(
                              of, F.col("primary_calls"))).otherwise(F.lit(0.0)),
                          "final_dropped_available": F.lit(True), "final_dropped_calls": of,
                          "drop_definition": F.lit("final_dropped_after_overflow")})


def consolidated_from_leaderboards(leaderboard: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Agents pivoted by queue from the per-queue leaderboards (not from call rows)."""
    p = leaderboard.groupBy("agent_name").pivot("queue_id", list(ids)).agg(F.sum("calls")).na.fill(0, subset=list(ids))
    return p.withColumn("total_calls", sum((F.col(f"`{q}`") for q in ids), F.lit(0)).cast("bigint"))
