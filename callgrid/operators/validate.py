"""Reconciliation and data-quality tables: per-queue cleaning validation (A-14, J-5),
run totals (A-17), missing-source gaps (J-7) and conservation invariants (SURVEY §5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.functions.exprs import CSV_CALL_TIME_FORMAT, has_value, to_seconds, ws_trim
from callgrid.operators.curate import with_handled

# Labels the validation block carries.
CSV_CALCULATION_SOURCE = "csv_cleaned_queue_level_calls"
CSV_DEDUPE_KEY = "Orig CallID; keep last row after date filtering"
MISSING_CSV = "missing_csv"
# Reasons of rejected values (strict mode).
MISSING_KEY, BAD_TIME, BAD_DURATION, BAD_NUMBER = "missing_call_id", "bad_call_time", "bad_duration", "not_a_number"
REJECTED_MESSAGE = "{n} rows rejected in {column}"


def queue_validation(filtered_legs: DataFrame, curated: DataFrame, dim: DataFrame,
                     calculation_source: str = CSV_CALCULATION_SOURCE,
                     dedupe_key: str = CSV_DEDUPE_KEY) -> DataFrame:
    """A-14: raw rows after the period filter vs cleaned calls and their answered/no-agent split."""
    raw = filtered_legs.groupBy("queue_id").agg(F.count(F.lit(1)).alias("raw_rows"))
    cur = with_handled(curated).groupBy("queue_id").agg(
        F.count(F.lit(1)).alias("cleaned_calls"), F.count_if("is_handled").alias("answered_calls"))
    base = (F.broadcast(dim.select("queue_id")).join(raw, "queue_id", "left").join(cur, "queue_id", "left")
            .select("queue_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                                  for c in ("raw_rows", "cleaned_calls", "answered_calls")]))
    no_agent = F.col("cleaned_calls") - F.col("answered_calls")
    return base.select(
        "queue_id", "raw_rows", "cleaned_calls",
        (F.col("raw_rows") - F.col("cleaned_calls")).alias("duplicate_rows_removed"),
        "answered_calls", no_agent.alias("no_agent_calls"),
        (F.col("answered_calls") + no_agent).alias("answered_plus_no_agent"),
        ((F.col("answered_calls") + no_agent) == F.col("cleaned_calls")).alias("answered_no_agent_reconciled"),
        F.lit(dedupe_key).alias("dedupe_key"), F.lit(calculation_source).alias("calculation_source"),
    )


def run_validation(qv: DataFrame, start: str, end: str, timezone: str,
                   calculation_source: str = CSV_CALCULATION_SOURCE,
                   dedupe_key: str = CSV_DEDUPE_KEY) -> DataFrame:
    """A-17: one row of totals over the queue validation rows."""
    t = qv.agg(
        F.sum("raw_rows").cast("bigint").alias("raw_row_count"),
        F.sum("cleaned_calls").cast("bigint").alias("cleaned_row_count"),
        F.sum("answered_calls").cast("bigint").alias("answered_count"),
        F.sum("no_agent_calls").cast("bigint").alias("no_agent_count"),
        F.sort_array(F.collect_list("queue_id")).alias("_queues"),
    )
    both = F.col("answered_count") + F.col("no_agent_count")
    return t.select(
        F.lit("success").alias("status"), "raw_row_count", "cleaned_row_count",
        (F.col("raw_row_count") - F.col("cleaned_row_count")).alias("duplicate_rows_removed"),
        "answered_count", "no_agent_count", both.alias("answered_plus_no_agent"),
        (both == F.col("cleaned_row_count")).alias("answered_plus_no_agent_reconciles"),
        F.lit(f"{start} 00:00:00 through {end} 23:59:59").alias("date_range_used"),
        F.lit(timezone).alias("timezone_used"),
        F.array_join("_queues", ",").alias("queues_included"),
        F.lit(dedupe_key).alias("dedupe_key_used"),
        F.lit(calculation_source).alias("calculation_source_used"),
    )


def _rejects(checks: list[tuple[str, Column, Column, str]]) -> Column:
    """The failed ones of (column, value, whether it is bad, reason) as an array of structs."""
    found = F.array(*[F.when(bad, F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason")))
                      for name, value, bad, reason in checks])
    return F.filter(found, lambda x: x.isNotNull())


def rejected_legs(legs: DataFrame) -> DataFrame:
    """Strict mode of P-10, F-2 and F-1: (leg_no, queue_id, column, value, reason) of every value that a run cannot use. Row by row,
    no shuffle; the run itself takes such durations as missing, and fails on such keys and times."""
    key, time = F.col("orig_call_id"), F.col("call_time")
    checks = [("orig_call_id", key, key.isNull() | (ws_trim(key) == ""), MISSING_KEY),
              ("call_time", time, F.try_to_timestamp(time, F.lit(CSV_CALL_TIME_FORMAT)).isNull(), BAD_TIME)]
    checks += [(c, F.col(c), has_value(c) & to_seconds(c).isNull() & ~ws_trim(c).endswith("ms"), BAD_DURATION)
               for c in ("time_in_queue", "agent_time", "hold_time")]
    return legs.select("leg_no", "queue_id", F.inline(_rejects(checks)))


def rejected_stats(doc: DataFrame, column: str = "value") -> DataFrame:
    """Strict mode of F-14: (queue_id, column, value, reason) of statistics that are no number; null counts as 0."""
    from callgrid.operators.stats import STAT_FIELDS, STATS_JSON_SCHEMA
    rows = doc.select(F.explode(F.from_json(column, STATS_JSON_SCHEMA)).alias("queue_id", "s"))
    return rows.select("queue_id", F.inline(_rejects([
        (f, F.col("s")[f], F.col("s")[f].isNotNull() & F.col("s")[f].try_cast("double").isNull(), BAD_NUMBER) for f in STAT_FIELDS])))


def source_gaps(legs: DataFrame, dim: DataFrame, location: str) -> DataFrame:
    """J-7: configured queues without any source rows -> gap rows (anti join from the dimension)."""
    found = legs.select("queue_id").distinct()
    return (F.broadcast(dim.select("queue_id")).join(found, "queue_id", "left_anti")
            .select("queue_id", F.lit(MISSING_CSV).alias("reason"),
                    F.format_string("No CSV found for queue %s in %s", F.col("queue_id"), F.lit(location))
                    .alias("message")))


def invariants(cube: DataFrame, curated: DataFrame) -> DataFrame:
    """Conservation checks per queue: Σ daily = Σ hourly = Σ weekday = total; handled + no-agent = total."""
    c = with_handled(curated).groupBy("queue_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_handled").alias("handled"),
        F.count_if(~F.col("is_handled")).alias("no_agent"))
    k = cube.groupBy("queue_id").agg(
        F.sum(F.when(F.col("date").isNotNull(), F.col("rows"))).alias("sum_daily"),
        F.sum(F.when(F.col("hour").isNotNull(), F.col("ids"))).alias("sum_hourly"),
        F.sum(F.when(F.col("dow").isNotNull(), F.col("rows"))).alias("sum_dow"))
    j = c.join(k, "queue_id")
    return j.select("queue_id", "total", "sum_daily", "sum_hourly", "sum_dow",
                    ((F.col("sum_daily") == F.col("total")) & (F.col("sum_hourly") == F.col("total"))
                     & (F.col("sum_dow") == F.col("total"))
                     & (F.col("handled") + F.col("no_agent") == F.col("total"))).alias("holds"))
