"""Period filters (P-1, P-2) and the curated projection of CSV legs (P-12).

The CSV pipeline is ``filter period -> keep-last per (queue, call id) -> curate``
(T3: filter first). The parsed call time is computed once and carried through
the dedup so it is not parsed twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callgrid.functions import exprs as X
from callgrid.operators.dedup import dedup_csv
from callgrid.schemas import CURATED_COLUMNS

DateLike = str | dt.date | None


def _d(value: DateLike):
    return None if value is None else F.lit(str(value)).cast("date")


def with_call_datetime(legs: DataFrame, source: str = "call_time") -> DataFrame:
    """F-2 applied once: ``_call_dt`` (TIMESTAMP_NTZ), which the steps of the pipeline hand on to each other."""
    if "_call_dt" in legs.columns:
        return legs
    # exploded from one element: a filter on a plain expression would be moved below it and parse anew for each bound
    return legs.select("*", F.explode(F.array(X.parse_call_time(source))).alias("_call_dt"))


def filter_period_csv(legs: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """P-1: local call date within [start, end], open-ended where a bound is missing; a missing time is
    dropped, bad text fails the run."""
    return filter_period(with_call_datetime(legs), start, end, ts="_call_dt").filter(F.col("_call_dt").isNotNull())


def filter_period(df: DataFrame, start: DateLike = None, end: DateLike = None,
                  ts: str = "call_datetime") -> DataFrame:
    """P-2: date bound filter, open-ended when a bound is missing."""
    d = F.to_date(ts)
    if start is not None:
        df = df.filter(d >= _d(start))
    if end is not None:
        df = df.filter(d <= _d(end))
    return df


def curate_csv(legs: DataFrame) -> DataFrame:
    """P-12: one row per deduplicated leg in the 23-column curated layout + ``is_handled``."""
    legs = with_call_datetime(legs)
    ts = F.col("_call_dt")
    agent_sec = X.to_seconds("agent_time")
    out = legs.select(
        "queue_id", "queue_name", "language", "role",
        F.col("orig_call_id").cast("string").alias("call_id"),
        "call_time",
        ts.alias("call_datetime"),
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        X.day_name(ts).alias("dow"),
        "caller_name", "caller_number",
        X.normalize_caller("caller_number", "orig_call_id").alias("caller_number_norm"),
        "dnis", "agent_extension", "agent_phone", "agent_name",
        X.to_seconds("time_in_queue").alias("queue_sec"),
        agent_sec.alias("agent_sec"),
        X.to_seconds("hold_time").alias("hold_sec"),
        "agent_release_reason", "queue_release_reason",
    )
    handled = X.answered(out.columns)
    out = out.withColumn("is_handled", handled).withColumn(
        "handled_flag", F.when(F.col("is_handled"), F.lit(X.HANDLED)).otherwise(F.lit(X.NO_AGENT)))
    return out.select(*CURATED_COLUMNS, "is_handled")


def csv_pipeline(legs: DataFrame, start: DateLike, end: DateLike, *, check: bool = True) -> DataFrame:
    """Raw CSV legs -> curated calls for one period (P-1 -> W-1 -> P-12)."""
    return curate_csv(dedup_csv(filter_period_csv(legs, start, end), check=check))


def with_handled(curated: DataFrame) -> DataFrame:
    """Add the metrics' handled predicate once (P-8) if the frame lacks it."""
    if "is_handled" in curated.columns:
        return curated
    return curated.withColumn("is_handled", X.answered(curated.columns))
