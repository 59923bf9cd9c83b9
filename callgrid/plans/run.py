"""Period runs: raw sources -> curated calls -> every metric table -> versioned store.

``run_csv_period`` mirrors the CSV entry point (filter, then keep-last per queue + call);
``run_api_period`` the API entry point (keep-last per call, then filter). Both build one
lazy DAG; the curated calls are written once to the cluster's shared folder because a dozen
aggregates read them, each only its columns, and executors lost mid-run then recompute from
that table rather than from raw files.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.operators import anomaly as N
from callgrid.operators import cross as X
from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators import report as R
from callgrid.operators import stats as S
from callgrid.operators import validate as V
from callgrid.operators.api_curate import DEFAULT_TIMEZONE, api_pipeline
from callgrid.operators.curate import curate_csv, filter_period_csv
from callgrid.operators.dedup import dedup_csv
from callgrid.schemas import DEFAULT_QUEUES, Queue, queue_dim, queue_ids
from callgrid.session import materialize
from callgrid.sinks.export import bundle_folder, write_ordered_parts, write_report_bundle
from callgrid.sinks.store import PeriodStore, canonical_json, raw_legs_table, raw_records_table


@dataclass
class PeriodResult:
    run_id: str | None
    tables: dict[str, DataFrame]
    gaps: list[dict]


def metric_tables(spark: SparkSession, curated: DataFrame, queues: tuple[Queue, ...],
                  caller_threshold: int = N.CALLER_THRESHOLD, counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every stored metric table of a period from its curated calls (SNK-8/SNK-9 layout).

    ``counts`` are validation counts a queue (J-5), which the queue documents then carry.
    """
    def with_json(df: DataFrame, name: str = "metrics_json") -> DataFrame:
        return df.withColumn(name, canonical_json(*df.columns))

    dim = queue_dim(spark, queues)
    ids = queue_ids(queues)
    cube = materialize(C.calls_cube(curated), "cube")  # queues x days x 24 rows at most, read by a dozen tables
    hourly = C.hourly_volume(cube)
    daily = C.daily_volume(cube)
    lb = M.agent_leaderboard(curated)
    callers = X.consolidated_callers(curated, ids)
    agents = X.consolidated_agents(curated, ids)
    funnel = X.language_funnel(cube, dim)
    top = M.top_callers(curated)
    anomalies = N.all_anomalies(lb, hourly, callers, caller_threshold)
    return {
        "queue_dim": dim.drop("queue_pos"),
        "queue_period_metrics": R.queue_documents(curated, cube, dim, counts)
        .withColumnRenamed("document", "metrics_json"),
        "queue_daily_metrics": daily,
        "queue_hourly_metrics": hourly,
        "queue_dow_metrics": C.dow_volume(cube),
        "agent_queue_metrics": with_json(lb.drop("rank")),
        "caller_queue_metrics": top,
        "release_reason_metrics": M.release_reasons(curated),
        "funnel_language_metrics": funnel.select("language", canonical_json(
            *[c for c in funnel.columns if c != "language"]).alias("metrics_json")),
        "crossqueue_agent_metrics": with_json(agents).select("agent_name", "total_calls", "metrics_json"),
        "crossqueue_caller_metrics": with_json(callers).select("caller_number_norm", "total_calls", "metrics_json"),
        "comparative_series": with_json(R.comparative_series(C.hourly_volume(cube, with_avg=False), daily)),
        "anomalies": with_json(anomalies, "anomaly_json"),
    }


def _gap_result(spark: SparkSession, gaps: list[dict], start: str, end: str, mode: str,
                store_root: str | None, tables: dict[str, DataFrame] | None = None) -> PeriodResult:
    """Write the gap report; what was published for the period before stays visible."""
    if store_root:
        PeriodStore(spark, store_root).report_gaps(gaps, start, end, mode)
    return PeriodResult(None, tables or {}, gaps)


def run_csv_period(spark: SparkSession, legs: DataFrame, start: str, end: str, store_root: str | None = None,
                   queues: tuple[Queue, ...] = DEFAULT_QUEUES, timezone: str = DEFAULT_TIMEZONE,
                   gaps: list[dict] | None = None, report_root: str | None = None, period: str = "month",
                   strict: bool = False) -> PeriodResult:
    """CSV entry point: period filter -> keep-last per (queue, call) -> curate -> metrics -> store.

    With ``report_root`` the report bundle (SNK-2) is written as well. With ``strict`` every leg is checked first: legs with
    a blank call id or a bad time or duration are gathered with their reasons, and the run ends without publishing.
    """
    gaps = gaps or []
    if strict and not gaps:
        bad = materialize(V.rejected_legs(legs), "rejected")
        gaps = [{"queue_id": r.queue_id, "reason": r.reason, "message": V.REJECTED_MESSAGE.format(n=r.n, column=r.column)}
                for r in bad.groupBy("queue_id", "column", "reason").agg(F.count(F.lit(1)).alias("n")).orderBy("queue_id", "column").collect()]
        if gaps:
            return _gap_result(spark, gaps, start, end, "csv", store_root, {"rejected_rows": bad})
    if gaps:  # J-7: any missing queue stops the run; the gap report is the result
        return _gap_result(spark, gaps, start, end, "csv", store_root)
    filtered = filter_period_csv(legs, start, end)
    curated = materialize(curate_csv(dedup_csv(filtered)), "curated-calls")
    dim = queue_dim(spark, queues)
    qv = V.queue_validation(filtered, curated, dim)
    tables = metric_tables(spark, curated, queues, counts=qv)
    rv = V.run_validation(qv, start, end, timezone)
    tables["curated_calls"] = curated
    tables["raw_call_legs"] = raw_legs_table(filtered.drop("_call_dt"), "csv")
    run_id = None
    if store_root:
        validation = rv.select(F.to_json(F.struct("*"))).first()[0]
        run_id = PeriodStore(spark, store_root).replace(tables, start, end, "csv", "success", validation, period=period)
    tables["queue_validation"], tables["run_validation"] = qv, rv
    if report_root:
        cube = C.calls_cube(curated)
        ids = queue_ids(queues)
        callers = X.consolidated_callers(curated, ids)
        no_gaps = dim.filter(F.lit(False)).select("queue_id", F.lit("").alias("reason"), F.lit("").alias("message"))
        parts = write_ordered_parts(callers, f"{bundle_folder(report_root, period, start, end)}/callers",
                                    [F.desc("total_calls"), F.asc("caller_number_norm")], "caller_number_norm")
        docs = tables["queue_period_metrics"].withColumnRenamed("metrics_json", "document")
        document = R.period_document(
            docs, X.language_funnel(cube, dim), X.consolidated_agents(curated, ids), callers,
            C.hourly_volume(cube, with_avg=False), C.daily_volume(cube), tables["anomalies"], no_gaps, rv, period, start, end,
            dt.datetime.now(dt.timezone.utc).isoformat(), parts)
        write_report_bundle(document, docs, report_root, period, start, end)
    return PeriodResult(run_id, tables, [])


def run_api_period(spark: SparkSession, records: DataFrame, stats_doc: DataFrame | None, start: str, end: str,
                   store_root: str | None = None, queues: tuple[Queue, ...] = DEFAULT_QUEUES,
                   timezone: str = DEFAULT_TIMEZONE, inventory_root: str | None = None, period: str = "month") -> PeriodResult:
    """API entry point: keep-last per call -> period filter -> resolve queues -> curate -> metrics -> store.

    With ``inventory_root`` the field inventory (F-13) is also written as a dated and a
    latest document (SNK-10).
    """
    from callgrid.operators.api_curate import (MISSING_API_FIELDS, MISSING_FIELDS_MESSAGE, UNMAPPED_MESSAGE,
                                               UNMAPPED_QUEUE, field_presence)
    presence = field_presence(records)
    if presence.missing:  # P-11: a required field absent from every record is a source gap
        gap = {"queue_id": "all", "reason": MISSING_API_FIELDS,
               "message": MISSING_FIELDS_MESSAGE.format(fields=", ".join(presence.missing))}
        return _gap_result(spark, [gap], start, end, "api", store_root)
    curated, _, counts = api_pipeline(records, queues, timezone, start, end, presence)
    curated = materialize(curated, "curated-calls")
    dim = queue_dim(spark, queues)
    tables = metric_tables(spark, curated, queues)
    tables["curated_calls"] = curated
    tables["raw_call_legs"] = raw_records_table(records)
    # the status is settled before anything is published: one action, its row kept for all uses below
    counted = counts.first()
    if inventory_root:
        from callgrid.operators.flatten import field_inventory
        from callgrid.sinks.export import write_inventory_document
        inventory = materialize(field_inventory(records), "inventory")
        for name in (f"field_inventory_{start}_{end}.json", "field_inventory_latest.json"):
            write_inventory_document(inventory, f"{inventory_root.rstrip('/')}/{name}", start, end, counted.asDict())
    counts = spark.createDataFrame([counted])
    tables["api_counts"] = counts
    if stats_doc is not None:
        stats = S.parse_stats(stats_doc)
        tables["api_stats_diagnostics"] = S.stats_diagnostics(stats, dim)
        tables["api_stats_funnel"] = S.stats_funnel(stats, dim)
    if counted["status"] == "source_gap":  # P-18: rows were ignored and nothing could be curated
        gap = {"queue_id": "all", "reason": UNMAPPED_QUEUE,
               "message": UNMAPPED_MESSAGE.format(n=counted["ignored_unmapped_queue_rows"])}
        return _gap_result(spark, [gap], start, end, "api", store_root, tables)
    run_id = None
    if store_root:
        validation = json.dumps(counted.asDict(), sort_keys=True)
        stored = {k: v for k, v in tables.items() if k != "api_counts"}
        run_id = PeriodStore(spark, store_root).replace(stored, start, end, "api", counted["status"], validation, period=period)
    return PeriodResult(run_id, tables, [])


def run_api_from_extract(spark: SparkSession, landing_root: str, start: str, end: str,
                         fetch_records: "callable | None" = None, mode: str = "auto",
                         store_root: str | None = None, queues: tuple[Queue, ...] = DEFAULT_QUEUES,
                         timezone: str = DEFAULT_TIMEZONE, period: str = "month",
                         inventory_root: str | None = None) -> PeriodResult:
    """S-6 + SNK-1 + S-3: reuse a complete landed snapshot of the period, or land a new one
    from ``fetch_records()`` -> ``(records_json, stats_doc)``, then run the API period."""
    from callgrid.sinks.landing import choose_extract, land_extract, snapshot_path
    from callgrid.sources.api_records import read_records, read_stats_document
    if choose_extract(spark, landing_root, start, end, mode) == "land":
        if fetch_records is None:
            raise ValueError("no complete extract for the period and nothing to land it from")
        recs, stats = fetch_records()
        land_extract(recs, stats, landing_root, period, start, end)
    path = snapshot_path(spark, landing_root, start, end)
    return run_api_period(spark, read_records(spark, f"{path}/records"), read_stats_document(spark, f"{path}/stats"),
                          start, end, store_root, queues, timezone, inventory_root, period)
