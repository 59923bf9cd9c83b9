"""Landed API extracts (SNK-1) and their completeness gate (S-4) and reuse policy (S-6).

Every landing writes a snapshot folder of its own below the period's folder. It holds
``records/`` (JSON Lines), ``stats/`` (one JSON object keyed by queue id) and
``manifest/``, written **last**. Readers take the newest snapshot whose manifest says
complete, so a landing that fails half-way leaves the one before it in use, untouched.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrid.sinks.store import path_exists


def period_path(root: str, start: str, end: str) -> str:
    return f"{root.rstrip('/')}/api_extracts/{start}_{end}"


def snapshot_path(spark: SparkSession, root: str, start: str, end: str) -> str | None:
    """The newest complete snapshot of a period, None without one (a listing and one small file each)."""
    base = period_path(root, start, end)
    if not path_exists(spark, base):
        return None
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
    for name in sorted((n for n in names if n.startswith("snapshot=")), reverse=True):
        if _complete(spark, f"{base}/{name}"):
            return f"{base}/{name}"
    return None


def land_extract(records_json: DataFrame, stats_doc: DataFrame, root: str, period: str, start: str,
                 end: str, order_by: str | None = None) -> str:
    """SNK-1: ``records_json`` has a ``value`` column of JSON text; the manifest goes last. Returns the new snapshot.

    ``order_by`` keeps the source's record order in the files (range-partitioned sort), so
    the file-order tie-break of keep-last sees the records as the source sent them.
    """
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    path = f"{period_path(root, start, end)}/snapshot={stamp}-{uuid.uuid4().hex[:8]}"
    recs = records_json.orderBy(order_by) if order_by else records_json
    recs.select("value").write.text(f"{path}/records")
    stats_doc.select("value").coalesce(1).write.text(f"{path}/stats")
    spark = records_json.sparkSession
    counts = spark.read.text(f"{path}/records").agg(F.count(F.lit(1)).alias("record_count"))
    # the statistics are one small document: its keys are the queues
    keys = spark.read.text(f"{path}/stats").select(F.json_object_keys("value").alias("k")).where("k IS NOT NULL").first()
    queues = sorted(keys["k"]) if keys else []
    manifest = counts.select(F.to_json(F.struct(
        F.lit("complete").alias("status"), F.lit(period).alias("period"), F.lit(start).alias("start"),
        F.lit(end).alias("end"), F.col("record_count"), F.lit(len(queues)).alias("queue_stats_count"),
        F.array(*map(F.lit, queues)).cast("array<string>").alias("queues_included"), F.lit("records").alias("records_path"),
        F.lit("stats").alias("stats_path"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
        .alias("created_at"))).alias("value"))
    manifest.coalesce(1).write.text(f"{path}/manifest")
    return path


def _complete(spark: SparkSession, path: str) -> bool:
    if not all(path_exists(spark, f"{path}/{part}/_SUCCESS") or path_exists(spark, f"{path}/{part}")
               for part in ("manifest", "records", "stats")):
        return False
    m = spark.read.text(f"{path}/manifest").select(F.get_json_object("value", "$.status").alias("status")).first()
    return m is not None and m["status"] == "complete"


def extract_complete(spark: SparkSession, root: str, start: str, end: str) -> bool:
    """S-4: a snapshot of the period has a manifest that parses and says complete, and both data parts."""
    return snapshot_path(spark, root, start, end) is not None


def choose_extract(spark: SparkSession, root: str, start: str, end: str, mode: str = "auto") -> str:
    """S-6: ``reuse`` requires a complete snapshot, ``refresh`` always re-lands, ``auto``
    reuses when complete. Returns "reuse" or "land"."""
    if mode not in {"auto", "refresh", "reuse"}:
        raise ValueError("api cache mode must be one of: auto, refresh, reuse")
    complete = extract_complete(spark, root, start, end)
    if mode == "reuse" and not complete:
        raise FileNotFoundError(f"No complete API extract for {start}..{end}")
    if mode == "refresh":
        return "land"
    return "reuse" if complete else "land"
