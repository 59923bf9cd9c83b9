"""Versioned, all-or-nothing period tables on plain Parquet (SNK-4…SNK-9, T20).

Layout under ``root`` (a shared, cluster-visible folder)::

    <table>/period_start=…/period_end=…/version=<run_id>/part-*.parquet
    _runs/…                         one row per published run (the publish point)

A run writes every table into a fresh ``version=<run_id>`` directory it has never
touched, then appends its run row last. Readers join each table with the latest
published run per period (a broadcast of one row per period), so:

* an empty replacement publishes an empty version and the period reads empty;
* a run that fails before publishing leaves the previous version visible;
* re-running a period is idempotent (a new version with identical content).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, TimestampNTZType

from callgrid.schemas import TABLE_SCHEMAS, conform

RUNS = "_runs"
GAPS = "_gaps"
RUN_SCHEMA = StructType([
    StructField("period_start", StringType()), StructField("period_end", StringType()),
    StructField("run_id", StringType()), StructField("period", StringType()), StructField("source_mode", StringType()),
    StructField("status", StringType()), StructField("validation_json", StringType()),
    StructField("published_at", TimestampNTZType()),
])


def new_run_id() -> str:
    return uuid.uuid4().hex


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class PeriodStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _dir(self, table: str, start: str, end: str, run_id: str) -> str:
        return f"{self.root}/{table}/period_start={start}/period_end={end}/version={run_id}"

    def write(self, table: str, df: DataFrame, start: str, end: str, run_id: str) -> str:
        """SNK-5/6: conform to the table schema (P-14) and write a new, never-touched version."""
        schema = TABLE_SCHEMAS.get(table)
        data = df
        if schema is not None:
            body = StructType([f for f in schema.fields if f.name not in ("period_start", "period_end")])
            data = conform(df, body)
        path = self._dir(table, start, end, run_id)
        data.write.mode("errorifexists").parquet(path)
        return path

    def publish(self, start: str, end: str, run_id: str, source_mode: str, status: str = "success",
                validation_json: str = "{}", period: str = "month") -> None:
        """SNK-7: append the run row; this single write makes all tables of the run visible."""
        row = self.spark.createDataFrame(
            [(start, end, run_id, period, source_mode, status, validation_json)],
            "period_start string, period_end string, run_id string, period string, source_mode string, status string, "
            "validation_json string").withColumn("published_at", F.localtimestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/{RUNS}")

    def replace(self, tables: dict[str, DataFrame], start: str, end: str, source_mode: str,
                status: str = "success", validation_json: str = "{}", run_id: str | None = None,
                period: str = "month") -> str:
        """Write every table of a run and its ``report_runs`` row, then publish it (all-or-nothing)."""
        run_id = run_id or new_run_id()
        for name, df in tables.items():
            self.write(name, df, start, end, run_id)
        row = self.spark.createDataFrame([(period, source_mode, status, validation_json)],
                                         "period string, source_mode string, status string, validation_json string")
        self.write("report_runs", row.withColumn("generated_at", F.localtimestamp()).coalesce(1), start, end, run_id)
        self.publish(start, end, run_id, source_mode, status, validation_json, period)
        return run_id

    def runs(self) -> DataFrame:
        path = f"{self.root}/{RUNS}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(path)

    def latest_runs(self) -> DataFrame:
        """The newest successful run per period; runs that found a source gap never replace one."""
        w = Window.partitionBy("period_start", "period_end").orderBy(F.desc("published_at"), F.desc("run_id"))
        good = self.runs().filter(F.col("status") == "success")
        return good.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")

    def report_gaps(self, gaps: list[dict], start: str, end: str, source_mode: str) -> str:
        """J-7: append the gap report of a run that could not be made; tables and their versions stay as they are."""
        run_id = new_run_id()
        rows = [(start, end, run_id, source_mode, g["queue_id"], g["reason"], g["message"]) for g in gaps]
        self.spark.createDataFrame(
            rows, "period_start string, period_end string, run_id string, source_mode string, queue_id string, "
            "reason string, message string").coalesce(1).write.mode("append").json(f"{self.root}/{GAPS}")
        return run_id

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """Rows of the latest published version of every period (partition-pruned)."""
        schema = schema or TABLE_SCHEMAS[table]
        body = [f for f in schema.fields if f.name not in ("period_start", "period_end")]
        full = StructType(body + [StructField("period_start", StringType()), StructField("period_end", StringType()),
                                  StructField("version", StringType())])
        path = f"{self.root}/{table}"
        latest = self.latest_runs().select("period_start", "period_end", F.col("run_id").alias("version"))
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], full).drop("version")
        data = self.spark.read.schema(full).option("basePath", path).parquet(path)
        return data.join(latest, ["period_start", "period_end", "version"]).drop("version")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def retire_versions(store: "PeriodStore", table: str) -> list[str]:
    """Delete every version directory of ``table`` except the latest published one per period
    (metadata-only file-system calls on the driver; nothing is read). Call after publishing:
    the visible version is never touched, so readers never see a gap."""
    latest = {(r.period_start, r.period_end): r.run_id for r in store.latest_runs().collect()}
    fs, root = _fs(store.spark, f"{store.root}/{table}")
    removed: list[str] = []
    if not fs.exists(root):
        return removed
    for ps in fs.listStatus(root):
        if not ps.isDirectory() or not ps.getPath().getName().startswith("period_start="):
            continue
        start = ps.getPath().getName().split("=", 1)[1]
        for pe in fs.listStatus(ps.getPath()):
            if not pe.getPath().getName().startswith("period_end="):
                continue
            end = pe.getPath().getName().split("=", 1)[1]
            keep = latest.get((start, end))
            if keep is None:
                continue  # never published: may be a run in progress
            for v in fs.listStatus(pe.getPath()):
                name = v.getPath().getName()
                if name.startswith("version=") and name.split("=", 1)[1] != keep:
                    fs.delete(v.getPath(), True)
                    removed.append(v.getPath().toString())
    return removed


def canonical_json(*names: str) -> Column:
    """F-17: a JSON object of the named columns, keys sorted, nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(names)]), {"ignoreNullFields": "false"})


def raw_legs_table(legs: DataFrame, source_mode: str) -> DataFrame:
    """SNK-5: raw legs kept as canonical JSON (keys sorted, nulls kept)."""
    return legs.select(
        F.lit(source_mode).alias("source_mode"), F.col("queue_id").cast("string").alias("queue_id"),
        F.col("orig_call_id").cast("string").alias("call_id"), F.col("source_file").cast("string").alias("source_file"),
        canonical_json(*legs.columns).alias("raw_json"))


def raw_records_table(records: DataFrame) -> DataFrame:
    """SNK-5: landed API records ``(rec_no, rec)`` kept as their JSON text (VARIANT keeps keys sorted)."""
    return records.select(
        F.lit("api").alias("source_mode"), F.try_variant_get("rec", "$.call_queue.id", "string").alias("queue_id"),
        F.try_variant_get("rec", "$.from.call_id", "string").alias("call_id"), F.lit("api_records").alias("source_file"),
        F.to_json("rec").alias("raw_json"))
