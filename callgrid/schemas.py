"""Schemas: queue dimension (D1), raw legs, curated calls (D5) and the stored tables (SNK-8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)


@dataclass(frozen=True)
class Queue:
    queue_id: str
    name: str
    language: str
    role: str  # "primary" | "overflow"


# The default queue dimension (ids can be overridden by the caller).
DEFAULT_QUEUES = (
    Queue("8020", "CSR English", "English", "primary"),
    Queue("8021", "CSR French", "French", "primary"),
    Queue("8030", "CSR Overflow English", "English", "overflow"),
    Queue("8031", "CSR Overflow French", "French", "overflow"),
)

QUEUE_DIM_SCHEMA = StructType([
    StructField("queue_id", StringType(), False),
    StructField("queue_name", StringType(), False),
    StructField("language", StringType(), False),
    StructField("role", StringType(), False),
    StructField("queue_pos", IntegerType(), False),
])


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def queue_dim(spark: SparkSession, queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> DataFrame:
    """S-7: the queue dimension as a JVM-side local relation (no Python scan); it is
    bounded by configuration, so it is always broadcast-safe."""
    rows = ", ".join(f"({_sql_text(q.queue_id)}, {_sql_text(q.name)}, {_sql_text(q.language)}, "
                     f"{_sql_text(q.role)}, {i})" for i, q in enumerate(queues))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(queue_id, queue_name, language, role, queue_pos)")


def queue_ids(queues: tuple[Queue, ...] = DEFAULT_QUEUES) -> list[str]:
    return [q.queue_id for q in queues]


# Raw call legs after the CSV source has renamed its headers (all text, plus lineage + ordinal).
# The CSV export's header names and our column names.
CSV_HEADER_TO_COLUMN = {
    "Call Time": "call_time",
    "Caller Name": "caller_name",
    "Caller Number": "caller_number",
    "DNIS": "dnis",
    "Agent Extension": "agent_extension",
    "Agent Phone": "agent_phone",
    "Orig CallID": "orig_call_id",
    "Time in Queue": "time_in_queue",
    "Agent Time": "agent_time",
    "Hold Time": "hold_time",
    "Agent Name": "agent_name",
    "Queue Release Reason": "queue_release_reason",
    "Agent Release Reason": "agent_release_reason",
}
RAW_TEXT_COLUMNS = tuple(CSV_HEADER_TO_COLUMN.values())
LINEAGE_COLUMNS = ("queue_id", "queue_name", "language", "role", "source_file")
RAW_LEG_COLUMNS = ("leg_no",) + LINEAGE_COLUMNS + RAW_TEXT_COLUMNS

CURATED_SCHEMA = StructType([
    StructField("queue_id", StringType()),
    StructField("queue_name", StringType()),
    StructField("language", StringType()),
    StructField("role", StringType()),
    StructField("call_id", StringType()),
    StructField("call_time", StringType()),
    StructField("call_datetime", TimestampNTZType()),
    StructField("date", DateType()),
    StructField("hour", IntegerType()),
    StructField("dow", StringType()),
    StructField("caller_name", StringType()),
    StructField("caller_number", StringType()),
    StructField("caller_number_norm", StringType()),
    StructField("dnis", StringType()),
    StructField("agent_extension", StringType()),
    StructField("agent_phone", StringType()),
    StructField("agent_name", StringType()),
    StructField("queue_sec", DoubleType()),
    StructField("agent_sec", DoubleType()),
    StructField("hold_sec", DoubleType()),
    StructField("agent_release_reason", StringType()),
    StructField("queue_release_reason", StringType()),
    StructField("handled_flag", StringType()),
])
CURATED_COLUMNS = tuple(f.name for f in CURATED_SCHEMA.fields)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """P-14: add missing columns as typed nulls, drop extras, fix order and types."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """P-15: typed empty result."""
    return spark.createDataFrame([], schema)


def _s(*names: str, t=StringType()) -> list[StructField]:
    return [StructField(n, t) for n in names]


PERIOD = _s("period_start", "period_end", t=DateType())

# SNK-8: stored tables (all partitioned by period; a version column is added by the store).
TABLE_SCHEMAS: dict[str, StructType] = {
    "queue_dim": StructType(_s("queue_id", "queue_name", "language", "role")),
    "curated_calls": StructType(PERIOD + list(CURATED_SCHEMA.fields)),
    "raw_call_legs": StructType(PERIOD + _s("source_mode", "queue_id", "call_id", "source_file", "raw_json")),
    "report_runs": StructType(PERIOD + _s("period", "source_mode", "status", "validation_json")
                              + [StructField("generated_at", TimestampNTZType())]),
    "queue_period_metrics": StructType(PERIOD + _s("queue_id", "metrics_json")),
    "queue_daily_metrics": StructType(PERIOD + _s("queue_id") + [StructField("date", DateType()),
                                                                  StructField("calls", LongType())]),
    "queue_hourly_metrics": StructType(PERIOD + _s("queue_id") + [
        StructField("hour", IntegerType()), StructField("calls", LongType()),
        StructField("no_answer_count", LongType()), StructField("no_answer_rate", DoubleType()),
        StructField("avg_agent_sec", DoubleType())]),
    "queue_dow_metrics": StructType(PERIOD + _s("queue_id", "dow") + [StructField("calls", LongType())]),
    "agent_queue_metrics": StructType(PERIOD + _s("queue_id", "agent_name") + [
        StructField("calls", LongType()), StructField("avg_sec", DoubleType()),
        StructField("median_sec", DoubleType()), StructField("total_sec", DoubleType()),
        StructField("pct_of_answered", DoubleType())] + _s("metrics_json")),
    "caller_queue_metrics": StructType(PERIOD + _s("queue_id", "caller_number_norm") + [
        StructField("calls", LongType()), StructField("rank", IntegerType())]),
    "release_reason_metrics": StructType(PERIOD + _s("queue_id", "reason_type", "reason") + [
        StructField("calls", LongType())]),
    "funnel_language_metrics": StructType(PERIOD + _s("language", "metrics_json")),
    "crossqueue_agent_metrics": StructType(PERIOD + _s("agent_name") + [StructField("total_calls", LongType())]
                                           + _s("metrics_json")),
    "crossqueue_caller_metrics": StructType(PERIOD + _s("caller_number_norm") + [StructField("total_calls", LongType())]
                                            + _s("metrics_json")),
    "comparative_series": StructType(PERIOD + _s("series_name", "queue_id", "bucket") + [
        StructField("calls", LongType()), StructField("no_answer_count", LongType()),
        StructField("no_answer_rate", DoubleType())] + _s("metrics_json")),
    "anomalies": StructType(PERIOD + _s("severity", "kind", "queue_id", "description", "target_json", "anomaly_json")),
}

