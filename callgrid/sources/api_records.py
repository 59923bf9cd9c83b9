"""Landed API records (S-3) and queue statistics (S-5 reader) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """S-3: JSON Lines -> ``(rec_no, rec VARIANT)``; blank lines skipped.

    ``rec_no`` orders records as they appear in the files (file name, split offset, row
    position), which the keep-last tie-break needs.
    """
    raw = spark.read.text(path).select("value", "_metadata.file_name", "_metadata.file_block_start")
    raw = raw.filter(F.trim("value") != "")
    return raw.select(F.struct("file_name", "file_block_start", F.monotonically_increasing_id()).alias("rec_no"),
                      F.parse_json("value").alias("rec"))


def read_stats_document(spark: SparkSession, path: str) -> DataFrame:
    """The statistics document as one ``value`` row (parsed by ``operators.stats.parse_stats``)."""
    return spark.read.text(path, wholetext=True).select("value")
