"""Shared inputs of the registered queries: the period and the curated frames.

Every query reads the driver's tables (``events``; ``lineitem`` for scale) and
derives call legs from them, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from callgrid.operators.cube import calls_cube
from callgrid.operators.curate import csv_pipeline
from callgrid.schemas import DEFAULT_QUEUES, queue_dim, queue_ids
from callgrid.sources.testdata import legs_from_tables

# The reporting period of the driver's event data: the whole of January 2024 (all rows).
PERIOD_START = "2024-01-01"
PERIOD_END = "2024-01-31"
# Half period used only by the period-filter operators (P-1, P-2), where the filter is the feature.
HALF_END = "2024-01-15"

QUEUE_IDS = queue_ids(DEFAULT_QUEUES)


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs_from_tables(spark, sf_dir)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-path curated calls for the period (P-1 -> W-1 -> P-12)."""
    return csv_pipeline(legs(spark, sf_dir), PERIOD_START, PERIOD_END)


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_cube(curated(spark, sf_dir))


def dim(spark: SparkSession) -> DataFrame:
    return queue_dim(spark, DEFAULT_QUEUES)


def curated_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated calls persisted for queries that derive several tables from them.

    Without it every branch would rebuild (and re-shuffle) the calls: column pruning gives
    each branch a different subtree, so Spark cannot reuse the dedup exchange. A lost
    executor's blocks are recomputed from lineage.
    """
    return curated(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)


def cube_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The additive cube of the shared curated calls, persisted (queues x days x 24 rows at most)."""
    return calls_cube(curated_shared(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
