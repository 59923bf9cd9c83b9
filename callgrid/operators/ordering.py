"""Sorting and top-k helpers (O-1…O-6).

Per-group top-k uses ``row_number() <= k`` (a partial ``WindowGroupLimit`` runs before
the shuffle); a global top-k is ``orderBy().limit(k)`` which Spark plans as
``TakeOrderedAndProject`` (each task keeps k rows, the driver merges k × tasks rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_then_name(count_col: str, name_col: str, *, locale: bool = False) -> list[Column]:
    """O-1 / O-2: count descending, then name ascending (binary order, or a Unicode
    collation when ``locale`` is set)."""
    name = F.col(name_col)
    if locale:
        name = F.collate(name, "UNICODE")
    return [F.desc(count_col), name.asc()]


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """O-3: the first ``k`` rows per group under ``order``."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O-3 / O-4: global top-k (k is the feature: a leaderboard head)."""
    return df.orderBy(*order).limit(k)


def sort_table(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """O-5: sort any table by one column, either direction (numbers numerically, text binary)."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last())
