"""Keep-last deduplication (W-1, W-2) and the dedup-key gate (P-10).

``row_number() = 1`` over the key lets Spark insert a partial ``WindowGroupLimit``
before the shuffle, so each map task forwards at most one row per key: a key that
holds a third of all legs costs one row per map task after the exchange, not a
third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from callgrid.functions.exprs import ws_trim


def checked_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P-10 as a lazy gate: missing column raises now; a null/blank key fails the job when it runs."""
    for k in keys:
        if k not in df.columns:
            raise ValueError(f"Missing required dedup key column: {k}")
    out = df
    for k in keys:
        bad = F.col(k).isNull() | ~F.col(k).cast("string").rlike(r"(?U)\S")  # blank: nothing but white space
        out = out.withColumn(k, F.when(bad, F.raise_error(
            F.lit(f"Dedup key column {k} contains missing or blank values"))).otherwise(F.col(k)))
    return out


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P-10 as data: one row with the number of null/blank keys per key column."""
    return df.agg(*[F.count_if(F.col(k).isNull() | (ws_trim(k) == "")).alias(f"bad_{k}") for k in keys])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *,
              check: bool = True) -> DataFrame:
    """Generic keep-last: the row that sorts first under ``order`` survives per key."""
    src = checked_keys(df, keys) if check else df
    # the sorts compare the first column's leading bytes: call ids differ there, the few queues do not
    w = Window.partitionBy(*reversed(keys)).orderBy(*order)
    return src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_csv(legs: DataFrame, *, keys: Sequence[str] = ("queue_id", "orig_call_id"),
              ordinal: str = "leg_no", check: bool = True) -> DataFrame:
    """W-1: keep the last leg in file order per (queue, call id); junk columns dropped (P-4)."""
    legs = legs.drop(*[c for c in ("_c0", "_c17") if c in legs.columns])
    return keep_last(legs, keys, [F.col(ordinal).desc()], check=check)


def dedup_api(records: DataFrame, *, key: str = "call_key", sort_key: str = "sort_key",
              ordinal: str = "rec_no", check: bool = True) -> DataFrame:
    """W-2: global keep-last per call key after a stable ascending sort on ``sort_key``.

    The survivor is the largest sort key; a null sort key sorts last and therefore
    wins; ties go to the later record.
    """
    return keep_last(records, [key], [F.col(sort_key).desc_nulls_first(), F.col(ordinal).desc()],
                     check=check)
