"""Registry of the named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver's tables.
Families register themselves from the ``q_*`` modules of this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, *, dates: tuple[str, ...] = ()):
    """Register a query; ``dates`` are DATE columns returned as ``yyyy-MM-dd`` text on both
    sides (the report's rendering), so the comparison never depends on driver date types."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            if dates:
                df = df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})
            return df

        run.__doc__ = fn.__doc__
        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql if not dates else (
                "SELECT * REPLACE (" + ", ".join(f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" for c in dates)
                + f") FROM ({sql}) AS q")
        return fn
    return deco


def load_all() -> None:
    # import for side effects: each module registers its family
    from callgrid.plans import q_core, q_queue, q_cross, q_rules, q_api, q_report, q_scale, q_ext, q_sheet  # noqa: F401
