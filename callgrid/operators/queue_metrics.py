"""Per-queue metrics that go back to curated rows: distributions (A-7), release reasons
(A-8), agent leaderboard with share (A-9, W-3), top callers (A-10, O-3), the summary
card (A-20, W-5) and the daily sparkline (W-6).

Scale notes: every aggregate is partial+final (map-side combined), so a queue with a
third of all calls is pre-aggregated before the shuffle. Exact percentiles come from
counts per distinct value and running sums over them, never from a group's raw values.
Windows only run on aggregated rows, and top-k windows (``row_number() <= k``) get a
partial ``WindowGroupLimit`` before their exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callgrid.functions.exprs import is_restricted, valid_agent_name, ws_trim
from callgrid.operators.curate import with_handled

MEASURES = ("queue_sec", "agent_sec", "hold_sec")
DIST_STATS = ("count", "mean", "std", "min", "p25", "median", "p75", "max")


def value_statistics(df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...]) -> DataFrame:
    """Count, mean, sample std, min, max, sum and exact interpolated quantiles of ``value`` by ``keys``.

    Values are first counted per (keys, value), which combines in every map task; running
    counts over the sorted distinct values then give the quantiles. No group holds its raw
    values in memory, and a group that has most rows is spread until only its distinct
    values are left.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    scan = counted.withColumns({
        "_upto": F.sum("_n").over(whole.orderBy(value)), "_all": F.sum("_n").over(whole),
        "_mean": F.sum(F.col(value) * F.col("_n")).over(whole) / F.sum("_n").over(whole)})

    def at(place) -> Column:  # the value at a 0-based place of the sorted rows
        return F.min(F.when(F.col("_upto") > place, F.col(value)))

    def quantile(p: float) -> Column:
        place = F.lit(p) * (F.col("_all") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    square = F.sum(F.col("_n") * (F.col(value) - F.col("_mean")) * (F.col(value) - F.col("_mean")))
    return scan.groupBy(*keys).agg(
        F.sum("_n").alias("count"), F.max("_mean").alias("mean"),
        F.when(F.sum("_n") > 1, F.sqrt(square / F.greatest(F.sum("_n") - 1, F.lit(1)))).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.sum(F.col(value) * F.col("_n")).alias("sum"),
        F.array(*[quantile(p) for p in quantiles]).alias("quantiles"))


def duration_distribution(curated: DataFrame, dim: DataFrame) -> DataFrame:
    """A-7: count, mean, sample std, min, p25, median, p75, max for three populations.

    ``queue_sec``: every non-null value; ``agent_sec``: handled calls with a valid agent
    name; ``hold_sec``: values > 0. Every (queue, measure) of the dimension gets a row;
    an empty population has count 0 and null statistics.
    """
    c = with_handled(curated)
    handled_named = F.col("is_handled") & valid_agent_name("agent_name")
    long = c.select(
        "queue_id",
        F.stack(F.lit(3),
                F.lit("queue_sec"), F.col("queue_sec"),
                F.lit("agent_sec"), F.when(handled_named, F.col("agent_sec")),
                F.lit("hold_sec"), F.when(F.coalesce("hold_sec", F.lit(0.0)) > 0, F.col("hold_sec")),
                ).alias("measure", "value"),
    ).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    stats = value_statistics(long, ["queue_id", "measure"], "value", (0.25, 0.5, 0.75)).select(
        "queue_id", "measure", "count", "mean", "std", "min",
        F.col("quantiles")[0].alias("p25"), F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("p75"), "max")
    grid = dim.select("queue_id", F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("measure"))
    return (grid.join(stats, ["queue_id", "measure"], "left")
            .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint")))


def release_reasons(curated: DataFrame) -> DataFrame:
    """A-8: reason counts per queue and reason type (queue/agent); calls desc, reason asc."""
    long = curated.select(
        "queue_id",
        F.stack(F.lit(2), F.lit("queue"), F.col("queue_release_reason"),
                F.lit("agent"), F.col("agent_release_reason")).alias("reason_type", "raw"))
    t = ws_trim("raw")
    counted = (long.filter(F.col("raw").isNotNull() & (t != "") & (F.lower(t) != "null"))
               .groupBy("queue_id", "reason_type", t.alias("reason")).agg(F.count(F.lit(1)).alias("calls")))
    w = Window.partitionBy("queue_id", "reason_type").orderBy(F.desc("calls"), F.asc("reason"))
    return counted.withColumn("rank", F.row_number().over(w))


def agent_leaderboard(curated: DataFrame) -> DataFrame:
    """A-9 + W-3: handled calls with a valid agent name per (queue, agent).

    ``pct_of_answered`` divides by the sum of leaderboard calls of the queue (T11). Both the
    share and the rank are windows over the *aggregated* agent rows of a queue (bounded by
    the agent roster) and share one exchange; a separate totals aggregate joined back
    would make Spark scan and deduplicate the calls a second time.
    """
    c = with_handled(curated)
    answered = c.filter(F.col("is_handled") & valid_agent_name("agent_name"))
    lb = value_statistics(answered, ["queue_id", "agent_name"], "agent_sec", (0.5,)).select(
        "queue_id", "agent_name", F.col("count").alias("calls"), F.col("mean").alias("avg_sec"),
        F.col("quantiles")[0].alias("median_sec"), F.col("sum").alias("total_sec"))
    by_q = Window.partitionBy("queue_id")
    w = by_q.orderBy(F.desc("calls"), F.asc("agent_name"))
    return (lb.withColumn("pct_of_answered", F.col("calls") / F.sum("calls").over(by_q))
            .withColumn("rank", F.row_number().over(w)))


def caller_counts(curated: DataFrame) -> DataFrame:
    """Calls per (queue, caller) excluding restricted sentinels (P-9)."""
    return (curated.filter(~is_restricted("caller_number_norm") & F.col("caller_number_norm").isNotNull())
            .groupBy("queue_id", "caller_number_norm").agg(F.count(F.lit(1)).alias("calls")))


def top_callers(curated: DataFrame, k: int = 10) -> DataFrame:
    """A-10 / O-3: the k most frequent callers per queue (calls desc, number asc)."""
    w = Window.partitionBy("queue_id").orderBy(F.desc("calls"), F.asc("caller_number_norm"))
    return (caller_counts(curated).withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def queue_summary(headline: DataFrame, hourly: DataFrame, leaderboard: DataFrame,
                  callers: DataFrame) -> DataFrame:
    """A-20 / W-5: busiest hour (calls desc, hour asc), top agent, top caller; "n/a" by default."""
    peak = hourly.groupBy("queue_id").agg(
        F.max_by("hour", F.struct(F.col("calls"), -F.col("hour"))).alias("busiest_hour"))
    agent = leaderboard.filter(F.col("rank") == 1).select("queue_id", F.col("agent_name").alias("top_agent"))
    caller = callers.filter(F.col("rank") == 1).select(
        "queue_id", F.col("caller_number_norm").alias("top_caller"))
    return (headline.select("queue_id", "total_calls", "no_agent_rate")
            .join(peak, "queue_id", "left").join(agent, "queue_id", "left").join(caller, "queue_id", "left")
            .select("queue_id", "total_calls", "no_agent_rate", "busiest_hour",
                    F.coalesce("top_agent", F.lit("n/a")).alias("top_agent"),
                    F.coalesce("top_caller", F.lit("n/a")).alias("top_caller")))


def sparkline(daily: DataFrame, days: int = 30, floor_pct: float = 10.0) -> DataFrame:
    """W-6: first ``days`` days per queue as % of the queue's busiest day (max floored at 1),
    never below ``floor_pct``. Windows run over (queue, date) rows, bounded by the period."""
    by_q = Window.partitionBy("queue_id")
    pos = F.row_number().over(by_q.orderBy("date"))
    mx = F.greatest(F.max("calls").over(by_q), F.lit(1))
    out = daily.select("queue_id", "date", "calls", pos.alias("pos"),
                       F.greatest(F.lit(floor_pct), F.col("calls") / mx * 100.0).alias("height_pct"))
    return out.filter(F.col("pos") <= days)
