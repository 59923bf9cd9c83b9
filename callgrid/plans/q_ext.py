"""Query family: operators the reference specifies in its design documents (X-1…X-6; X-1
and X-2 live with the cross-queue and volume families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from callgrid import oracle as O
from callgrid.functions.exprs import is_restricted, valid_agent_name
from callgrid.operators import api_curate as A
from callgrid.operators.dedup import keep_last
from callgrid.operators.flatten import field_inventory
from callgrid.plans import context as ctx
from callgrid.plans.catalog import register
from callgrid.session import table_path
from callgrid.sources.testdata import api_records_from_tables


@register("unique_agents", O.with_curated(f"""
SELECT queue_id, count(DISTINCT CASE WHEN is_handled AND coalesce({O.has_value('agent_name')}, false)
  THEN agent_name END) AS unique_agents,
  count(*) FILTER (WHERE starts_with(caller_number_norm, '__restricted__:')) AS restricted_calls
FROM curated GROUP BY queue_id"""))
def unique_agents(spark, sf_dir):
    """X-6: distinct answering agents and restricted-caller calls per queue."""
    cur = ctx.curated(spark, sf_dir)
    return cur.groupBy("queue_id").agg(
        F.count_distinct(F.when(F.col("is_handled") & valid_agent_name("agent_name"), F.col("agent_name")))
        .alias("unique_agents"),
        F.count_if(is_restricted("caller_number_norm")).alias("restricted_calls"))


@register("period_presets", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)
SELECT run_date, 'yesterday' AS preset, run_date - 1 AS start, run_date - 1 AS "end" FROM d
UNION ALL SELECT run_date, 'last_7_days', run_date - 7, run_date - 1 FROM d
UNION ALL SELECT run_date, 'last_30_days', run_date - 30, run_date - 1 FROM d
UNION ALL SELECT run_date, 'this_month', CAST(date_trunc('month', run_date) AS DATE), run_date FROM d
UNION ALL SELECT run_date, 'last_month', CAST(date_trunc('month', run_date - INTERVAL 1 MONTH) AS DATE),
  last_day(CAST(date_trunc('month', run_date - INTERVAL 1 MONTH) AS DATE)) FROM d""",
          dates=("run_date", "start", "end"))
def period_presets(spark, sf_dir):
    """X-5: yesterday, last 7 / 30 days, this month, last month for every run date."""
    d = spark.read.parquet(table_path(sf_dir, "orders")).select(F.to_date("o_orderdate").alias("run_date")).distinct()
    r = F.col("run_date")
    lm = F.trunc(F.add_months(r, -1), "MM")
    def preset(name, start, end):
        return F.struct(F.lit(name).alias("preset"), start.alias("start"), end.alias("end"))

    presets = F.array(
        preset("yesterday", F.date_sub(r, 1), F.date_sub(r, 1)),
        preset("last_7_days", F.date_sub(r, 7), F.date_sub(r, 1)),
        preset("last_30_days", F.date_sub(r, 30), F.date_sub(r, 1)),
        preset("this_month", F.trunc(r, "MM"), r),
        preset("last_month", lm, F.last_day(lm)))
    return d.select("run_date", F.inline(presets))


def _drift_sql() -> str:
    half = ctx.HALF_END
    conds = [("from.call_id", "true"), ("from.name", "true"), ("from.number", "user_id % 13 <> 1"),
             ("to.call_id", "k % 10 <> 0"), ("to.user", "k % 3 = 0 AND k % 12 <> 0"),
             ("to.user.name", "k % 3 <> 0 AND k % 12 <> 0"), ("to.user.extension", "k % 3 <> 0 AND k % 12 <> 0"),
             ("duration", "true"), ("start_time", "true"), ("queue_time", "true"), ("hold_time", "true"),
             ("answer_time", "event_type IN ('view', 'click')"), ("release_reason", "event_type <> 'purchase'"),
             *O.queue_paths(), ("queue_label", "k % 7 = 0"), ("dialled_number", "day(ts) > 15")]
    body = " UNION ".join(
        f"SELECT '{p}' AS path, CAST(ts AS DATE) <= DATE '{half}' AS first FROM ev WHERE {c}" for p, c in conds)
    return f"""WITH {O.LEGS.split('legs0 AS')[0].rstrip().rstrip(',')},
p AS ({body}),
f AS (SELECT DISTINCT path FROM p WHERE first), s AS (SELECT DISTINCT path FROM p WHERE NOT first)
SELECT path, 'first_half' AS only_in FROM f WHERE path NOT IN (SELECT path FROM s)
UNION ALL SELECT path, 'second_half' FROM s WHERE path NOT IN (SELECT path FROM f)"""


@register("field_drift", _drift_sql())
def field_drift(spark, sf_dir):
    """X-3: paths present in one half of the period's records but not the other (both ways)."""
    recs = api_records_from_tables(spark, sf_dir)
    start = F.to_date(F.substring(F.try_variant_get("rec", "$.start_time", "string"), 1, 10))
    # both halves' paths by one reading of the records; without a start a record lies in neither
    half = F.when(start <= F.lit(ctx.HALF_END).cast("date"), "first_half").when(start > F.lit(ctx.HALF_END).cast("date"), "second_half")
    paths = field_inventory(recs.select(half.alias("only_in"), "rec"), by=["only_in"])
    return (paths.where(F.col("only_in").isNotNull()).groupBy("path")
            .agg(F.count(F.lit(1)).alias("n"), F.min("only_in").alias("only_in")).where("n = 1").drop("n"))


def _hybrid_sql() -> str:
    from callgrid.plans.q_api import API_CURATED_CTES
    head = API_CURATED_CTES.index("api0 AS (")
    api_part = API_CURATED_CTES[head:].replace("deduped", "api_deduped").replace("in_period", "api_in_period")
    return O.curated_ctes() + ",\n" + api_part + """,
merged AS (SELECT queue_id, call_id, 1 AS prio FROM api_curated UNION ALL SELECT queue_id, call_id, 2 FROM curated),
pick AS (SELECT queue_id, call_id, min(prio) AS prio FROM merged GROUP BY 1, 2)
SELECT queue_id, CASE WHEN prio = 1 THEN 'api' ELSE 'csv' END AS source, count(*) AS calls FROM pick GROUP BY 1, 2"""


@register("hybrid_curated", _hybrid_sql())
def hybrid_curated(spark, sf_dir):
    """X-4: CSV and API curated calls together, one row per (queue, call id); the API row wins."""
    csv = ctx.curated(spark, sf_dir).withColumn("_prio", F.lit(2))
    api = A.api_pipeline(api_records_from_tables(spark, sf_dir), start=ctx.PERIOD_START,
                         end=ctx.PERIOD_END)[0].withColumn("_prio", F.lit(1))
    both = csv.unionByName(api.select(*csv.columns)).withColumn("_src", F.when(F.col("_prio") == 1, "api").otherwise("csv"))
    out = keep_last(both, ["queue_id", "call_id"], [F.col("_prio").asc()], check=False)
    return out.groupBy("queue_id", "_src").agg(F.count(F.lit(1)).alias("calls")).withColumnRenamed("_src", "source")
