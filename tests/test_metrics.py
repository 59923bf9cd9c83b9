"""Per-queue metrics on the eight-call fixture and funnel / statistics arithmetic."""

from pyspark.sql import functions as F

from callgrid.operators import cube as C
from callgrid.operators import queue_metrics as M
from callgrid.operators import stats as S
from callgrid.operators.cross import funnel_measures
from callgrid.schemas import queue_dim


def test_headline_and_days(spark, curated_fixture):
    cube = C.calls_cube(curated_fixture)
    h = {r.queue_id: r for r in C.headline(cube, queue_dim(spark)).collect()}
    q = h["8020"]
    assert (q.total_calls, q.handled_calls, q.no_agent_calls) == (8, 4, 4)
    assert q.no_agent_rate == 0.5 and q.days_with_calls == 3
    assert h["8031"].total_calls == 0 and h["8031"].answer_rate == 0.0
    bq = C.busiest_quietest_day(cube).first()
    assert (str(bq.busiest_date), bq.busiest_calls, str(bq.quietest_date), bq.quietest_calls) == \
        ("2025-03-06", 4, "2025-03-04", 1)
    hourly = {r.hour: r.no_answer_rate for r in C.hourly_volume(cube).collect()}
    assert hourly[7] == 0.5 and round(hourly[13] * 3) == 1 and round(hourly[18] * 3) == 2


def test_conservation(spark, curated_fixture):
    cube = C.calls_cube(curated_fixture)
    total = curated_fixture.count()
    assert C.daily_volume(cube).agg(F.sum("calls")).first()[0] == total
    assert C.hourly_volume(cube).agg(F.sum("calls")).first()[0] == total
    assert C.dow_volume(cube).agg(F.sum("calls")).first()[0] == total
    assert C.weekly_volume(cube).agg(F.sum("calls")).first()[0] == total


def test_distributions(spark, curated_fixture):
    d = {r.measure: r for r in M.duration_distribution(curated_fixture, queue_dim(spark))
         .filter("queue_id = '8020'").collect()}
    q = d["queue_sec"]
    assert (q.p25, q.median, q.p75, q["min"], q["max"]) == (5.5, 10.0, 22.75, 2.0, 40.0)
    assert (d["agent_sec"]["count"], d["agent_sec"].median, d["agent_sec"]["mean"]) == (4, 105.0, 117.5)
    assert (d["hold_sec"]["count"], d["hold_sec"].median, round(d["hold_sec"].std, 4)) == (2, 10.0, 7.0711)
    empty = M.duration_distribution(curated_fixture, queue_dim(spark)).filter("queue_id = '8030'").collect()
    assert len(empty) == 3 and all(r["count"] == 0 and r.mean is None for r in empty)


def test_leaderboard_and_callers(spark, curated_fixture):
    lb = M.agent_leaderboard(curated_fixture).orderBy("rank").collect()
    assert [(r.agent_name, r.calls, r.total_sec, r.median_sec, r.pct_of_answered) for r in lb] == [
        ("Noor", 3, 270.0, 90.0, 0.75), ("Ines", 1, 200.0, 200.0, 0.25)]
    top = M.top_callers(curated_fixture).orderBy("rank").collect()
    assert (top[0].caller_number_norm, top[0].calls) == ("4165550111", 3)
    assert not any(r.caller_number_norm.startswith("__restricted__") for r in top)


def test_funnel_arithmetic(spark):
    base = spark.createDataFrame([("English", 200, 150, 45, 30), ("French", 80, 60, 20, 15)],
                                 "language string, primary_calls long, primary_answered long, "
                                 "overflow_received long, overflow_answered long")
    f = {r.language: r for r in funnel_measures(base, ["language"]).collect()}
    en, fr = f["English"], f["French"]
    # 50 fail at the primary queue, 45 reach overflow, 15 of those are lost
    assert (en.primary_failed, en.lost, en.routing_match, en.effective_answer_rate) == (50, 15, 0.9, 0.925)
    assert (fr.primary_failed, fr.lost, fr.routing_match, fr.effective_answer_rate) == (20, 5, 1.0, 0.9375)


def test_overflow_missing_uses_primary_failed(spark):
    base = spark.createDataFrame([("English", 10, 4, 0, 0)], "language string, primary_calls long, "
                                 "primary_answered long, overflow_received long, overflow_answered long")
    r = funnel_measures(base, ["language"]).first()
    assert r.lost == 6 and r.final_dropped_calls is None and r.final_dropped_available is False


def test_statistics_diagnostics_and_funnel(spark):
    doc = spark.createDataFrame([('{"8020": {"calls_offered": 300, "calls_forwarded": 40, "abandoned_calls": 10},'
                                  ' "8021": {"calls_offered": 60, "calls_forwarded": 5, "abandoned_calls": 5},'
                                  ' "8030": {"calls_offered": 40, "calls_forwarded": 22, "abandoned_calls": 6},'
                                  ' "8031": {"calls_offered": "5", "calls_forwarded": 2, "abandoned_calls": 1}}',)],
                                "value string")
    stats = S.parse_stats(doc)
    diag = {r.queue_id: r for r in S.stats_diagnostics(stats, queue_dim(spark)).collect()}
    # forwarded and abandoned calls found no agent: 40 + 10 of 300
    assert (diag["8020"].derived_no_agent_calls, diag["8020"].derived_handled_calls) == (50, 250)
    assert diag["8020"].calls_handled == 0
    en = {r.language: r for r in S.stats_funnel(stats, queue_dim(spark)).collect()}["English"]
    assert (en.primary_calls, en.primary_answered) == (300, 250)
    assert en.lost == 38  # 50 that failed at the primary queue, less the 12 that overflow answered
