"""Nested-record path: VARIANT traps (T5, T6, T7), W-2, J-1/J-2, P-11, P-18, F-12/F-13."""

import json

import pytest
from pyspark.sql import functions as F

from callgrid.operators import api_curate as A
from callgrid.operators.flatten import field_inventory, flatten_paths


def _records(spark, recs):
    rows = [(i, json.dumps(r)) for i, r in enumerate(recs)]
    return spark.createDataFrame(rows, "rec_no long, value string").select("rec_no", F.parse_json("value").alias("rec"))


RECS = [
    # two legs of one call: the later to.call_id wins
    {"from": {"call_id": "c1", "number": "sip:+16135550100@pbx;user=phone"}, "to": {"call_id": "20260401080000-a",
     "user": "Agent A"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00", "duration": 30},
    {"from": {"call_id": "c1", "number": "613-555-0100"}, "to": {"call_id": "20260401080500-b",
     "user": {"name": "Agent B", "extension": "205"}}, "call_queue": {"id": "8030"},
     "start_time": "2026-04-01T13:05:00Z", "answer_time": "2026-04-01T13:05:10Z", "duration": "45"},
    # unanswered but with a duration: flag says No Agent, metrics count it answered (T5)
    {"from": {"call_id": "c2"}, "to": {"call_id": "20260402090000-c"}, "queue": {"queue": "CSR French"},
     "start_time": "2026-04-02T09:00:00-04:00", "duration": 12, "release_reason": " No Answer "},
    # queue only in a free-text field (J-2) and in another period
    {"from": {"call_id": "c3"}, "queue_label": "Transfer to CSR Overflow French", "start_time": "2026-05-01T10:00:00",
     "duration": "00:53"},
    # no tracked queue anywhere
    {"from": {"call_id": "c4"}, "queue_label": "Main Line", "start_time": "2026-04-03T10:00:00", "duration": 5},
]


def test_api_pipeline(spark):
    recs = _records(spark, RECS)
    curated, unmapped, counts = A.api_pipeline(recs, start="2026-04-01", end="2026-04-30")
    rows = {r.call_id: r for r in curated.collect()}
    assert set(rows) == {"c1", "c2"}
    c1 = rows["c1"]
    assert (c1.queue_id, c1.agent_name, c1.agent_extension, c1.agent_sec) == ("8030", "Agent B", "205", 45.0)
    assert str(c1.call_datetime) == "2026-04-01 09:05:00"  # 13:05Z in Toronto (EDT)
    assert (c1.caller_number, c1.caller_number_norm, c1.handled_flag) == ("613-555-0100", "6135550100", "Handled")
    c2 = rows["c2"]
    assert (c2.queue_id, c2.handled_flag, c2.is_handled) == ("8021", "No Agent", True)
    assert str(c2.call_datetime) == "2026-04-02 09:00:00" and c2.queue_release_reason == "No Answer"
    assert [r.call_key for r in unmapped.collect()] == ["c4"]
    assert (c1.source_queue_id, c1["Orig CallID"], c1.source_file) == ("8030", "c1", "api_records")
    assert len(curated.drop("is_handled").columns) == 26
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 0 and "open_rec" not in plan  # one read of the written stages
    counts = counts.first()
    assert (counts.record_count, counts.deduped_count, counts.curated_count,
            counts.ignored_unmapped_queue_rows, counts.status) == (5, 4, 2, 1, "success")


def test_fallback_resolution_outside_period(spark):
    curated, _, _ = A.api_pipeline(_records(spark, RECS), start="2026-05-01", end="2026-05-31")
    r = curated.first()
    assert (r.call_id, r.queue_id, r.agent_sec) == ("c3", "8031", 53.0)


def test_missing_required_fields(spark):
    recs = _records(spark, [{"from": {"number": "1"}, "start_time": "2026-04-01T08:00:00"}])
    with pytest.raises(ValueError, match="from.call_id"):
        A.api_pipeline(recs)


def test_flatten_and_inventory(spark):
    recs = _records(spark, [{"a": {"b": 1, "c": [1, 2]}, "to": {"user": "x"}, "n": None, "e": {}},
                            {"to": {"user": {"name": "A"}}}])
    paths = [r.path for r in field_inventory(recs).orderBy("path").collect()]
    assert paths == ["a.b", "a.c", "n", "to.user", "to.user.name"]
    leaves = flatten_paths(recs, ["rec_no"]).filter("path = 'a.c'").select(F.to_json("value")).first()[0]
    assert leaves == "[1,2]"


def test_deep_records_flatten_and_resolve(spark):
    deep = {"call_queue_info": {"l2": {"l3": {"l4": {"l5": {"l6": {"l7": {"queue": "8021"}}}}}}}}
    recs = _records(spark, [{"from": {"call_id": "d1"}, "start_time": "2025-05-06T10:00:00", **deep}])
    assert "call_queue_info.l2.l3.l4.l5.l6.l7.queue" in [r.path for r in field_inventory(recs).collect()]
    curated, _, _ = A.api_pipeline(recs)
    assert [(r.call_id, r.queue_id) for r in curated.collect()] == [("d1", "8021")]


def test_wall_clock_offsets(spark):
    cases = {"2025-05-06": "2025-05-06 00:00:00", "2025-05-06 10:20:30": "2025-05-06 10:20:30",
             "2025-05-06T10:20:30Z": "2025-05-06 06:20:30", "2025-05-06T10:20:30+0530": "2025-05-06 00:50:30",
             "2025-05-06T10:20:30.250-03:00": "2025-05-06 09:20:30.250000", "2025-05-06T10:20+02": "2025-05-06 04:20:00"}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: str(r.w) for r in df.select("t", A.api_wall_clock("t").alias("w")).collect()}
    assert got == cases


def test_seconds_coercion_from_variant(spark):
    recs = _records(spark, [
        {"from": {"call_id": "n1"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00", "duration": -5},
        {"from": {"call_id": "n2"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00", "duration": True},
        {"from": {"call_id": "n3"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00", "duration": "12.5"},
        {"from": {"call_id": "n4"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00",
         "talk_time": "1:02:03", "duration": 7},
        {"from": {"call_id": "n5"}, "call_queue": {"id": "8020"}, "start_time": "2026-04-01T08:00:00", "duration": "-5"},
    ])
    curated, _, _ = A.api_pipeline(recs)
    got = {r.call_id: r.agent_sec for r in curated.collect()}
    assert got == {"n1": -5.0, "n2": None, "n3": 12.5, "n4": 3723.0, "n5": None}


def test_api_run_source_gaps(spark):
    from callgrid.plans.run import run_api_period
    missing = run_api_period(spark, _records(spark, [{"from": {"number": "1"}, "start_time": "2026-04-01T08:00:00"}]),
                             None, "2026-04-01", "2026-04-30")
    assert missing.gaps[0]["reason"] == "missing_api_fields" and "from.call_id" in missing.gaps[0]["message"]
    unmapped = run_api_period(spark, _records(spark, [
        {"from": {"call_id": "u1"}, "queue_label": "Main Line", "start_time": "2026-04-01T08:00:00"}]),
        None, "2026-04-01", "2026-04-30")
    assert unmapped.gaps == [{"queue_id": "all", "reason": "unmapped_queue",
                              "message": "1 API CDR rows could not be mapped to tracked queue IDs."}]


def test_failed_api_run_keeps_the_published_period(spark):
    import tempfile

    from callgrid.plans.run import run_api_period
    from callgrid.sinks.store import PeriodStore
    root = tempfile.mkdtemp(prefix="callgrid-test-")
    good = _records(spark, [{"from": {"call_id": "g1"}, "call_queue": {"id": "8020"}, "start_time": "2025-05-06T08:00:00"}])
    bad = _records(spark, [{"from": {"call_id": "u1"}, "queue_label": "Lobby", "start_time": "2025-05-06T08:00:00"}])
    assert run_api_period(spark, good, None, "2025-05-01", "2025-05-31", root).run_id
    failed = run_api_period(spark, bad, None, "2025-05-01", "2025-05-31", root)
    assert failed.run_id is None and failed.gaps[0]["reason"] == "unmapped_queue"
    assert PeriodStore(spark, root).read("curated_calls").count() == 1
    assert spark.read.json(f"{root}/_gaps").first().reason == "unmapped_queue"


def test_open_records_are_read_from_a_written_table(spark):
    """J-1's filter was moved below the extraction and repeated the parsing for each candidate path."""
    from callgrid.operators.resolve import open_records, resolve_fallback
    from callgrid.schemas import DEFAULT_QUEUES
    left = open_records(_records(spark, RECS), DEFAULT_QUEUES)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "open-records" in plan and "parse_json" not in plan
    assert sorted(r.rec_no for r in left.select("rec_no").collect()) == [3, 4]
    assert [tuple(r) for r in resolve_fallback(left, DEFAULT_QUEUES).collect()] == [(3, "8031")]


def test_arrays_and_scalars_have_no_paths(spark):
    """A record that is no object gives no path, and the record is built once a row, not once more for a filter."""
    recs = spark.createDataFrame([(1, "[1, 2]"), (2, '"x"'), (3, '{"a": {"b": [1]}, "c": null}'), (4, None)], "rec_no long, value string")
    recs = recs.select("rec_no", F.parse_json("value").alias("rec"))
    assert sorted((r.rec_no, r.path) for r in flatten_paths(recs, ["rec_no"]).collect()) == [(3, "a.b"), (3, "c")]
    assert sorted(r.path for r in field_inventory(recs).collect()) == ["a.b", "c"]


def test_presence_is_settled_by_the_first_records(spark):
    """F2, F7, F8: fields that the first records have exist; the rest is not parsed for that. A missing one is looked for in all."""
    body = json.dumps(RECS[0])
    late = F.when(F.col("id") < 200, F.lit(body)).otherwise(F.raise_error(F.lit("parsed")))
    recs = spark.range(0, 300, 1, 1).select(F.col("id").alias("rec_no"), F.parse_json(late.cast("string")).alias("rec"))
    assert A.field_presence(recs) == A.FieldPresence(True, True, True, 300)
    late = F.when(F.col("id") < 250, F.lit('{"start_time": "2026-04-01"}')).otherwise(F.lit('{"from": {"call_id": "a"}}'))
    recs = spark.range(0, 300, 1, 1).select(F.col("id").alias("rec_no"), F.parse_json(late).alias("rec"))
    assert A.field_presence(recs) == A.FieldPresence(True, True, False, 300)
    assert A.field_presence(recs.limit(0)).missing == [A.CALL_ID_FIELD, A.START_TIME_FIELD]


def test_inventory_by_column(spark):
    """the paths of several groups of records by one reading."""
    recs = _records(spark, [{"a": 1}, {"a": {"b": 2}}, {"a": 3, "c": 4}]).withColumn("g", F.col("rec_no") % 2)
    assert sorted(map(tuple, field_inventory(recs, by=["g"]).collect())) == [(0, "a"), (0, "c"), (1, "a.b")]
