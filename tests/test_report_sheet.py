"""Report operators (F-21…F-25, A-19, SNK-2, SNK-3, S-8, S-9) and sheet variants (S-10, F-27, A-25/26)."""

import pytest
from pyspark.sql import functions as F

from callgrid.operators import report as R
from callgrid.operators import sheet as S
from callgrid.sources.documents import scan_manifest, shape_violations


def test_thresholds(spark):
    df = spark.createDataFrame([("reached_an_agent", 0.9), ("reached_an_agent", 0.85), ("reached_an_agent", 0.5),
                                ("missed_call_rate", 0.05), ("missed_call_rate", 0.07), ("missed_call_rate", 0.2),
                                ("right_language_routing", 0.95), ("unknown", 1.0)], "m string, v double")
    got = [r[0] for r in df.select(R.threshold_status(F.col("m"), F.col("v"))).collect()]
    assert got == ["good", "watch", "at-risk", "good", "watch", "at-risk", "good", None]


def test_labels(spark):
    df = spark.createDataFrame([(5, 42.4, "16135550100", "system_agent"), (14, 125.6, "6135550100", "volume_spike"),
                                (None, None, "123", "no_agent_outlier")], "h int, s double, p string, k string")
    rows = df.select(R.hour_label(F.col("h")), R.duration_label(F.col("s")), R.phone_label(F.col("p")),
                     R.anomaly_kind_label(F.col("k"))).collect()
    assert list(rows[0]) == ["05:00", "42s", "+1 (613) 555-0100", "System Agent"]
    assert list(rows[1]) == ["14:00", "2m 06s", "+1 (613) 555-0100", "Volume spike"]
    assert list(rows[2]) == ["n/a", "n/a", "123", "Unusual missed-call rate"]


def test_period_resolution(spark):
    df = spark.createDataFrame([("2026-05-01",), ("2024-03-31",), ("2026-01-15",)], "d string")
    s, e = R.previous_month(F.to_date("d"))
    got = [(str(a), str(b), c, k) for a, b, c, k in
           df.select(s, e, R.month_label(s), R.period_key(s)).collect()]
    assert got == [("2026-04-01", "2026-04-30", "April 2026", "2026-04"),
                   ("2024-02-01", "2024-02-29", "February 2024", "2024-02"),
                   ("2025-12-01", "2025-12-31", "December 2025", "2025-12")]


def test_weekday_occurrences(spark):
    occ = {r.dow: r.occurrences for r in R.weekday_occurrences(spark, "2026-04-01", "2026-04-30").collect()}
    assert occ["Wednesday"] == 5 and occ["Monday"] == 4 and sum(occ.values()) == 30


def test_manifest_upsert_and_scan(spark):
    e = lambda s: R.manifest_entry(F.to_date(F.lit(s)), F.last_day(F.to_date(F.lit(s))), F.lit("api"),
                                   F.lit("success"))
    old = spark.range(1).select(F.explode(F.array(e("2026-02-01"), e("2026-03-01"))).alias("x")).select("x.*")
    new = spark.range(1).select(R.manifest_entry(F.to_date(F.lit("2026-03-01")), F.to_date(F.lit("2026-03-31")),
                                                 F.lit("csv"), F.lit("success")).alias("x")).select("x.*")
    merged = R.manifest_upsert(old, new).orderBy("rank").collect()
    assert [(r.key, r.source) for r in merged] == [("2026-03", "csv"), ("2026-02", "api")]
    doc = spark.createDataFrame([('{"reports": [{"key": "2026-03", "label": "March 2026", "start": "2026-03-01", '
                                  '"end": "2026-03-31", "path": "month_x/metrics.json", "source": "api"}, '
                                  '{"key": "2026-04", "label": "April 2026", "start": "2026-04-01", '
                                  '"end": "2026-04-30", "path": "/abs/metrics.json", "source": "csv"}]}',)], "value string")
    rows = scan_manifest(doc, "/data/reports").orderBy("rank").collect()
    assert [(r.key, r.path) for r in rows] == [("2026-04", "/abs/metrics.json"),
                                               ("2026-03", "/data/reports/month_x/metrics.json")]


def test_document_contract(spark):
    docs = spark.createDataFrame([("8020", '{"queue_id": "8020", "total_calls": 3, "daily_volume": [], '
                                           '"hourly_volume": [], "agent_leaderboard": [], "top_callers": []}'),
                                  ("8021", '{"queue_id": "8021", "total_calls": "3", "daily_volume": {}}')],
                                 "queue_id string, document string")
    bad = {(r.queue_id, r.path, r.found) for r in shape_violations(docs).collect()}
    assert ("8021", "total_calls", "string") in bad and ("8021", "daily_volume", "object") in bad
    assert not any(q == "8020" for q, _, _ in bad)


def test_sheet_parsers(spark):
    df = spark.createDataFrame([("01:05", "2026-04-01 08:30:00", None), ("12", "04/02/2026 9:15 pm", " Restricted "),
                                ("bad", "2026-04-03 07:00", "613-555-0100"), (None, None, "n/a")],
                               "s string, t string, c string")
    rows = df.select(S.sheet_seconds("s"), S.sheet_time("t").cast("string"), S.sheet_caller("c")).collect()
    assert [r[0] for r in rows] == [65.0, 12.0, 0.0, 0.0]
    assert [r[1] for r in rows][:3] == ["2026-04-01 08:30:00", "2026-04-02 21:15:00", "2026-04-03 07:00:00"]
    assert [r[2] for r in rows] == ["Unknown", "Restricted", "6135550100", "n/a"]


def test_header_detection(spark):
    lines = spark.createDataFrame([
        ("s1", 0, ["Report", None, None, None, None]),
        ("s1", 1, ["Queue ID", "Call Time", "Caller Number", "Orig CallID", "Orig CallID"]),
        ("s1", 2, [None, None, None, None, None]),
        ("s1", 3, ["8020", "2026-04-01 08:00:00", "613", "a", "x"]),
    ], "sheet string, line_no int, cells array<string>")
    recs = S.detect_header(lines, [("Queue ID", "Call Time", "Caller Number", "Orig CallID")]).collect()
    assert len(recs) == 1
    assert recs[0].record == {"Queue ID": "8020", "Call Time": "2026-04-01 08:00:00", "Caller Number": "613",
                              "Orig CallID": "a", "Orig CallID_1": "x"}


def test_supplied_override(spark):
    computed = spark.createDataFrame([("8020", "A", 5), ("8021", "B", 2)], "queue_id string, agent_name string, calls long")
    supplied = spark.createDataFrame([("8020", "Z", 9)], "queue_id string, agent_name string, calls long")
    got = sorted(tuple(r) for r in S.supplied_override(computed, supplied).collect())
    assert got == [("8020", "Z", 9), ("8021", "B", 2)]


def test_long_export_sections(spark):
    from callgrid.operators.stats import parse_stats, stats_diagnostics, stats_funnel
    from callgrid.plans.q_report import long_export_tables
    from callgrid.sinks.export import export_text
    tables, dim = long_export_tables(spark, "/root/testdata/sf0.001")
    doc = spark.createDataFrame([('{"8020": {"calls_offered": 90, "calls_forwarded": 21, "abandoned_calls": 9}}',)],
                                "value string")
    stats = parse_stats(doc)
    tables["stats_diagnostics"] = stats_diagnostics(stats, dim)
    tables["stats_funnel"] = stats_funnel(stats, dim)
    out = R.long_export(tables, dim, "month", "2024-01-01", "2024-01-31", generated_at="2024-02-01T09:00:00Z")
    sections = {r.section for r in out.select("section").distinct().collect()}
    meta = out.filter("section = 'report_metadata'").first()
    assert out.columns == list(R.EXPORT_COLUMNS) and len(out.columns) == 16
    out = out.withColumn("text", export_text(F.col("value")))
    meta = out.filter("section = 'report_metadata'").first()
    assert (meta.metric, meta.text, meta.queue_id) == ("generated_at", "2024-02-01T09:00:00Z", "")
    assert {"queue_summary", "report_validation", "queue_hourly_volume", "crossqueue_funnel", "anomalies",
            "api_queue_stats_diagnostic", "api_stats_funnel_diagnostic"} <= sections
    derived = out.filter("metric = 'derived_no_agent_calls' AND queue_id = '8020'").first()
    assert derived.text == "30"
    rec = out.filter("section = 'report_validation' AND metric = 'answered_plus_no_agent_reconciles'").first()
    assert rec.text == "true" and rec.queue_id == ""


def test_report_documents(spark):
    import json

    import __spark_entry__ as E
    d = "/root/testdata/sf0.001"
    from callgrid.plans.q_report import _queue_documents
    docs = {r.queue_id: r.document for r in _queue_documents(spark, d).collect()}
    head = {r.queue_id: r for r in E.queries()["headline"](spark, d).collect()}
    assert set(docs) == set(head)
    for qid, text in docs.items():
        doc = json.loads(text)
        assert list(doc) == sorted(doc)  # keys sorted
        assert doc["total_calls"] == head[qid].total_calls and doc["queue_id"] == qid
        assert sum(p["calls"] for p in doc["daily_volume"]) == head[qid].total_calls
        assert [p["hour"] for p in doc["hourly_volume"]] == sorted(p["hour"] for p in doc["hourly_volume"])
        assert all(list(p) == sorted(p) for p in doc["agent_leaderboard"])
        assert "avg_agent_sec" in doc["hourly_volume"][0]  # nulls are kept, not dropped
        assert len(doc["top_callers"]) <= 10
    from callgrid.sources.documents import shape_violations
    assert shape_violations(_queue_documents(spark, d)).count() == 0


def test_ordering_helpers(spark):
    from callgrid.operators.ordering import count_then_name, sort_table, top_k, top_k_per_group
    df = spark.createDataFrame([("q", "b", 3), ("q", "a", 3), ("q", "é", 1), ("r", "Z", 5), ("q", "E", 1)],
                               "g string, name string, calls long")
    assert [r.name for r in top_k(df, count_then_name("calls", "name"), 3).collect()] == ["Z", "a", "b"]
    per = top_k_per_group(df, ["g"], count_then_name("calls", "name"), 2).filter("g = 'q'").orderBy("rank").collect()
    assert [r.name for r in per] == ["a", "b"]
    loc = df.filter("calls = 1").orderBy(*count_then_name("calls", "name", locale=True)).collect()
    assert [r.name for r in loc] == ["E", "é"]
    assert [r.calls for r in sort_table(df, "calls", descending=True).collect()][0] == 5


def test_percent_run_row_and_single_queue_sheet(spark):
    from callgrid.schemas import DEFAULT_QUEUES, queue_dim
    df = spark.createDataFrame([(0.1234,), (None,), (12.5,)], "r double")
    assert [r[0] for r in df.select(R.percent_label(F.col("r"))).collect()] == ["12.3%", "0.0%", "1,250.0%"]
    row = R.run_row("2024-01-01", "2024-01-31", "csv", F.lit("success"), F.lit("{}"), spark).first()
    assert (str(row.period_start), row.source_mode, row.status) == ("2024-01-01", "csv", "success")
    lines = spark.createDataFrame([
        ("s", 0, ["Call Time", "Caller Number", "Orig CallID", "Agent Time Seconds", "Agent Time"]),
        ("s", 1, ["2026-04-01 08:00:00", "Restricted", "a", "42", "00:10"]),
        ("s", 2, ["2026-04-01 09:00", None, "b", None, "01:05"]),
    ], "sheet string, line_no int, cells array<string>")
    recs = S.detect_header(lines, [("Call Time", "Caller Number", "Orig CallID")])
    rows = {r.call_id: r for r in S.sheet_curated(recs, queue_dim(spark), DEFAULT_QUEUES[2]).collect()}
    assert rows["a"].queue_id == "8030" and rows["a"].language == "English" and rows["a"].role == "overflow"
    assert (rows["a"].agent_sec, rows["b"].agent_sec) == (42.0, 65.0)  # seconds column first, else clock text
    assert (rows["a"].caller_number_norm, rows["b"].caller_number_norm) == ("Restricted", "Unknown")
    assert rows["b"].hour == 9


def test_sheet_without_header_fails(spark):
    lines = spark.createDataFrame([("s1", 0, ["Queue ID", "Call Time"]), ("s1", 1, ["8020", "x"]), ("s2", 0, ["a", "b"])],
                                  "sheet string, line_no int, cells array<string>")
    with pytest.raises(Exception, match="no header row in sheet s2"):
        S.detect_header(lines, [("Queue ID", "Call Time")]).collect()


def test_report_bundle_meets_the_contract(spark, tmp_path):
    import json

    from callgrid.plans.run import run_csv_period
    from callgrid.schemas import DEFAULT_QUEUES, queue_ids
    from callgrid.sources.documents import report_rules, shape_violations
    from callgrid.sources.testdata import legs_from_tables
    legs = legs_from_tables(spark, "/root/testdata/sf0.001")
    run_csv_period(spark, legs, "2024-01-01", "2024-01-31", report_root=str(tmp_path))
    folder = tmp_path / "reports" / "month_2024-01-01_2024-01-31"
    doc = spark.read.text(str(folder / "metrics")).withColumnRenamed("value", "document")
    rules = report_rules(queue_ids(DEFAULT_QUEUES))
    assert shape_violations(doc.selectExpr("'month' AS report", "document"), rules, "report").count() == 0
    text = json.loads(doc.first().document)
    assert text["period"] == "month" and text["validation"]["status"] == "success" and text["source_gaps"] == []
    queue = text["queues"]["8020"]
    assert sum(r["calls"] for r in queue["weekly_volume"]) == sum(r["calls"] for r in queue["dow_volume"]) == queue["total_calls"]
    assert queue["raw_rows"] - queue["duplicate_rows_removed"] == queue["cleaned_calls"] == queue["total_calls"]
    assert queue["duration_distributions"]["queue_sec"]["count"] == queue["total_calls"] and queue["release_reasons"]["queue"]
    assert {p.name for p in (folder / "queues").glob("file=*")} == {f"file=metrics_{q}" for q in queue_ids(DEFAULT_QUEUES)}
    callers = [(-c["total_calls"], c["caller_number_norm"]) for c in text["crossqueue"]["callers"]]
    assert callers == sorted(callers) and len(callers) == spark.read.json(str(folder / "callers")).count() > 0
    parts = text["crossqueue"]["caller_parts"]
    assert sum(p["rows"] for p in parts) == len(callers) and all((folder / "callers" / p["file"]).exists() for p in parts)
    listed = [json.loads(line)["caller_number_norm"] for p in parts for line in (folder / "callers" / p["file"]).read_text().splitlines()]
    assert listed == [c for _, c in callers] and [p["first"] for p in parts][0] == listed[0] and [p["last"] for p in parts][-1] == listed[-1]
    broken = doc.selectExpr("'month' AS report", "replace(document, '\"period\":\"month\"', '\"period\":7') AS document")
    assert [tuple(r) for r in shape_violations(broken, rules, "report").collect()] == [("month", "period", "string", "number")]


def test_strict_run_ends_without_publishing(spark, tmp_path):
    from callgrid.operators.validate import rejected_legs, rejected_stats
    from callgrid.plans.run import run_csv_period
    from callgrid.sinks.store import PeriodStore
    from callgrid.sources.testdata import legs_from_tables
    legs, root = legs_from_tables(spark, "/root/testdata/sf0.001"), str(tmp_path)
    assert rejected_legs(legs).count() == 0
    assert run_csv_period(spark, legs, "2024-01-01", "2024-01-31", root, strict=True).run_id
    kept = PeriodStore(spark, root).read("curated_calls").count()
    broken = legs.withColumn("call_time", F.when(F.col("leg_no") % 50 == 7, "31/31/2024").otherwise(F.col("call_time")))
    failed = run_csv_period(spark, broken, "2024-01-01", "2024-01-31", root, strict=True)
    assert failed.run_id is None and {g["reason"] for g in failed.gaps} == {"bad_call_time"}
    rows = failed.tables["rejected_rows"].collect()
    assert len(rows) == legs.where("leg_no % 50 = 7").count() and {(r["column"], r.value) for r in rows} == {("call_time", "31/31/2024")}
    assert PeriodStore(spark, root).read("curated_calls").count() == kept
    stats = spark.createDataFrame([('{"8020": {"calls_offered": "12.0", "call_volume": "many", "calls_handled": null}}',)], "value string")
    assert [tuple(r) for r in rejected_stats(stats).collect()] == [("8020", "call_volume", "many", "not_a_number")]
