"""Sinks and file sources: versioned period replace (SNK-5…7, T20), CSV source (S-1, S-2),
landed extracts (SNK-1, S-3, S-4, S-6), CSV export (SNK-11)."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from callgrid.operators import api_curate as A
from callgrid.operators.curate import csv_pipeline
from callgrid.operators.cube import calls_cube, headline
from callgrid.operators.stats import stats_document_from_legs
from callgrid.schemas import CSV_HEADER_TO_COLUMN, DEFAULT_QUEUES, queue_dim
from callgrid.sinks.export import export_file_name, export_text, write_csv
from callgrid.sinks.landing import choose_extract, extract_complete, land_extract
from callgrid.sinks.store import PeriodStore
from callgrid.sources.api_records import read_records
from callgrid.sources.csv_legs import find_queue_csv, load_csv_legs
from callgrid.sources.testdata import events_to_api_records, legs_from_tables, read_events

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="callgrid-test-")


def test_period_replace_roundtrip(spark):
    store = PeriodStore(spark, _tmp())
    cur = E.queries()["curated_calls"](spark, SF).withColumn("date", F.to_date("date"))
    n = cur.count()
    store.replace({"curated_calls": cur}, "2024-01-01", "2024-01-31", "csv")
    assert store.read("curated_calls").count() == n
    # a rerun is idempotent
    store.replace({"curated_calls": cur}, "2024-01-01", "2024-01-31", "csv")
    assert store.read("curated_calls").count() == n
    # a failed run (tables written, never published) leaves the old version visible
    store.write("curated_calls", cur.limit(3), "2024-01-01", "2024-01-31", "failed-run")
    assert store.read("curated_calls").count() == n
    # another period is independent; an empty replacement empties only its period
    store.replace({"curated_calls": cur.limit(5)}, "2024-02-01", "2024-02-29", "csv")
    store.replace({"curated_calls": cur.limit(0)}, "2024-01-01", "2024-01-31", "csv")
    got = store.read("curated_calls").groupBy("period_start").count().collect()
    assert {r.period_start: r["count"] for r in got} == {"2024-02-01": 5}


def test_csv_source_matches_adapter(spark):
    d = _tmp()
    legs = legs_from_tables(spark, SF)
    back = {v: k for k, v in CSV_HEADER_TO_COLUMN.items()}
    pdf = legs.orderBy("leg_no").toPandas()
    for q in DEFAULT_QUEUES:
        part = pdf[pdf.queue_id == q.queue_id][list(back)].rename(columns=back)
        part.insert(0, "", range(len(part)))  # blank header column, dropped on read
        part.to_csv(os.path.join(d, f"calls_{q.queue_id}_2024-01.csv"), index=False)
    assert find_queue_csv(spark, d, "8020").endswith("calls_8020_2024-01.csv")
    assert find_queue_csv(spark, d, "9999") is None
    raw, gaps = load_csv_legs(spark, d)
    assert gaps == []
    dim = queue_dim(spark)
    from_files = headline(calls_cube(csv_pipeline(raw, "2024-01-01", "2024-01-31")), dim)
    from_adapter = E.queries()["headline"](spark, SF)
    assert sorted(from_files.collect()) == sorted(from_adapter.collect())


def test_duplicate_queue_file_is_an_error(spark):
    d = _tmp()
    for name in ("a_8020_x.csv", "b_8020_y.csv"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("Call Time,Orig CallID\n04/01/2026 8:33 am,a\n")
    with pytest.raises(ValueError, match="Multiple CSV files"):
        find_queue_csv(spark, d, "8020")


def test_landed_extract_roundtrip(spark):
    root = _tmp()
    assert choose_extract(spark, root, "2024-01-01", "2024-01-31") == "land"
    with pytest.raises(FileNotFoundError):
        choose_extract(spark, root, "2024-01-01", "2024-01-31", "reuse")
    events = read_events(spark, SF)
    recs = events_to_api_records(events)
    stats = stats_document_from_legs(legs_from_tables(spark, SF))
    path = land_extract(recs, stats, root, "month", "2024-01-01", "2024-01-31", order_by="rec_no")
    assert extract_complete(spark, root, "2024-01-01", "2024-01-31")
    assert choose_extract(spark, root, "2024-01-01", "2024-01-31") == "reuse"
    landed = read_records(spark, f"{path}/records")
    curated, _, _ = A.api_pipeline(landed, start="2024-01-01", end="2024-01-31")
    assert curated.count() == E.queries()["api_curated"](spark, SF).count()


def test_csv_export_quoting(spark):
    d = _tmp()
    df = spark.createDataFrame([("a,b", 'say "hi"', None, 3.0), ("x", "y", "z", 0.25)],
                               "c1 string, c2 string, c3 string, n double")
    write_csv(df.select("c1", "c2", "c3", export_text(F.col("n").cast("variant")).alias("value")),
              os.path.join(d, "out"), ["c1", "c2", "c3", "value"])
    text = "".join(open(f).read() for f in sorted(glob.glob(os.path.join(d, "out", "*.csv"))))
    assert '"a,b","say ""hi""",,3' in text and "x,y,z,0.25" in text
    assert export_file_name("2024-01-01", "2024-01-31") == "queue-analytics-2024-01-01_2024-01-31.csv"


def test_run_csv_period_publishes_all_tables(spark):
    from callgrid.plans.run import run_csv_period
    root = _tmp()
    legs = legs_from_tables(spark, SF)
    res = run_csv_period(spark, legs, "2024-01-01", "2024-01-31", store_root=root)
    store = PeriodStore(spark, root)
    n = E.queries()["curated_calls"](spark, SF).count()
    assert store.read("curated_calls").count() == n
    assert store.read("queue_hourly_metrics").agg(F.sum("calls")).first()[0] == n
    assert store.read("anomalies").count() == E.queries()["anomalies_all"](spark, SF).count()
    assert res.tables["run_validation"].first().answered_plus_no_agent_reconciles


def test_run_api_period(spark):
    from callgrid.plans.run import run_api_period
    from callgrid.sources.testdata import api_records_from_tables
    root = _tmp()
    recs = api_records_from_tables(spark, SF)
    stats = stats_document_from_legs(legs_from_tables(spark, SF))
    inv = _tmp()
    res = run_api_period(spark, recs, stats, "2024-01-01", "2024-01-31", store_root=root, inventory_root=inv)
    assert PeriodStore(spark, root).read("curated_calls").count() == E.queries()["api_curated"](spark, SF).count()
    assert res.tables["api_stats_funnel"].count() == 2
    assert sorted(n for n in os.listdir(inv) if n.endswith(".json")) == ["field_inventory_2024-01-01_2024-01-31.json", "field_inventory_latest.json"]
    dated = spark.read.json(os.path.join(inv, "field_inventory_2024-01-01_2024-01-31.json")).first()
    latest = spark.read.json(os.path.join(inv, "field_inventory_latest.json")).first()
    assert (dated.date_range.start, dated.date_range.end) == ("2024-01-01", "2024-01-31")
    assert dated.validation.status == "success" and dated.validation.deduped_count == latest.validation.deduped_count
    assert dated.field_count == latest.field_count == 30


def test_empty_store_and_inventory_document(spark):
    from callgrid.sinks.export import write_inventory_document
    from callgrid.operators.flatten import field_inventory
    from callgrid.sources.testdata import api_records_from_tables
    store = PeriodStore(spark, _tmp())
    assert store.read("curated_calls").count() == 0
    d = _tmp()
    inv = field_inventory(api_records_from_tables(spark, SF))
    for _ in range(2):  # the second replaces the first
        write_inventory_document(inv, os.path.join(d, "inv.json"), "2024-01-01", "2024-01-31")
    assert [n for n in os.listdir(d) if not n.endswith(".crc")] == ["inv.json"]
    doc = spark.read.json(os.path.join(d, "inv.json")).first()
    assert doc.field_count == len(doc.fields) == inv.count()
    assert list(doc.fields) == sorted(doc.fields) and doc.validation.status == "success"


def test_run_api_from_extract_reuses_snapshot(spark):
    from callgrid.plans.run import run_api_from_extract
    land, store = _tmp(), _tmp()
    calls = []

    def fetch():
        calls.append(1)
        return (events_to_api_records(read_events(spark, SF)).orderBy("rec_no"),
                stats_document_from_legs(legs_from_tables(spark, SF)))

    first = run_api_from_extract(spark, land, "2024-01-01", "2024-01-31", fetch, store_root=store)
    second = run_api_from_extract(spark, land, "2024-01-01", "2024-01-31", fetch, store_root=store)
    assert len(calls) == 1  # the second run reused the complete snapshot
    assert first.tables["curated_calls"].count() == second.tables["curated_calls"].count() > 0


def test_retire_old_versions(spark):
    from callgrid.sinks.store import retire_versions
    store = PeriodStore(spark, _tmp())
    cur = E.queries()["curated_calls"](spark, SF).withColumn("date", F.to_date("date"))
    n = cur.count()
    store.replace({"curated_calls": cur}, "2024-01-01", "2024-01-31", "csv")
    store.replace({"curated_calls": cur}, "2024-01-01", "2024-01-31", "csv")
    removed = retire_versions(store, "curated_calls")
    assert len(removed) == 1
    assert store.read("curated_calls").count() == n
    assert retire_versions(store, "curated_calls") == []


def test_csv_quoted_line_breaks(spark):
    from callgrid.schemas import DEFAULT_QUEUES
    from callgrid.sources.csv_legs import load_queue_csv
    d = _tmp()
    path = os.path.join(d, "x_8020_y.csv")
    with open(path, "w") as fh:
        fh.write('Call Time,Orig CallID,Agent Name,Queue Release Reason\n'
                 '04/01/2026 8:33 am,a,"Agent\nA",NA\n04/01/2026 9:00 am,b,B,Orig: Bye\n')
    rows = load_queue_csv(spark, path, DEFAULT_QUEUES[0]).orderBy("orig_call_id").collect()
    assert [r.orig_call_id for r in rows] == ["a", "b"]
    assert rows[0].agent_name == "Agent\nA" and rows[0].queue_release_reason is None  # NA token -> null
    assert rows[0].leg_no < rows[1].leg_no and rows[1].queue_id == "8020"


def test_half_landed_refresh_leaves_the_old_snapshot(spark):
    from callgrid.sinks.landing import snapshot_path
    root = _tmp()
    one = spark.createDataFrame([('{"a": 1}',)], "value string")
    stats = spark.createDataFrame([('{"8020": {}}',)], "value string")
    first = land_extract(one, stats, root, "month", "2025-01-01", "2025-01-31")
    broken = stats.select(F.raise_error(F.lit("source went away")).cast("string").alias("value"))
    with pytest.raises(Exception, match="source went away"):
        land_extract(one.union(one), broken, root, "month", "2025-01-01", "2025-01-31")
    assert snapshot_path(spark, root, "2025-01-01", "2025-01-31") == first
    assert spark.read.text(f"{first}/records").count() == 1
    manifest = spark.read.json(f"{first}/manifest").first()
    assert (manifest.record_count, manifest.queue_stats_count, manifest.queues_included) == (1, 1, ["8020"])


def test_exports_with_other_column_orders_in_one_scan(spark):
    """Each export is read under its own header; one has no agent column, one a blank one."""
    d = _tmp()
    files = {"8020": "Call Time,Orig CallID,Agent Name\n04/01/2026 8:33 am,a,Ann\n",
             "8021": "Agent Name,,Orig CallID,Call Time\nBob,junk,b,04/01/2026 9:00 am\nNA,,c,04/01/2026 9:30 am\n",
             "8030": "Orig CallID,Call Time\nd,04/01/2026 10:00 am\n"}
    for q, text in files.items():
        with open(os.path.join(d, f"calls_{q}_2026-04.csv"), "w") as fh:
            fh.write(text)
    legs, gaps = load_csv_legs(spark, d)
    assert [g["queue_id"] for g in gaps] == ["8031"]
    assert legs._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert {(r.queue_id, r.orig_call_id, r.call_time[-7:].strip(), r.agent_name, r.role) for r in legs.collect()} == {
        ("8020", "a", "8:33 am", "Ann", "primary"), ("8021", "b", "9:00 am", "Bob", "primary"),
        ("8021", "c", "9:30 am", None, "primary"), ("8030", "d", "0:00 am", None, "overflow")}


def test_export_text_of_every_kind(spark):
    cases = {'"a b"': "a b", "3": "3", "3.0": "3", "0.25": "0.25", "0.00001": "0.00001", "-2.5": "-2.5", "true": "true", "false": "false",
             "null": "", '{"b":[1,"x"],"a":null}': '{"a":null,"b":[1,"x"]}', "[1,2]": "[1,2]", '""': ""}
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "c string")
    got = {r.c: r.t for r in df.select("c", export_text(F.parse_json("c")).alias("t")).collect()}
    assert got == cases | {None: ""}


def test_one_export_file_is_replaced_whole(spark):
    from callgrid.sinks.export import write_csv_file
    d = _tmp()
    df = spark.createDataFrame([("b", " x,\n"), ("a", None)], "k string, v string").repartition(2)
    for _ in range(2):
        path = write_csv_file(df, d, "2024-01-01", "2024-01-31", ["v", "k"], ["k"])
    assert [n for n in os.listdir(d) if not n.endswith(".crc")] == ["queue-analytics-2024-01-01_2024-01-31.csv"]
    assert open(path).read() == 'v,k\n,a\n" x,\n",b\n'
