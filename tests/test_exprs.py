"""Scalar functions (F-1…F-20, P-5…P-9) on literal inputs."""

import pytest
from pyspark.sql import functions as F

from callgrid.functions import exprs as X


def _one(spark, col_expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col_expr.alias("r")).first()["r"]


def test_to_seconds(spark):
    cases = {"00:31": 31.0, "12:07": 727.0, "2:10:45": 7845.0, "871ms": None, "": None, None: None,
             "soon": None, "9:8:7:6": None, "  03:00 ": 180.0, "104:00": 6240.0}
    for text, want in cases.items():
        assert _one(spark, X.to_seconds("x"), text) == want, text
        assert _one(spark, X.to_seconds(F.col("x")), text) == want, text


def test_parse_call_time(spark):
    got = _one(spark, X.parse_call_time("x"), "11/23/2025 7:05 am")
    assert str(got) == "2025-11-23 07:05:00"
    assert str(_one(spark, X.parse_call_time("x"), "02/28/2025 12:59 pm")) == "2025-02-28 12:59:00"


def test_bad_time_text_fails_the_csv_pipeline(spark):
    from callgrid.operators.curate import csv_pipeline
    from callgrid.schemas import RAW_LEG_COLUMNS
    legs = spark.createDataFrame([(1, "8020", "k1", "11/23/2025 7:05 am"), (2, "8020", "k2", "yesterday")],
                                 "leg_no long, queue_id string, orig_call_id string, call_time string")
    legs = legs.select(*[F.col(c) if c in legs.columns else F.lit(None).cast("string").alias(c) for c in RAW_LEG_COLUMNS])
    with pytest.raises(Exception):
        csv_pipeline(legs, "2025-11-01", "2025-11-30").collect()
    assert csv_pipeline(legs.filter("leg_no = 1"), None, None).count() == 1


def test_normalize_caller(spark):
    df = spark.createDataFrame(
        [("(647) 555.0188", "k1"), ("+44 20 7946 0018", "k2"), ("RESTRICTED", "a"), (None, "b"), ("Anonymous", "c"),
         ("\t", "d")], "n string, k string")
    got = [r[0] for r in df.select(X.normalize_caller("n", "k")).collect()]
    assert got == ["6475550188", "442079460018", "__restricted__:a", "__restricted__:b", "__restricted__:c",
                   "__restricted__:d"]


def test_text_cleaning(spark):
    assert _one(spark, X.clean_text("x"), "  Agent A\t") == "Agent A"
    assert _one(spark, X.clean_text("x"), " null ") is None
    assert _one(spark, X.clean_text("x"), "   ") is None
    assert _one(spark, X.valid_agent_name("x"), None) is False
    assert _one(spark, X.valid_agent_name("x"), "NULL") is False
    assert _one(spark, X.valid_agent_name("x"), "Agent") is True


def test_sip_number(spark):
    assert _one(spark, X.sip_number("x"), "sip:+16135550100@pbx.example.net;user=phone") == "+16135550100"
    assert _one(spark, X.sip_number("x"), "SIP:200@host") == "200"
    assert _one(spark, X.sip_number("x"), " 613-555-0100 ") == "613-555-0100"


def test_coerce_seconds_and_loose_numbers(spark):
    assert _one(spark, X.coerce_seconds("x"), "12") == 12.0
    assert _one(spark, X.coerce_seconds("x"), "12.5") == 12.5
    assert _one(spark, X.coerce_seconds("x"), "01:05") == 65.0
    assert _one(spark, X.coerce_seconds("x"), "true") is None
    assert _one(spark, X.loose_int("x"), "12.9") == 12
    assert _one(spark, X.loose_int("x"), None) == 0
    assert _one(spark, X.loose_float("x"), "oops") == 0.0


def test_safe_ratio_and_json_number(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(X.safe_ratio("a", "b")).collect()] == [0.0, 0.25]
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "x double")
    assert [r[0] for r in nan.select(X.json_number("x")).collect()] == [None, None, 2.0]


def test_answered_predicate_variants(spark):
    df = spark.createDataFrame([("A", "Term: Bye", None), ("A", " No Answer ", None), (" ", "x", None)],
                               "agent_name string, queue_release_reason string, agent_release_reason string")
    got = [r[0] for r in df.select(X.answered(df.columns)).collect()]
    assert got == [True, False, False]
    sec = spark.createDataFrame([(0.0,), (None,), (3.0,)], "agent_sec double")
    assert [r[0] for r in sec.select(X.answered(sec.columns)).collect()] == [False, False, True]


def test_non_human_agent(spark):
    df = spark.createDataFrame([("IVR System",), ("CSH - Builds",), ("Main Queue",), ("Agent 7",)], "n string")
    assert [r[0] for r in df.select(X.non_human_agent("n")).collect()] == [True, True, True, False]


def test_plain_clock_texts_read_alike(spark):
    """plain MM:SS texts take a short way that gives what the general form gives."""
    texts = ["00:53", "1:2", "999999999:59", "1234567890:00", "00:53\n", " 00:53 ", "00:5x", "1:02:03", "+1:02", "53ms", "", None, ":5", "5:", "٣:٤", "0:-1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    plan = df.select(X.to_seconds("t").alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" in plan
    assert [r.s for r in df.select("i", X.to_seconds("t").alias("s")).orderBy("i").collect()] == [
        r.s for r in df.select("i", X.to_seconds(F.col("t")).alias("s")).orderBy("i").collect()]
