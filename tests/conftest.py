import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from callgrid.session import get_session
    return get_session("local[4]", app_name="callgrid-tests", shuffle_partitions=4)


@pytest.fixture(scope="session")
def curated_fixture(spark):
    """Eight curated calls of one queue over three days: two agents, a named agent without talk time,
    a caller with three calls and a withheld number."""
    from pyspark.sql import functions as F
    rows = [
        ("2025-03-03", 7, "Monday", "p1", "Noor", 120.0, 4.0, 0.0, "4165550111", "Term: Bye", "Handled"),
        ("2025-03-03", 7, "Monday", "p2", None, 0.0, 31.0, 0.0, "4165550112", "Abandoned", "No Agent"),
        ("2025-03-03", 13, "Monday", "p3", "Noor", 60.0, 12.0, 5.0, "4165550111", "Orig: Bye", "Handled"),
        ("2025-03-04", 13, "Tuesday", "p4", "Ines", 200.0, 6.0, 15.0, "4165550113", "Term: Bye", "Handled"),
        ("2025-03-06", 13, "Thursday", "p5", None, 0.0, 8.0, 0.0, "__restricted__:p5", "Abandoned", "No Agent"),
        ("2025-03-06", 18, "Thursday", "p6", "Noor", 90.0, 2.0, 0.0, "4165550111", "Orig: Bye", "Handled"),
        ("2025-03-06", 18, "Thursday", "p7", "Idle Desk", 0.0, 40.0, 0.0, "4165550114", "No Answer", "Handled"),
        ("2025-03-06", 18, "Thursday", "p8", None, 0.0, 20.0, 0.0, "4165550115", "No Answer", "No Agent"),
    ]
    df = spark.createDataFrame(rows, "date string, hour int, dow string, call_id string, agent_name string, "
                                     "agent_sec double, queue_sec double, hold_sec double, caller_number_norm string, "
                                     "reason string, handled_flag string")
    return df.select(
        F.lit("8020").alias("queue_id"), F.lit("CSR English").alias("queue_name"), F.lit("English").alias("language"),
        F.lit("primary").alias("role"), "call_id", F.to_date("date").alias("date"), "hour", "dow", "agent_name",
        "agent_sec", "queue_sec", "hold_sec", "caller_number_norm",
        F.col("reason").alias("queue_release_reason"), F.col("reason").alias("agent_release_reason"), "handled_flag")
