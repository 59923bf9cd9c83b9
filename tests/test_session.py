"""A plain local session, without the site's settings: nothing names a shared folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
from callgrid.session import ensure_checkpoint_dir, get_session, materialize
spark = get_session("local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
folder = ensure_checkpoint_dir(spark)
assert ensure_checkpoint_dir(spark) == folder and spark.sparkContext.getCheckpointDir()
df = materialize(spark.range(3).selectExpr("id", "id * 2 AS twice"), "plain")
assert folder in df.inputFiles()[0] and sorted(r.twice for r in df.collect()) == [0, 2, 4]
print("fine")
"""


def test_session_without_a_checkpoint_folder(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", JOB], env=env, capture_output=True, text=True, timeout=240)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
