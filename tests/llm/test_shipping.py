import os
import subprocess
import sys


def test_workers_need_no_path(tmp_path):
    """From a folder and an environment in which workers find no package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from tickforge.llm.fingerprints import fingerprint
print("ROWS", fingerprint(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]
