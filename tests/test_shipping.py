"""Executor-side Python finds docflow even when the driver runs elsewhere."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from docflow.operators.deliver import deliver


class Once:
    def send(self, host, target, body, key, attempt):
        if attempt < 2:
            raise ConnectionError("first try")


rows = spark.range(0, 6).select(F.col("id"), F.lit("/t").alias("target"), F.lit("b").alias("body"))
rep = deliver(rows, id_col="id", target_col="target", body_col="body", hosts=["http://h:1"],
              transport_factory=Once, retry_wait_s=0)
print("DELIVERED", rep.filter("status = 'delivered'").count())
spark.stop()
"""


def test_python_steps_run_from_another_directory():
    with tempfile.TemporaryDirectory() as cwd:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                             text=True, timeout=600)
    assert "DELIVERED 6" in res.stdout, res.stderr[-2000:]
