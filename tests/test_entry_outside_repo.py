"""The driver imports __spark_entry__ from elsewhere: Python-worker code (the stream) must not
depend on the working directory."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
print("ENTRY", E.entry(spark).count())
print("STREAM", E.queries()["rolling_buffer_stream"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_stream_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith(("ENTRY", "STREAM"))]
    assert lines == ["ENTRY 20", "STREAM 75"], out.stderr[-3000:]
