"""Tasks need no copy of the package: a session started elsewhere, without PYTHONPATH."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
for name in sys.argv[1:]:
    rows = e.queries()[name](spark, "/root/testdata/sf0.001").collect()
    print("rows", name, len(rows))
"""


def test_queries_run_from_a_foreign_folder(tmp_path):
    names = ["op3_compression_toxicity", "op7_repeat_intervals", "op11_weak_quality", "op12_fill_in_middle", "op13_merkle_manifest"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    told = [line.split()[1:] for line in done.stdout.splitlines() if line.startswith("rows")]
    assert told == [[n, "200"] for n in names], done.stderr[-2000:]
