"""Executors need no copy of the package: what runs there travels with the task."""

import os
import subprocess
import sys
from pathlib import Path

ENTRY = Path(__file__).resolve().parents[2] / "__spark_entry__.py"
ELSEWHERE = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", "{entry}")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
spark.conf.set("spark.sql.shuffle.partitions", "2")
for name, run in entry.queries().items():
    if name.startswith("op"):
        print("ran", name, run(spark, "{sf}").count(), flush=True)
"""


def test_every_query_runs_in_a_session_started_elsewhere(sf_dir, tmp_path):
    env = dict(os.environ)
    env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and str(ENTRY.parent) != p)
    done = subprocess.run(
        [sys.executable, "-c", ELSEWHERE.format(entry=ENTRY, sf=sf_dir)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900,
    )
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert len(ran) >= 13, done.stderr[-3000:]
