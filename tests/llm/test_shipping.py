"""Executors need the installed third-party libraries but not this package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", {work!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from trailmark.llm.queries import QUERIES
for name, query in QUERIES.items():
    query(spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_all_queries_run_where_executors_lack_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    text = SCRIPT.format(repo=repo, work=str(tmp_path / "work"), sf="/root/testdata/sf0.001")
    done = subprocess.run([sys.executable, "-c", text], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("done op") == 13
