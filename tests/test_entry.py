"""The engine without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import __spark_entry__ as e
names = set(e.queries())
assert names and set(e.oracle_sql()) <= names and not any(n.startswith("op") or n == "pipeline" for n in names), names
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
print("rows", e.queries()["s1_scan"](spark, "/root/testdata/sf0.001").count())
"""


def test_without_training_data(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    for pipeline in (True, False):
        if not pipeline:
            os.remove(copy / "corpus_pipeline.py") if (copy / "corpus_pipeline.py").exists() else None
        done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=copy, capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": str(copy)})
        assert done.returncode == 0 and "rows" in done.stdout, done.stderr[-2000:]
