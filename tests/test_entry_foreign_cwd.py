"""The driver imports __spark_entry__.py from another working directory with its own plain
session; Python-worker operators (k-NN kernel, encoders) must still import the package."""

import os
import subprocess
import sys
import tempfile

import duckdb

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
print("ENTRY", m.entry(spark).count())
print("KNN", m.queries()["knn_l2_topk"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_and_python_worker_query_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as cwd:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    lines = [x for x in out.stdout.splitlines() if x.startswith(("ENTRY", "KNN"))]
    ids = [i for (i,) in duckdb.sql("SELECT vec_id FROM '/root/testdata/sf0.001/embeddings.parquet'").fetchall()]
    knn = sum(i % 50 == 0 for i in ids) * min(10, len(ids))  # every query finds k vectors
    assert lines == ["ENTRY 400", f"KNN {knn}"], out.stderr[-2000:]
