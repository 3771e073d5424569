"""Executors have no copy of the package: functions and broadcast values travel by value."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def package_is_missing(_):
    try:
        import colloquy
    except ImportError:
        return [True]
    return [False]

assert all(spark.sparkContext.parallelize(range(2), 2).mapPartitions(package_is_missing).collect()), "workers see the package"
sys.path.insert(0, sys.argv[1])
from colloquy.llm import ann, tokens, whitening

docs = spark.createDataFrame([(1, "abc ab"), (2, None)], "doc_id long, text string")
print(sorted(tuple(r) for r in tokens.token_counts(docs, ["\\u2581a", "bc", "b"]).collect()))
vectors = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(40)], "vec_id long, embedding array<double>")
print(ann.nearest(vectors, F.col("vec_id") % 20 == 0, 3).count())
print(whitening.whiten(vectors, 2).count())
"""


def test_workers_need_no_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split("\n")[-4:] == ["[(1, 2, 4, 0), (2, 0, 0, 0)]", "6", "80", ""]
