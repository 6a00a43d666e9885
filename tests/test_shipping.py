import os
import subprocess
import sys

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
import numpy as np
from vecshoal.functions.encode import HashingEncoder, encode_text
from vecshoal.operators import kmeans, mixture, search
from vecshoal.session import local_session
from pyspark.sql import functions as F

spark = local_session("2", **{{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "1g"}})
rng = np.random.default_rng(0)
rows = [(f"i{{i}}", [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(60, 3)))]
points = spark.createDataFrame(rows, "id string, reduced array<double>, cluster_id int")
kmeans.fit_many(points, [1, 2], restarts=2)
mixture.fit_mixtures(points, [2], max_iter=3)
queries = points.select(F.col("id").alias("query_id"), "cluster_id", "reduced")
print("rows", search.top_k(points, queries, 2, "reduced", keep=()).count())
print("texts", spark.range(3).select(encode_text(F.col("id").cast("string"), lambda: HashingEncoder(4))).collect()[0])
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Run away from the repository, so that Python workers cannot import the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(root=root)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300
    )
    assert "rows 120" in done.stdout and "texts" in done.stdout, done.stderr[-3000:]
