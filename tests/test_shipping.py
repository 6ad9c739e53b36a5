"""Workers get the package from the driver: no PYTHONPATH, a foreign working directory."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate()
print("ROWS", entry.queries()["knn_suspects"](spark, sys.argv[2]).count())
spark.stop()
"""


def test_workers_import_the_package(tmp_path, sf_dir):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", CODE, REPO, sf_dir, str(tmp_path / "shared")],
        cwd=tmp_path,
        env=env | {"PYSPARK_PYTHON": sys.executable},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "ROWS" in run.stdout, run.stderr[-2000:]
