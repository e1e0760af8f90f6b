import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from sedimenta.operators.tokenise import tokenised
from sedimenta.session import ship
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
ship(spark)
ship(spark)
df = spark.createDataFrame([(1, "a", "", "b")], "ordinal long, instruction string, input string, output string")
print("rows", len(tokenised(df).collect()))
"""


def test_workers_elsewhere_can_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120, check=False)
    assert "rows 1" in run.stdout, run.stderr[-2000:]
