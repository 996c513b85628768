"""Workers have the third-party libraries only: the package is on the driver's path, not on theirs."""

import os
import subprocess
import sys

import pytest
from conftest import DATA, ROOT

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.memory", "2g").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from bazaarmill.llm.queries import QUERIES
for name in sys.argv[3:]:
    print(name, QUERIES[name](spark, sys.argv[2]).count())
"""


@pytest.mark.parametrize("names", [["op3_language_id", "op6_pseudonyms", "op12_quality"], ["op4_decontaminate", "op7_main_text", "op13_centroids"]], ids=str)
def test_package_by_value(names, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, ROOT, DATA, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names
