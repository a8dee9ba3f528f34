import os
import subprocess
import sys
from pathlib import Path

from conftest import HEADER

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2] + "/shared").getOrCreate())
from tillmart.sources import file_inventory, validate_headers
print("verdict", validate_headers(spark, file_inventory(spark, sys.argv[2] + "/in")).first()["verdict"])
"""


def test_executors_need_not_have_the_package(tmp_path, write_file):
    write_file("in/a.csv", HEADER + "\n")
    root = str(Path(__file__).resolve().parent.parent)
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path)], cwd=tmp_path, env=env,
        capture_output=True, text=True, timeout=300,
    )
    assert "verdict ok" in done.stdout, done.stderr[-2000:]
