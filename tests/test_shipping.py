"""Workers get the package from the driver, wherever the driver runs."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
CODE = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", __spark_entry__.queries()["q13_page_body"](spark, "/root/testdata/sf0.001").count())
"""


def test_from_another_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 50" in out.stdout, out.stderr[-2000:]
