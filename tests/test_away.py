"""Functions that run in tasks travel with the job, wherever the session was started."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
rows = entry.queries()["correlation_matrix"](spark, {sf!r}).collect()
assert len(rows) == 66, len(rows)
"""


def test_correlation_from_another_folder(sf_dir, tmp_path):
    code = CODE.format(repo=str(REPO), sf=sf_dir)
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)
