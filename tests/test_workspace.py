"""The shared folder of a session that nobody configured."""

import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
from tickloom.workspace import new_folder, shared_folder
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
path = new_folder(spark, "rows")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
assert shared_folder(spark) == shared_folder(spark) and path.startswith(shared_folder(spark))
print("ok")
"""


def test_plain_local_session(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("ok"), done.stderr[-2000:]
