"""Tasks run on workers that cannot import this package."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = "/root/testdata/sf0.001"
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
def importable(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("slowtide") is not None])], ["x"])
assert not spark.range(1).mapInArrow(importable, "x boolean").first()[0]
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
for name in sys.argv[3:]:
    entry.queries()[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_queries_run_without_the_package_on_workers(tmp_path):
    names = [f"op{k}_" for k in (1, 2, 6, 7, 8, 10, 11, 12, 13)]
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    wanted = [*(q for q in entry.queries() if q.startswith(tuple(names))), "pipeline"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, SF_DIR, *wanted], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.stdout.split("\n")[:-1] == [f"ran {q}" for q in wanted], ran.stderr[-2000:]
