"""Operators run where only the driver can import this package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("query", ["op4_decontamination"])
def test_workers_need_not_have_the_package(tmp_path, query):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from lotwise.session import build_session
from lotwise.llm.queries import QUERIES
spark = build_session("workers", "local[2]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.sql.shuffle.partitions": 2}})

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("lotwise") is not None] * batch.num_rows)], ["found"])
assert not spark.range(1).mapInArrow(importable, "found boolean").first().found
assert QUERIES[{query!r}](spark, "/root/testdata/sf0.001").count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], timeout=300, cwd=tmp_path, env=env).returncode == 0
