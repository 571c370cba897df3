"""Insert rules and stored tables."""

import datetime as dt
import os
import subprocess
import sys

import pytest

from lotwise.sources import tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
KEYS = ["parking_lot_id", "minute_timestamp"]
SCHEMA = "parking_lot_id int, minute_timestamp timestamp, v int, seq long"


def rows(spark, *items):
    return spark.createDataFrame([(lot, dt.datetime(2024, 1, day, 10), v, s) for lot, day, v, s in items], SCHEMA)


def content(df):
    return sorted((r.parking_lot_id, r.minute_timestamp.day, r.v) for r in df.collect())


def test_insert_ignore_keeps_stored_then_first(spark):
    got = tables.insert_ignore(rows(spark, (1, 1, 10, 1)), rows(spark, (1, 1, 99, 2), (1, 2, 21, 4), (1, 2, 20, 3)), KEYS, ["seq"])
    assert content(got) == [(1, 1, 10), (1, 2, 20)]


def test_upsert_last_write_wins_and_is_idempotent(spark):
    target, batch = rows(spark, (1, 1, 10, 1), (2, 1, 5, 1)), rows(spark, (1, 1, 11, 2), (1, 1, 12, 3), (3, 1, 7, 1))
    once = tables.upsert_latest(target, batch, KEYS, ["seq"])
    assert content(once) == [(1, 1, 12), (2, 1, 5), (3, 1, 7)]
    assert content(tables.upsert_latest(once, batch, KEYS, ["seq"])) == content(once)


def test_equal_order_prefers_the_batch(spark):
    assert content(tables.upsert_latest(rows(spark, (1, 1, 1, 5)), rows(spark, (1, 1, 2, 5)), KEYS, ["seq"])) == [(1, 1, 2)]


def test_unique_append(spark):
    target = rows(spark, (1, 1, 10, 1))
    assert content(tables.unique_append(target, rows(spark, (1, 2, 20, 1)), KEYS)) == [(1, 1, 10), (1, 2, 20)]
    for batch in (rows(spark, (1, 1, 11, 2)), rows(spark, (1, 3, 1, 1), (1, 3, 2, 2))):
        with pytest.raises(Exception, match="duplicate key"):
            tables.unique_append(target, batch, KEYS).collect()


def test_write_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "minute")
    tables.write_upsert(path, rows(spark, (1, 1, 10, 1), (1, 2, 20, 1)), KEYS, ["seq"], "minute_timestamp")
    before = set((tmp_path / "minute" / "date=2024-01-01").glob("*.parquet"))
    tables.write_upsert(path, rows(spark, (1, 2, 21, 2), (2, 2, 30, 1), (1, 3, 40, 1)), KEYS, ["seq"], "minute_timestamp")
    assert content(spark.read.parquet(path)) == [(1, 1, 10), (1, 2, 21), (1, 3, 40), (2, 2, 30)]
    assert set((tmp_path / "minute" / "date=2024-01-01").glob("*.parquet")) == before


def test_materialise_can_be_rerun(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2):
        got = tables.materialise(rows(spark, (1, 1, v, 1)), path, "minute_timestamp", KEYS)
    assert content(got) == [(1, 1, 2)]


def test_scan_pushes_filter_and_columns(spark):
    df = tables.table_scan(spark, "/root/testdata/sf0.001/orders.parquet", ["o_orderkey"], ["o_totalprice > 1000"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,1000" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:" in plan


def test_stored_types(spark):
    df = spark.createDataFrame([(1, 2.345, 10.0)], "parking_lot_id int, avg_free_spaces double, other double")
    got = tables.as_stored(df)
    assert got.schema["avg_free_spaces"].dataType.simpleString() == "decimal(10,2)"
    assert str(got.first().avg_free_spaces) == "2.35"


def test_scratch_folders_are_removed(tmp_path):
    """In a process of its own, for others still read their scratch folders."""
    code = f"""
import os, sys
sys.path.insert(0, {ROOT!r})
from lotwise.session import build_session, clear_scratch, stored
spark = build_session("scratch", "local[1]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}}})
others = os.listdir({str(tmp_path)!r})
assert stored(spark.range(3), "a").count() == 3 and len(os.listdir({str(tmp_path)!r})) == len(others) + 1
clear_scratch(spark)
assert sorted(os.listdir({str(tmp_path)!r})) == sorted(others)
"""
    assert subprocess.run([sys.executable, "-c", code], timeout=120).returncode == 0
