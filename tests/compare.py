"""Runs registered queries in Spark and DuckDB and compares rows and values.

``python tests/compare.py FOLDER [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{folder}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows_of(rows, names: list[str]) -> list[tuple]:
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(names)} against {sorted(df.columns)}"
    expected = rows_of(result.fetchall(), names)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if len(expected) != len(got):
        return f"{len(got)} rows, expected {len(expected)}; extra {[r for r in got if r not in set(expected)][:2]} " \
               f"missing {[r for r in expected if r not in set(got)][:2]}"
    wrong = [(g, e) for g, e in zip(got, expected) if repr(g) != repr(e)]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]} columns {sorted(names)}" if wrong else None


def main() -> None:
    from lotwise.catalog.registry import ENTRIES
    from lotwise.session import build_session
    folder, names = sys.argv[1], sys.argv[2:] or list(ENTRIES)
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "12g", "spark.log.level": "ERROR"})
    con, bad = duck(folder), 0
    for name in names:
        entry, start = ENTRIES[name], time.time()
        try:
            df = entry.run(spark, folder)
            if entry.body is None:
                message = f"rows only: {len(df.collect())}"
                spark_time = time.time() - start
            else:
                df.collect()
                spark_time = time.time() - start
                message = difference(df, con, entry.sql())
                bad += message is not None
        except Exception:
            message, bad, spark_time = traceback.format_exc()[-1500:], bad + 1, 0
        print(f"{name:32s} {spark_time:6.2f}s {time.time() - start:6.2f}s {message or 'equal'}", flush=True)
    print(f"{bad} of {len(names)} wrong")


if __name__ == "__main__":
    main()
