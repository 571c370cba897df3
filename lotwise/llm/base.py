"""Reading the tables, identities of rows, and frames written once for later jobs."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.session import scratch_path, stored

__all__ = ["annotated", "held_out", "join_counted", "placed", "read", "scratch_path", "stored"]

HOT_KEYS = 1000        # at most so many keys are broadcast as hot ones
HOT_ROWS = 100         # a key with fewer rows is never hot
PLACED_ROWS = 1 << 16  # rows per task where rows are put in order


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id's text leaves the remainder ``fold``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds) == F.lit(fold)


def annotated(docs: DataFrame, keep: list[str], compute, fields: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and new columns that ``compute`` makes of whole texts, in one scan.

    ``compute`` gets an Arrow column of texts and returns one Arrow array per field. New columns take the
    place of kept ones with the same name.
    """
    made = docs.sparkSession.createDataFrame([], fields).schema
    new = [f.name for f in made]
    keep = [k for k in keep if k not in new]
    inner = docs.select(F.col(f"`{text}`").cast("string").alias("_text"),
                        *(F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(k for k in keep if k != text)))
    others = [k for k in keep if k != text]
    passed = (["_text"] if text in keep else []) + [f"_{i}" for i in range(len(others))]
    kinds = {f.name: f.dataType.simpleString() for f in inner.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in passed] +
                       [f"_new{i} {f.dataType.simpleString()}" for i, f in enumerate(made)])
    names = passed + [f"_new{i}" for i in range(len(new))]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in passed] + compute(batch.column("_text")), names)
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks; its buffers need not

    out = inner.mapInArrow(run, schema)
    place = {k: f"_{i}" for i, k in enumerate(others)} | {text: "_text"}
    return out.select(*(F.col(place[k]).alias(k) for k in keep), *(F.col(f"_new{i}").alias(n) for i, n in enumerate(new)))


def join_counted(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of ``rows`` to ``groups``: one row per key, whose column ``count`` tells how many of ``rows`` have it.

    A key is hot if it has more than one ``HOT_KEYS``-th of all rows, so there are fewer than ``HOT_KEYS`` hot keys. These are
    broadcast and their rows stay where they are; no other key brings many rows into one task. Both frames are read twice.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    limit = max(total // HOT_KEYS, HOT_ROWS)
    marked = rows.join(F.broadcast(groups.where(F.col(count) > limit)), key, "left")
    rest = marked.where(F.col(count).isNull()).select(*rows.columns)
    return marked.where(F.col(count).isNotNull()).unionByName(rest.join(groups.where(F.col(count) <= limit).hint("merge"), key, "left"))


def placed(rows: DataFrame, group: str, order: list[str], place: str, name: str) -> DataFrame:
    """Stores ``rows`` with their 0-based ``place`` in their ``group`` (a column without NULL) by the columns ``order``.

    Rows are range-partitioned by group and order, so a group of any size is numbered by many tasks. A partition's first group
    alone can have rows in earlier partitions; their numbers, one row per partition at most, are broadcast.
    """
    parts = rows.count() // PLACED_ROWS + 1
    sort = [group, *order]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _part int, _at long"

    def number(batches):
        import numpy as np
        import pyarrow as pa
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group).to_pylist()
            at = np.empty(len(groups), np.int64)
            for k, g in enumerate(groups):
                seen = seen + 1 if g == last else 0
                at[k], last = seen, g
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(groups), part, np.int32)), pa.array(at)],
                                             [*batch.schema.names, "_part", "_at"])

    numbered = stored(rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).mapInArrow(number, kinds), name)
    sizes = numbered.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(group, "_part", F.sum("_n").over(earlier).alias("_before")).where("_before > 0")
    return (numbered.join(F.broadcast(before), [group, "_part"], "left")
            .select(*rows.columns, (F.coalesce("_before", F.lit(0)) + F.col("_at")).alias(place)))
