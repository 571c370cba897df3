"""Batch logs: Parquet folders by day and number, written by streams and read by day.

A replayed batch replaces its own folders only, so nothing already written is at risk when a job dies, and the largest
number of a key wins on reading. Readers name the days they want and list no other folder, so a batch costs the same
after a year as on the first day. ``compact_log`` merges the batches of closed days.

Numbers on disk are batch numbers times ``STEP``; a merge takes the next free number above what it merged, so it is newer
than its parts and older than any later batch. Readers that see parts, merge, or half of both read the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lotwise.sources.tables import upsert_latest

Sink = Callable[[DataFrame, int], None]

STEP = 1 << 10
_MERGED = "_merged"      # lists the files whose rows a merge holds
_NUMBERS = "_numbers"


class _Folder:
    """The files of a log, on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._root = path.rstrip("/")
        self.fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *parts: str):
        return self._hadoop.Path("/".join([self._root, *parts]))

    def names(self, *parts: str) -> list[str]:
        """Names below a folder, without hidden ones; none if there is no such folder."""
        if not self.fs.exists(self.at(*parts)):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self.fs.listStatus(self.at(*parts))) if n[0] not in "._")

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.at(*parts))

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.at(*parts), True)

    def write(self, text: str, *parts: str, replace: bool = True) -> None:
        out = self.fs.create(self.at(*parts), replace)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, *parts: str) -> str:
        source = self.fs.open(self.at(*parts))
        try:
            return self._text.toString(source, "UTF-8")
        finally:
            source.close()


def batch_log(path: str, ts: str) -> Sink:
    """Writes a batch under its number; ``ts`` names the column that gives the day."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumns({"date": F.date_format(ts, "yyyy-MM-dd"), "batch_id": F.lit(batch_id * STEP).cast("long")})
         .hint("rebalance", "date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "batch_id").parquet(path))
    return write


def next_number(spark: SparkSession, path: str) -> int:
    """A number above all that were given out for this log, whatever the clocks of the drivers say.

    Writers that share a log take one after logging their input and before reading: who has the larger number has then
    read at least what the other one logged. Taking it is creating a file that must not exist.
    """
    folder = _Folder(spark, path)
    while True:
        given = sorted(int(name) for name in folder.names(_NUMBERS))
        number = given[-1] + 1 if given else 0
        try:
            folder.write("", _NUMBERS, str(number), replace=False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error):
                raise
            continue
        for old in given:      # a later caller sees the new one
            folder.delete(_NUMBERS, str(old))
        return number


def log_days(spark: SparkSession, path: str) -> list[str]:
    """The days that the log holds, from the names of its folders."""
    return [name.removeprefix("date=") for name in _Folder(spark, path).names() if name.startswith("date=")]


def days_of(rows: DataFrame, ts: str, before: int = 0, after: int = 0) -> list[str]:
    """The days of ``rows``, with so many days before and after each; at most one per day of the history."""
    own = [date.fromisoformat(r["d"]) for r in rows.select(F.date_format(ts, "yyyy-MM-dd").alias("d")).distinct().collect() if r["d"]]
    return sorted({(d + timedelta(k)).isoformat() for d in own for k in range(-before, after + 1)})


def read_batches(spark: SparkSession, path: str, schema: StructType, days: Iterable[str] | None = None) -> DataFrame:
    """All logged rows with ``date`` and ``batch_id``; only the folders of ``days`` are listed, if given."""
    full = StructType([*schema.fields]).add("date", "string").add("batch_id", "long")
    reader = spark.read.schema(full).option("basePath", path)
    if days is None:
        return reader.parquet(path)
    folder = _Folder(spark, path)
    held = [f"{path.rstrip('/')}/date={d}" for d in days if folder.exists(f"date={d}")]
    return reader.parquet(*held) if held else spark.createDataFrame([], full)


def read_log(spark: SparkSession, path: str, schema: StructType, keys: list[str],
             days: Iterable[str] | None = None, newest: list[str] | None = None) -> DataFrame:
    """Newest batch per key, or the newest by the columns ``newest``, of the given days or of all."""
    rows = read_batches(spark, path, schema, days)
    return upsert_latest(None, rows, keys, newest or ["batch_id"]).drop("date", "batch_id")


def compact_log(spark: SparkSession, path: str, schema: StructType, keys: list[str], before: str,
                newest: list[str] | None = None) -> list[str]:
    """Merges the batches of each day before ``before`` into one; returns the days merged.

    One of ``keys`` is the time that gives the day. Files that an earlier call has merged are deleted first, so readers
    that have listed them have the time between two calls to end. What a replay writes after its rows were merged is a
    new file, which is not in the merge's list: it stays and enters the next merge. A call that dies leaves at most a
    merge without a list, which the next call treats as a batch. One call at a time.
    """
    folder = _Folder(spark, path)
    parts, top = [], {}
    for day in (d for d in log_days(spark, path) if d < before):
        batches = folder.names(f"date={day}")
        for batch in batches:
            if folder.exists(f"date={day}", batch, _MERGED):
                for name in folder.read(f"date={day}", batch, _MERGED).split():
                    folder.delete(f"date={day}", *name.split("/"))
                folder.delete(f"date={day}", batch, _MERGED)
        files = [f"{batch}/{name}" for batch in batches for name in folder.names(f"date={day}", batch)]
        held = {name.split("/")[0] for name in files}
        for batch in set(batches) - held:
            folder.delete(f"date={day}", batch)
        number = max((int(batch.removeprefix("batch_id=")) for batch in held), default=0) + 1
        if len(held) > 1 and number % STEP:
            top[day] = (number, files)
            parts += [f"{path.rstrip('/')}/date={day}/{name}" for name in files]
    if not parts:
        return []
    full = StructType([*schema.fields]).add("date", "string").add("batch_id", "long")
    rows = spark.read.schema(full).option("basePath", path).parquet(*parts)
    numbers = spark.createDataFrame([(day, number) for day, (number, _) in top.items()], "date string, _number long")
    merged = (upsert_latest(None, rows, [*keys, "date"], newest or ["batch_id"]).join(numbers, "date")
              .withColumn("batch_id", F.col("_number")).drop("_number").select(full.names))
    merged.hint("rebalance", "date").write.mode("append").partitionBy("date", "batch_id").parquet(path)
    for day, (number, files) in top.items():
        folder.write("\n".join(files), f"date={day}", f"batch_id={number}", _MERGED)
    return sorted(top)
