"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_used: list[str] = []   # scratch folders of this process


def build_session(app: str = "lotwise", master: str | None = None, **conf: object) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    Partition counts stay with the cluster's own settings unless the caller passes them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster every executor has to see the same folder, so it must be named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lotwise-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch root that no earlier run has used."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _used.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the scratch folders that this process has asked for; called when a job has written its results.

    Frames that were read back from them can no longer be used.
    """
    while _used:
        path = spark._jvm.org.apache.hadoop.fs.Path(_used.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and reads it back, so that later jobs start from files.

    Used where several jobs read the same frame: a lost executor then costs a
    re-read instead of a recomputation of the whole lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
