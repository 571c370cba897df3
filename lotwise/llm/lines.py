"""Line dedup over overlapping three-line windows.

Every run of ``size`` consecutive lines is a window, hashed with md5. Of a window that occurs more than once the
first occurrence stays, by document id and place; all lines that a later occurrence covers are removed. Windows are
judged on the input, so overlapping occurrences merge into one covered run.

Everything is DataFrame functions: counts and first places are combined before the shuffle, the join back to all
places has one row per window on its other side, so adaptive execution may split a hot window.

Rules: a NULL text is empty, an empty text is one empty line; documents with fewer lines than a window lose nothing; rows
that share id and text are one document; a NULL id comes first; lines are compared as they are, blank ones too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lines(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), F.split(text, "\n").alias("lines"),
                       *(F.col(f"`{m}`").alias(f"_{m}") for m in more))


def removed_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, print, removed): the numbers of the lines, from 0, that later occurrences cover."""
    window = lambda i: F.unhex(F.md5(F.concat_ws("\n", F.slice("lines", i + 1, size))))
    windows = (_lines(docs).where(F.size("lines") >= size)
               .select("doc_id", "print", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("lines") - size), window)).alias("place", "hash")))
    spot = F.struct("doc_id", "print", "place")
    repeated = windows.groupBy("hash").agg(F.count("*").alias("n"), F.min(spot).alias("first")).where("n > 1").select("hash", "first")
    later = windows.join(repeated, "hash").where(spot > F.col("first"))
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set("place"), lambda p: F.sequence(p, p + size - 1))))
    return later.groupBy("doc_id", "print").agg(covered.alias("removed"))


def without_repeated_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every row of ``docs`` (doc_id, text)."""
    gone = removed_lines(docs, size).select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "removed")
    rows = _lines(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    text = F.when(F.col("removed").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), text.alias("text"))
