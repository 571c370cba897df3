"""Exact top-k inner products by Fagin's threshold algorithm.

Every task cuts its candidates into blocks and sorts each block once per dimension. A query reads the lists of its
dimensions side by side, from the top where its component is positive and from the bottom where it is negative, scores
each vector when it first turns up, and stops as soon as the bound (its components times the values at the depth
reached) is below its k-th best score so far; that score goes with it from block to block. A bound equal to the k-th
score does not stop it, for a tie may have a smaller id.

Queries are a stated set: they are taken in blocks of bounded size, one broadcast and one scan of the candidates each.

Rules: vectors that are NULL, empty or hold NULL or non-finite components take no part; nor do rows without id; a query
is compared with vectors of its own length only; repeated rows are candidates of their own, of repeated query ids the
smallest vector asks; ties go to the smaller id; scores outside 64 bits are set to the nearest 64-bit value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BYTES = 8 << 20      # of one block of queries
_BLOCK = 4096              # candidates that are sorted together
_DEPTHS = (8, 64, 512)     # where a query looks at its bound
_EXACT = 2.0 ** 53


class _Queries:
    """Queries of one length and their best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.most = float(np.abs(vectors).max(initial=0))
        self.scores: list[np.ndarray] = [np.zeros(0)] * len(ids)
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores[q]) == self.k:
            good = scores >= self.scores[q][-1]
            scores, ids = scores[good], ids[good]
        if len(scores):
            scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.found[q], ids])
            order = np.lexsort((ids, -scores))[:self.k]
            self.scores[q], self.found[q] = scores[order], ids[order]

    def search(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        n, width = vectors.shape
        exact = self.most * float(np.abs(vectors).max(initial=0)) * width < _EXACT
        kind = np.float64 if exact else object   # whole numbers beyond doubles are multiplied as Python's integers
        rows = vectors if exact else np.array([[int(x) for x in v] for v in vectors], object)
        by_id = np.argsort(ids, kind="stable")
        up = by_id[np.argsort(vectors[by_id], axis=0, kind="stable")].T
        down = by_id[np.argsort(-vectors[by_id], axis=0, kind="stable")].T
        for q in range(len(self.ids)):
            query = self.vectors[q] if exact else np.array([int(x) for x in self.vectors[q]], object)
            plus, minus = np.flatnonzero(self.vectors[q] > 0), np.flatnonzero(self.vectors[q] < 0)
            seen = ids == self.ids[q]
            for depth in (*_DEPTHS, n):
                if depth >= n:
                    new = np.flatnonzero(~seen)
                else:
                    reached = np.concatenate([down[plus, :depth].ravel(), up[minus, :depth].ravel()])
                    turned = np.zeros(n, bool)
                    turned[reached] = True
                    new = np.flatnonzero(turned & ~seen)
                seen[new] = True
                if len(new):
                    self.add(q, (rows[new] @ query).astype(kind), ids[new])
                if depth >= n:
                    break
                if len(self.scores[q]) == self.k:
                    at = np.zeros(width, kind)
                    at[plus], at[minus] = rows[down[plus, depth - 1], plus], rows[up[minus, depth - 1], minus]
                    if at @ query < self.scores[q][-1]:
                        break


def _search_part(queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width = {width: _Queries(ids, vectors, k) for width, (ids, vectors, k) in queries.value.items()}
        for batch in batches:
            ids, column = batch.column("vec_id").to_numpy(), batch.column("vector")
            widths = np.diff(column.offsets.to_numpy())
            values = column.flatten().to_numpy()
            starts = np.cumsum(widths) - widths
            for width, held in by_width.items():
                mine = np.flatnonzero(widths == width)
                for at in range(0, len(mine), _BLOCK):
                    some = mine[at:at + _BLOCK]
                    held.search(values[starts[some][:, None] + np.arange(width)], ids[some])
        for held in by_width.values():
            for q in range(0, len(held.ids), 1024):
                sizes = [len(s) for s in held.scores[q:q + 1024]]
                if sum(sizes):
                    scores = [min(max(int(x), -(1 << 63)), (1 << 63) - 1) for s in held.scores[q:q + 1024] for x in s]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(held.ids[q:q + 1024], sizes)), pa.array(np.concatenate(held.found[q:q + 1024])),
                         pa.array(scores, pa.int64())], ["query_id", "vec_id", "score"])
    return run


def _query_blocks(queries: DataFrame, k: int):
    """Queries in blocks of at most QUERY_BYTES, by ascending id; {length: (ids, vectors, k)}."""
    queries = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    widest = queries.agg(F.max(F.size("vector"))).first()[0]
    if not widest:
        return
    limit, last = max(1, QUERY_BYTES // (8 * widest)), None
    while True:
        some = (queries if last is None else queries.where(F.col("vec_id") > last)).orderBy("vec_id").limit(limit).collect()
        block: dict[int, list] = {}
        for row in some:
            block.setdefault(len(row.vector), []).append(row)
        if block:
            yield {w: (np.array([r.vec_id for r in rows], np.int64), np.array([r.vector for r in rows], np.float64), k)
                   for w, rows in block.items()}
        if len(some) < limit:
            return
        last = some[-1].vec_id


def taking_part(table: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part."""
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
            .where("vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best candidates of each query; both sides (vec_id, vector), where
    vectors hold whole numbers."""
    spark, out = candidates.sparkSession, None
    for block in _query_blocks(queries, k):
        rows = candidates.mapInArrow(_search_part(spark.sparkContext.broadcast(block)), "query_id long, vec_id long, score long")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
