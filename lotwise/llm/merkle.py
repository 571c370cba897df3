"""Merkle manifest of a dataset: leaves and the outer nodes of their proofs are cogrouped by superblock.

Each row is a leaf; the leaves of a source, in ascending order of id, form a tree in which every 16 consecutive nodes (the last
run may have fewer, even one) have their digest above them, until one node remains; the sources' roots form a tree in the same way.

A superblock is 16 ** 3 consecutive nodes. On the way up each superblock is reduced by itself to one node, so a source of any size
is spread over its superblocks, and three levels take one grouping. On the way down the nodes of a superblock meet the path
of its node to the root, which all of them share: one cogrouped function repeats the local levels, joins the own siblings
with the shared path, and folds the claimed leaves.

A digest is SHA-256, written as lowercase hex text where it enters another digest, and kept as 32 bytes in between.

Rules: a NULL field is "-", so it differs from an empty one; a NULL source is a source of its own, before all others; a NULL id comes first;
rows that repeat an id are ordered by their leaf; equal rows are leaves of their own; an empty table has no leaf and no root;
columns that are not among the fields are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import placed, stored

FAN = 16
LEVELS = 3
BLOCK = FAN ** LEVELS

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_PATH = "subroot binary, places array<int>, siblings array<binary>"
_NODE = "tree string, position long, "


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as byte count, colon and value, or as a dash."""
    values = [f.cast("string") for f in fields]
    coded = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*coded), 256))


def leaves_of(docs: DataFrame, claimed_text: Column, fields: list[str] = FIELDS) -> DataFrame:
    """(tree, doc_id, leaf, claimed): the leaf as recorded, and the one of the row with ``claimed_text`` as its text."""
    columns = {c: F.col(f"`{c}`") for c in fields}
    leaf = leaf_digest(list(columns.values()))
    other = leaf_digest(list({**columns, "text": claimed_text}.values()))
    same = F.col("text").eqNullSafe(claimed_text)
    return docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"), "doc_id",
                       leaf.alias("leaf"), F.when(same, F.lit(None)).otherwise(other).alias("claimed"))


def _above(nodes: list[bytes]) -> list[bytes]:
    return [hashlib.sha256("".join([n.hex() for n in nodes[k:k + FAN]]).encode()).digest() for k in range(0, len(nodes), FAN)]


def _levels(nodes: list[bytes], block: int) -> list[list[bytes]]:
    """The levels of a superblock up to its node; a tree of one superblock stops as soon as one node remains."""
    levels, whole = [nodes], block == 0 and len(nodes) < BLOCK
    while len(levels[-1]) > 1 or not (whole or len(levels) > LEVELS):
        levels.append(_above(levels[-1]))
    return levels


def _reduce(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("position")
    block = int(rows["position"].iloc[0]) // BLOCK
    top = _levels(rows["digest"].tolist(), block)[-1]
    return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "position": [block], "digest": top})


def stages(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, position, digest) and the nodes of their superblocks, stage by stage until each tree has one."""
    out = [nodes]
    # A tree with one node left goes along unchanged; three rounds reach 69 thousand million leaves.
    while not out[-1].where("position > 0").isEmpty():
        block = F.floor(F.col("position") / BLOCK).cast("long").alias("block")
        up = out[-1].select("tree", "position", "digest", block).groupBy("tree", "block").applyInPandas(
            _reduce, _NODE + "digest binary")
        out.append(stored(up, "nodes"))
    return out


def _local(nodes: list[bytes], block: int) -> list[tuple[list[int], list[bytes]]]:
    """Per node of a superblock the place in its run and its siblings, level by level."""
    around = []
    for level in _levels(nodes, block)[:-1]:
        runs = [level[k:k + FAN] for k in range(0, len(level), FAN)]
        around.append([b"".join(run[:k] + run[k + 1:]) for run in runs for k in range(len(run))])
    sizes = [FAN ** k for k in range(len(around))]
    return [([i // n % FAN for n in sizes], [level[i // n] for level, n in zip(around, sizes, strict=True)]) for i in range(len(nodes))]


def fold(leaf: bytes, places: list[int], siblings: list[bytes]) -> bytes:
    """The root that a leaf and its proof give."""
    for place, around in zip(places, siblings, strict=True):
        cut = 32 * place
        leaf = hashlib.sha256((around[:cut] + leaf + around[cut:]).hex().encode()).digest()
    return leaf


def _path_of(outer: pd.DataFrame) -> tuple[bytes | None, list[int], list[bytes]]:
    """Subroot and path of a superblock's node; the node that is the root has no path."""
    if outer.empty:
        return None, [], []
    row = outer.iloc[0]
    return row["subroot"], [int(p) for p in row["places"]], [bytes(s) for s in row["siblings"]]


def _join_paths(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("position")
    subroot, places, siblings = _path_of(outer)
    local = _local(rows["digest"].tolist(), int(rows["position"].iloc[0]) // BLOCK) if len(rows) else []
    return pd.DataFrame({"tree": rows["tree"], "position": rows["position"], "subroot": [subroot] * len(rows),
                         "places": [p + places for p, _ in local], "siblings": [s + siblings for _, s in local]})


def _prove(rows: pd.DataFrame, outer: pd.DataFrame, in_full: bool) -> pd.DataFrame:
    rows = rows.sort_values("position")
    subroot, places, siblings = _path_of(outer)
    shared = b"".join(siblings).hex().encode()
    digests = rows["digest"].tolist()
    local = _local(digests, int(rows["position"].iloc[0]) // BLOCK) if len(rows) else []
    proofs = [hashlib.sha256(b"".join(s).hex().encode() + shared).digest() for _, s in local]
    folded = [fold(own if claimed is None else claimed, p + places, s + siblings)
              for own, claimed, (p, s) in zip(digests, rows["claimed"].tolist(), local, strict=True)]
    out = {"doc_id": rows["doc_id"], "leaf": digests, "proof": proofs, "folded": folded, "subroot": [subroot] * len(rows)}
    if in_full:
        out |= {"places": [p + places for p, _ in local], "siblings": [s + siblings for _, s in local]}
    return pd.DataFrame(out)


def _meet(nodes: DataFrame, outer: DataFrame, function, kinds: str) -> DataFrame:
    """Nodes of each superblock with the path of its node: a block of one stage is a position of the next."""
    block = F.floor(F.col("position") / BLOCK).cast("long").alias("block")
    path = outer.select(F.col("tree").alias("_tree"), F.col("position").alias("_block"), "subroot", "places", "siblings")
    return (nodes.select("*", block).groupBy("tree", "block").cogroup(path.groupBy("_tree", "_block"))
            .applyInPandas(function, kinds))


def _paths(levels: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths of the first stage's nodes to the root, from the paths ``outer`` of the nodes above the last stage."""
    for nodes in reversed(levels):
        outer = stored(_meet(nodes.select("tree", "position", "digest"), outer, _join_paths, _NODE + _PATH), "paths")
    return outer


def merkle_proofs(docs: DataFrame, claimed_text: Column, in_full: bool = False) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof (digest of its siblings), folded, verified; digests as bytes.

    ``claimed_text`` is the text that the holder of a row claims; the proof is that of the recorded leaf. ``in_full`` adds the
    proofs themselves: per level the place in the run, and the siblings from left to right.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    found = stored(leaves_of(docs, claimed_text), "leaves")
    leaves = placed(found, "tree", ["doc_id", "leaf"], "position", "placed").withColumnRenamed("leaf", "digest")
    inner = stages(leaves)
    subroots = stored(inner[-1].select("tree", F.col("digest").alias("subroot")), "subroots")
    ranked = placed(subroots.withColumn("_all", F.lit("")), "_all", ["tree"], "_rank", "sources")
    top = stages(ranked.select(F.col("_all").alias("tree"), F.col("_rank").alias("position"), F.col("subroot").alias("digest")))
    above = _paths(top[:-1], spark.createDataFrame([], _NODE + _PATH))
    # A source's tree goes on with the path of its place among the sources; a single source has none.
    entry = ranked.join(above.select(F.col("position").alias("_rank"), "places", "siblings"), "_rank", "left").select(
        "tree", F.lit(0).cast("long").alias("position"), "subroot", F.coalesce("places", F.array().cast("array<int>")).alias("places"),
        F.coalesce("siblings", F.array().cast("array<binary>")).alias("siblings"))
    outer = _paths(inner[1:-1], stored(entry, "entry"))
    kinds = "doc_id string, leaf binary, proof binary, folded binary, subroot binary" + ", places array<int>, siblings array<binary>" * in_full
    # Ids travel as text: pandas has no whole numbers beside NULL.
    proofs = _meet(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), outer, lambda rows, path: _prove(rows, path, in_full), kinds)
    root = top[-1].first()
    root = F.lit(bytearray(root["digest"]) if root else None).cast("binary")
    return proofs.select(F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof", "folded",
                         (F.col("folded") == root).alias("verified"), *(["places", "siblings"] if in_full else []))
