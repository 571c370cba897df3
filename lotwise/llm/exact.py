"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

One scan looks at lengths and prefixes only and counts them, combined before the shuffle. Lengths that occur once are settled;
among the others, prefixes that occur once are settled too. What survives is kept as a sieve, a bit table of at most
``SIEVE_BITS`` bits, however many groups there are, so that it may be broadcast. A second scan hashes the whole texts of rows that pass the
sieve; a row that passes by chance is hashed for nothing and found to be alone. Texts are never shuffled.

Texts are equal when identical after lower-casing A-Z, told by length and SHA-256 of their UTF-8 bytes.

Rules: a NULL text counts as empty, and empty texts are equal; of equal texts the row with the largest id stays; rows that share
text and id stay or go together; a NULL id is smaller than all others, and stays where all ids of the group are NULL; an empty
table gives none; columns not asked for are ignored, and the new ones take the place of kept ones with the same name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import annotated, join_counted, stored
from lotwise.llm.words import texts_of

PREFIX_CHARS = 64
SIEVE_BITS = 1 << 23

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _digests(column: pa.Array) -> list[pa.Array]:
    """SHA-256 of each lower-cased text; NULL stays NULL."""
    fold = np.frombuffer(_FOLD, np.uint8)
    out: list[bytes] = []
    for texts in texts_of(column):
        data, bounds = memoryview(fold[texts.data]), texts.bounds.tolist()
        out += [hashlib.sha256(data[a:b]).digest() for a, b in zip(bounds, bounds[1:], strict=False)]
    missing = np.asarray(column.is_null())
    return [pa.array(out, pa.binary(), mask=missing)]


def _prefix_hash(text: Column) -> Column:
    return F.xxhash64(F.octet_length(text), F.translate(F.substring(text, 1, PREFIX_CHARS), _UPPER, _LOWER))


def _place(prefix: Column) -> tuple[Column, Column]:
    """Word of the sieve, and the number of the bit in it."""
    bit = F.pmod(prefix, F.lit(SIEVE_BITS))
    return F.floor(bit / 64).cast("int"), (bit % 64).cast("int")


def survivors(docs: DataFrame) -> DataFrame:
    """(prefix): hashes of length and prefix that several rows share, found by length first."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counts = stored(docs.select(F.octet_length(text).alias("length"), _prefix_hash(text).alias("prefix"))
                    .groupBy("length", "prefix").agg(F.count("*").alias("n")), "prefixes")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("rows")).where("rows > 1").select("length")
    return counts.join(lengths, "length", "left_semi").where("n > 1").select("prefix")


def sieve_of(prefixes: DataFrame) -> DataFrame:
    """(word, bits) with a bit for each prefix, at most SIEVE_BITS / 64 rows."""
    word, bit = _place(F.col("prefix"))
    return (prefixes.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word")
            .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))


def exact_duplicates(docs: DataFrame, keep: list[str] = (), digest_all: bool = False) -> DataFrame:
    """Every row's doc_id, its columns ``keep``, and keep_id, group_size, kept, digest (binary).

    ``digest`` is NULL for rows that were settled without it, unless ``digest_all`` asks for every row's. The rows
    are stored once, with the kept columns.
    """
    sieve = stored(sieve_of(survivors(docs)), "sieve")
    made = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    names = {c: f"_kept_{k}" for k, c in enumerate(c for c in keep if c not in made)}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    word, bit = _place(_prefix_hash(text))
    marked = (docs.select(F.col("doc_id"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
                          text.alias("text"), word.alias("_word"), bit.alias("_bit"))
              .join(F.broadcast(sieve), "_word", "left")
              .withColumn("_open", F.coalesce(F.expr("shiftrightunsigned(_bits, _bit) & 1L = 1L"), F.lit(False))))
    wanted = marked if digest_all else marked.withColumn("text", F.when(F.col("_open"), F.col("text")))
    rows = stored(annotated(wanted, ["doc_id", *names.values(), "_open"], _digests, "digest binary"), "digests")
    groups = stored(rows.where("_open").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                    .where("group_size > 1"), "copies")
    joined = join_counted(rows, groups, "digest", "group_size")
    best = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", *(F.col(n).alias(c) for c, n in names.items()), best.alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         best.eqNullSafe(F.col("doc_id")).alias("kept"), "digest")
