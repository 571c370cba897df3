"""Near-duplicates by MinHash: universal hash minima, banding, signature verification, exact confirmation, components.

1. One scan makes of each text its set of word shingles (64-bit hashes), a fingerprint of the set, and a signature:
   the minima of ``BANDS * ROWS`` multiply-add hashes, 16 bits each.
2. Documents with equal sets form a class at once, named by its smallest id; only classes go on. A group of copies of
   any size is one row from here.
3. A band of a signature is a bucket. Each class is paired with the smallest class of each of its buckets: the number
   of pairs is at most that of bands, whatever the size of a bucket.
4. Pairs whose sizes and signatures allow the similarity are confirmed on the full sets.
5. Components of the confirmed links. In buckets that now hold several components, the members of different components
   are compared too (blocks of members against blocks of members, by signature), so that no link between components
   is missed; what passes is confirmed on the full sets, and the components are joined.

With five rows to a band and 32 bands a pair at similarity 0.8 shares no bucket with a probability of 3 in a million.

Rules: words are runs without white space, A-Z lower-cased; a text with fewer words than a shingle is one shingle; NULL,
empty or blank texts have no shingles and are linked with nothing; a document without id keeps no component; rows that
share an id are one document, all their sets count; ties cannot arise, ids name components. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import annotated, join_counted, stored
from lotwise.llm.components import components
from lotwise.llm.words import Hasher, scramble, spaced, texts_of, words_of

ROWS, BANDS = 5, 32
MARGIN = 0.19     # a signature may fall short of the similarity by six standard deviations
_CHUNK = 1024     # members of a bucket that are compared with so many others at a time
_TASK_PAIRS = 1 << 16
_MOST_TASKS = 2000
_U = np.uint64


def shingle_hashes(column: pa.Array, size: int):
    """For each text: its distinct shingles as sorted 64-bit hashes."""
    fold, flags = spaced()
    for texts in texts_of(column):
        folded = fold[texts.data]
        words = words_of(texts, flags)
        hashes = Hasher(folded)(words.starts, words.ends)
        # Shingle at each word: a polynomial over the next words' hashes; a slice may hold fewer words than a shingle.
        n = len(hashes)
        rolled = np.zeros(n, _U)
        for j in range(min(size, n)):
            rolled[:n - j] += scramble(hashes[j:] + _U(j + 1)) * _U((2 * j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        rolled = scramble(rolled)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(rolled[a:b - size + 1])
            elif b > a:
                short = hashes[a:b] * (np.arange(1, b - a + 1).astype(_U) * _U(2) + _U(1))
                yield scramble(np.array([short.sum(dtype=_U) ^ _U(b - a)], _U))
            else:
                yield np.zeros(0, _U)


def _hash_family(count: int, seed: int = 20240501) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return draw.integers(0, 1 << 63, count, np.uint64) * _U(2) + _U(1), draw.integers(0, 1 << 63, count, np.uint64)


def _sketcher(size: int, bands: int, rows: int):
    factors, offsets = _hash_family(bands * rows)

    def signatures(sets: list[np.ndarray]) -> np.ndarray:
        """16 bits of the minimum of each hash over each set; the sets lie side by side."""
        starts = np.cumsum([0, *map(len, sets[:-1])])
        together = np.concatenate(sets)
        out = np.empty((len(sets), len(factors)), np.uint16)
        work = np.empty_like(together)
        for k, (a, b) in enumerate(zip(factors, offsets, strict=True)):
            np.multiply(together, a, out=work)
            np.add(work, b, out=work)
            out[:, k] = (scramble(np.minimum.reduceat(work, starts)) >> _U(48)).astype(np.uint16)
        return out

    def compute(column: pa.Array) -> list[pa.Array]:
        counts, prints, signs = [], [], []
        group: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal held
            if group:
                signs.extend(row.tobytes() for row in signatures(group))
                group.clear()
                held = 0

        for hashes in shingle_hashes(column, size):
            counts.append(len(hashes))
            if len(hashes):
                prints.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                group.append(hashes)
                held += len(hashes)
                if held > 1 << 15:
                    flush()
            else:
                flush()
                prints.append(None)
                signs.append(None)
        flush()
        return [pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())]
    return compute


def _band_keys(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, doc): one row per band of each class."""
    keys = F.array(*(F.xxhash64(F.substring("signature", 2 * rows * b + 1, 2 * rows), F.lit(b)) for b in range(bands)))
    return classes.select(F.posexplode(keys).alias("band", "bucket"), "doc")


def _agreement(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and signatures allow ``threshold`` percent."""
    side = lambda x: classes.select(F.col("doc").alias(x), F.col("signature").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
    joined = (pairs.join(side("a"), "a").join(side("b"), "b")
              .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold))
    least = threshold / 100 - MARGIN

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (_matrix(batch.column(c)) for c in ("sa", "sb"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= least))
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _confirm(pairs: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """Pairs whose full sets overlap by ``threshold`` percent of their union; texts are fetched for these pairs only.

    The list of documents grows with the corpus, so it is never broadcast."""
    pairs = stored(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    texts = stored(docs.join(nodes.hint("merge"), "doc").select("doc", "text").distinct(), "pair-texts")
    side = lambda x: texts.select(F.col("doc").alias(x), F.col("text").alias(f"t{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for x, y in zip(shingle_hashes(part.column("ta"), size), shingle_hashes(part.column("tb"), size), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return stored(joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "confirmed")


def _candidates(x, y, signs: np.ndarray, threshold: int, rows: int):
    """For each row of ``x``: the places in ``y`` that may be similar and lie in another component.

    A pair that shares an earlier band has been seen there; a pair of two rest members is seen from the smaller one.
    """
    docs, comps, sizes, rest = (y[c].to_numpy() for c in ("doc", "component", "n_shingles", "rest"))
    for r in x.itertuples(index=False):
        ok = ((comps != r.component) & (np.minimum(sizes, r.n_shingles) * 100 >= np.maximum(sizes, r.n_shingles) * threshold)
              & (~rest | (docs > r.doc)))
        at = np.flatnonzero(ok)
        same = signs[at] == np.frombuffer(r.signature, np.uint16)
        close = same.mean(1) >= threshold / 100 - MARGIN
        at, same = at[close], same[close]
        earlier = same[:, :r.band * rows].reshape(len(at), r.band, rows).all(2).any(1)
        yield r, at[~earlier]


def _side(group, left: bool):
    some = group[group["left"] == left].reset_index(drop=True)
    signs = np.frombuffer(b"".join(some["signature"]), np.uint16).reshape(len(some), -1) if len(some) else None
    return some, signs


def _across(shared: DataFrame, classes: DataFrame, texts: DataFrame, found: DataFrame, size: int, threshold: int,
            rows: int) -> DataFrame:
    """Links (a, b) between different components within a bucket (``found``: node, component).

    The largest component of a bucket is not compared with itself. Members are dealt into chunks by hash; each chunk of
    the rest meets each chunk of the bucket in a group of at most two chunks. A first pass by signature leaves the
    members that have a candidate at all; only their texts are fetched, and a second pass confirms on full sets.
    No pass gives out more rows than it has read.
    """
    # Two members were compared when the pairs were made; only larger buckets can hide a link.
    placed = (shared.where("members > 2").join(found, F.col("doc") == F.col("node"), "left")
              .select("band", "bucket", "doc", "members", F.coalesce("component", "doc").alias("component")))
    placed = stored(placed, "large-buckets")
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    mixed = stored(placed.join(stored(several, "several"), "bucket"), "mixed-buckets")
    main = (mixed.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket")
            .agg(F.max(F.struct("n", "component")).alias("m")).select("bucket", F.col("m.component").alias("main")))
    dealt = mixed.join(stored(main, "main-components"), "bucket").withColumn("rest", F.col("component") != F.col("main"))
    # Work goes by pairs, which the bytes of a group do not tell.
    pairs = dealt.agg(F.sum(F.when(F.col("rest"), F.col("members")))).first()[0] or 0
    parts = min(pairs // _TASK_PAIRS + 1, _MOST_TASKS)
    dealt = (dealt.withColumn("chunks", F.ceil(F.col("members") / _CHUNK).cast("int"))
             .withColumn("chunk", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))
             .join(classes.select("doc", "n_shingles", "signature"), "doc"))
    dealt = stored(dealt, "dealt-members")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    kept = ["band", "doc", "component", "rest", "n_shingles", "signature"]
    left = dealt.where("rest").select("bucket", F.col("chunk").alias("of_rest"), every.alias("of_all"), F.lit(True).alias("left"), *kept)
    right = dealt.select("bucket", every.alias("of_rest"), F.col("chunk").alias("of_all"), F.lit(False).alias("left"), *kept)
    groups = left.unionByName(right)

    def involved(group):
        (x, _), (y, signs) = _side(group, True), _side(group, False)
        mine, theirs = np.zeros(len(x), bool), np.zeros(len(y), bool)
        if len(x) and len(y):
            for k, (_, at) in enumerate(_candidates(x, y, signs, threshold, rows)):
                mine[k] = len(at) > 0
                theirs[at] = True
        import pandas as pd
        return pd.concat([x[mine], y[theirs]])

    def confirmed(group):
        (x, _), (y, signs) = _side(group, True), _side(group, False)
        links, root = [], {}

        def top(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        if len(x) and len(y):
            theirs = list(shingle_hashes(pa.array(y["text"], pa.string()), size))
            sets = shingle_hashes(pa.array(x["text"], pa.string()), size)
            for (r, at), own in zip(_candidates(x, y, signs, threshold, rows), sets, strict=True):
                for k in at:
                    one, other = top(r.component), top(y["component"][k])
                    if one != other:  # else another link of this group joins them already
                        both = len(np.intersect1d(own, theirs[k], assume_unique=True))
                        if 100 * both >= threshold * (len(own) + len(theirs[k]) - both):
                            links.append((max(r.doc, y["doc"][k]), min(r.doc, y["doc"][k])))
                            root[max(one, other)] = min(one, other)
        import pandas as pd
        return pd.DataFrame(np.array(links, np.int64).reshape(-1, 2), columns=["a", "b"])

    by = ["bucket", "of_rest", "of_all"]
    close = stored(groups.repartition(parts, *by).groupBy(*by).applyInPandas(involved, groups.schema), "close-members")
    nodes = close.select("doc").distinct()
    whole = stored(texts.join(nodes.hint("merge"), "doc").select("doc", "text").distinct(), "member-texts")
    links = close.join(whole, "doc").repartition(parts, *by).groupBy(*by).applyInPandas(confirmed, "a long, b long")
    return stored(links.distinct(), "cross-links")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    sketches = stored(annotated(texts, ["doc"], _sketcher(size, bands, rows),
                                "n_shingles long, fingerprint binary, signature binary"), "sketches")
    named = sketches.where("doc is not null and fingerprint is not null")
    class_of = (named.groupBy("fingerprint").agg(F.min("doc").alias("class"), F.count("*").alias("copies")).where("copies > 1"))
    members = join_counted(named.select("doc", "fingerprint"), stored(class_of, "copies"), "fingerprint", "copies")
    members = stored(members.select("doc", F.coalesce("class", "doc").alias("class"), "fingerprint"), "classes")
    firsts = members.where("doc = class").distinct()
    classes = stored(named.join(firsts.select("doc", "fingerprint"), ["doc", "fingerprint"])
                     .dropDuplicates(["doc", "fingerprint"]).select("doc", "n_shingles", "signature"), "class-sketches")
    # Ids with several sets tie their classes together.
    tied = (members.groupBy("doc").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y")
            .join(members, "doc").select(F.col("class").alias("a"), F.col("x").alias("b")).where("a <> b"))
    buckets = _band_keys(classes, bands, rows)
    centres = buckets.groupBy("bucket").agg(F.min("doc").alias("b"), F.count("*").alias("members")).where("members > 1")
    shared = stored(join_counted(buckets, stored(centres, "centres"), "bucket", "members").where("members is not null"), "shared-buckets")
    stars = shared.where("doc <> b").select(F.col("doc").alias("a"), "b").distinct()
    links = _confirm(_agreement(stored(stars, "stars"), classes, threshold), texts, size, threshold).unionByName(tied)
    links = stored(links, "star-links")
    found = stored(components(links), "components")
    more = _across(shared, classes, texts, found, size, threshold, rows)
    if not more.isEmpty():
        joined = found.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b").unionByName(more)
        found = stored(components(joined), "components")
    named_rows = (members.join(found, F.col("class") == F.col("node"), "left")
                  .groupBy("doc").agg(F.min(F.coalesce("component", "class")).alias("component")))
    out = sketches.select("doc", "n_shingles").join(named_rows, "doc", "left")
    component = F.coalesce("component", "doc")
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))
