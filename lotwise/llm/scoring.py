"""Log-probabilities of whole documents: a unigram base and the recurrent model of ``gru``, both learned from the corpus.

1. Word counts of all training documents: summed per task, then by Spark; words travel as 64-bit hashes.
2. The ``FREQUENT`` first words have numbers of their own. All others fall into groups of similar frequency: a bin of
   counts (``BINS`` to a doubling) is cut by hash into groups of about equal tokens. Their number is about the root of
   the number of distinct words, and so is the size of the groups.
3. Numbers of a document need the counts of all its words. Documents are dealt into blocks by a hash; each block gets the
   counts and groups of its own distinct words. The text is shuffled once and stored as numbers, two bytes a token.
4. Training covers every training document once, in ``ROUNDS`` parts. In each round all tasks start from the same
   weights and learn from their documents; Spark averages what they have learned, weighted by tokens.

The model's probability of a frequent word is that of its number; of any other word that of its group times
(c + 1) / (the group's tokens + its distinct words). Words not seen in training fall into the groups of the rarest bin,
each of which counts one further word for them. After training the biases of the groups are raised from their
tokens to their tokens + distinct words, as the words' own counts are.

Rules: words are runs without white space, A-Z lower-cased, and each document ends with one end token; NULL is the empty
text and has the end only; rows with equal ids are documents of their own; without training documents N and V are 0 and the
model keeps its first weights; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import stored
from lotwise.llm.gru import FREQUENT, REST, Trainer, flat, initial, log_probabilities, shaped, smoothed
from lotwise.llm.words import Hasher, Texts, spaced, texts_of, total_by, words_of

ROUNDS, RATE = 2, 0.01
BLOCK_TOKENS = 2_000_000       # of a block on average
LEARN_TOKENS = 3_000_000       # that are dealt to lanes together
_SLICE = 2 << 20
_HELD = 2_000_000              # distinct words that a task holds before it passes them on
_PARTS = 64                    # pieces of the weights that are averaged on their own
BINS = 8                       # of counts to a doubling
_MOST = 1 << 15                # groups; numbers take two bytes
END = -1                       # in place of a hash


class Vocabulary:
    """Numbers of the frequent words, by their hashes; a table without collisions finds them."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.append(hashes, 0)          # the last one stands for no word
        bits = 12
        while len(np.unique(hashes.view(np.uint64) >> np.uint64(64 - bits))) < len(hashes):
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.table = np.full(1 << bits, len(hashes), np.int16)
        self.table[hashes.view(np.uint64) >> self.shift] = np.arange(len(hashes))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        place = self.table[hashes.view(np.uint64) >> self.shift]
        return np.where((self.hashes[place] == hashes) & (place < len(self.hashes) - 1), place, REST).astype(np.int32)


def _tokens(texts: Texts, tables) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens with an end after each text, borders of the texts)."""
    fold, flags = tables
    words = words_of(texts, flags)
    hashes = Hasher(fold[texts.data])(words.starts, words.ends).view(np.int64)
    hashes = np.where(hashes == END, 0, hashes)
    return np.insert(hashes, words.bounds[1:], END), words.bounds + np.arange(len(words.bounds))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    distinct, place = np.unique(key, return_inverse=True)
    return distinct, np.bincount(place, count).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens of ``docs``."""
    tables = spaced()

    def run(batches):
        keys, counts, size = [], [], 0
        for batch in batches:
            for texts in texts_of(batch.column("text"), _SLICE):
                got = np.unique(_tokens(texts, tables)[0], return_counts=True)
                keys.append(got[0])
                counts.append(got[1])
                size += len(got[0])
                if size > 2 * _HELD:
                    key, count = _summed(keys, counts)
                    if len(key) > _HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["word", "n"])
                        keys, counts, size = [], [], 0
                    else:
                        keys, counts, size = [key], [count], len(key)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, counts)], ["word", "n"])
    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Groups:
    """Groups of the words behind the frequent ones: their tokens, shares, and the places of unseen words."""

    def __init__(self, counts: DataFrame, top: list, total: int, distinct: int):
        last = top[-1] if len(top) == FREQUENT else None
        self.rare = (F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)) if last else F.lit(False)
        self._bin = F.floor(F.log2("n") * BINS).cast("int")
        bins = counts.where(self.rare).groupBy(self._bin.alias("bin")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
        wanted = min(math.ceil(math.sqrt(distinct)), _MOST)
        mass = sum(r.n for r in bins) / max(wanted, 1)
        size = max((r.bin for r in bins), default=0) + 1
        self._parts, self._first, at = [1] * size, [0] * size, 0
        for r in sorted(bins, key=lambda r: -r.bin):
            self._parts[r.bin], self._first[r.bin] = min(max(1, round(r.n / mass)), r.words), at
            at += self._parts[r.bin]
        lowest = min((r.bin for r in bins), default=0)
        self.unseen = self._first[lowest], self._parts[lowest]
        self.tokens, self.shares = np.zeros(max(at, 1)), np.zeros(max(at, 1))
        for r in self.placed(counts).where(self.rare).groupBy("unit").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
            self.tokens[r.unit], self.shares[r.unit] = r.n, r.n + r.words
        self.shares[self.unseen[0]:sum(self.unseen)] += 1

    def placed(self, counts: DataFrame) -> DataFrame:
        """``counts`` with the group of each word, -1 for frequent ones."""
        unit = F.get(F.lit(self._first), self._bin) + F.pmod("word", F.get(F.lit(self._parts), self._bin))
        return counts.withColumn("unit", F.when(self.rare, unit).otherwise(-1).cast("int"))


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int32) for x in column.to_pylist()]


def _gathered(batches):
    """Record batches with the numbers of their documents, many at a time, so that long documents run side by side."""
    held, docs, size = [], [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            docs += _numbers(batch.column("numbers"))
            size += sum(map(len, docs[-batch.num_rows:]))
        if size >= LEARN_TOKENS:
            yield held, docs
            held, docs, size = [], [], 0
    if held:
        yield held, docs


def train(docs: DataFrame, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Weights after each of ``docs`` (doc_id, numbers) was learned from once."""
    sc = docs.sparkSession.sparkContext
    for turn in range(ROUNDS):
        start = sc.broadcast(weights)

        def run(batches, start=start):
            trainer = Trainer(start.value, RATE)
            for _, held in _gathered(batches):
                trainer.learn(held)
            if trainer.tokens:
                parts = np.array_split(flat(trainer.w).astype(np.float64), _PARTS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(_PARTS), pa.int32()), pa.array(list(parts), pa.list_(pa.float64())),
                     pa.array([float(trainer.tokens)] * _PARTS)], ["part", "weights", "tokens"])

        mine = docs.where(F.pmod(F.xxhash64("doc_id", "numbers"), F.lit(ROUNDS)) == turn).select("numbers")
        learned = mine.mapInArrow(run, "part int, weights array<double>, tokens double")
        mean = (learned.select("part", array_to_vector("weights").alias("weights"), "tokens").groupBy("part")
                .agg(Summarizer.mean(F.col("weights"), F.col("tokens")).alias("mean"))
                .select("part", vector_to_array("mean").alias("mean")).orderBy("part").collect())
        if mean:
            weights = shaped(np.concatenate([r["mean"] for r in mean]), weights)
    return weights


def _distinct_pairs(block: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = np.unique(block)
    each = [np.unique(word[block == b]) for b in blocks] if len(blocks) > 1 else [np.unique(word)]
    return np.repeat(blocks, [len(x) for x in each]), np.concatenate(each)


def _distinct_words(batches):
    """(block, word) of the words of each block; a pair may come more than once."""
    tables = spaced()
    blocks, words, size = [], [], 0
    for batch in batches:
        block = batch.column("block").to_numpy()
        for texts in texts_of(batch.column("text"), _SLICE):
            hashes, bounds = _tokens(texts, tables)
            pairs = _distinct_pairs(np.repeat(block[texts.first:texts.first + texts.rows], np.diff(bounds)), hashes)
            blocks.append(pairs[0])
            words.append(pairs[1])
            size += len(pairs[0])
            if size > _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _distinct_pairs(np.concatenate(blocks), np.concatenate(words))], ["block", "word"])
                blocks, words, size = [], [], 0
    if blocks:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _distinct_pairs(np.concatenate(blocks), np.concatenate(words))], ["block", "word"])


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text);
    what ``held_out`` is true of is not learned from. Scores are decimal logarithms."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learned = docs.where(~held_out)
    counts = stored(word_counts(learned), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).collect()
    vocabulary = Vocabulary(np.array([r.word for r in top], np.int64))
    groups = Groups(counts, top, total, distinct)
    # A fixed number of words, and two numbers a group.
    model = docs.sparkSession.sparkContext.broadcast((vocabulary, groups.shares, groups.unseen))
    tables = spaced()

    blocks = max(1, -(-total * 7 // (6 * BLOCK_TOKENS)))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(parts, "block")
    # The same columns as below, so that the shuffle of the texts is reused.
    known = (dealt.select("doc_id", "text", "block").mapInArrow(_distinct_words, "block long, word long")
             .join(groups.placed(counts).hint("merge"), "word").select("block", "word", "n", "unit"))
    kinds = "doc_id long, n_tokens long, n_known long, base_score double, other double, numbers binary"

    def numbered(group: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        numbers_of, shares, (first, spread) = model.value
        order = np.argsort(words["word"].to_numpy())
        key, count, unit = (words[c].to_numpy()[order] for c in ("word", "n", "unit"))
        columns, held = [], []
        for texts in texts_of(pa.array(group["text"], pa.string()), _SLICE):
            tokens, bounds = _tokens(texts, tables)
            c, rare = np.zeros(len(tokens)), first + tokens % spread
            if len(key):
                place = np.minimum(np.searchsorted(key, tokens), len(key) - 1)
                seen = key[place] == tokens
                c, rare = np.where(seen, count[place], 0.0), np.where(seen, unit[place], rare)
            numbers = numbers_of.number(tokens)
            base = np.log10((c + 1) / (total + 1 * (distinct + 1)))
            other = np.where(numbers == REST, np.log10((c + 1) / shares[rare]), 0.0)
            numbers = np.where(numbers == REST, REST + rare, numbers).astype(np.uint16)
            held += [x.tobytes() for x in np.split(numbers, bounds[1:-1])]
            columns.append((np.diff(bounds), total_by(c > 0, bounds), total_by(base, bounds), total_by(other, bounds)))
        n, known, base, other = (np.concatenate(x) for x in zip(*columns, strict=True)) if columns else [np.zeros(0)] * 4
        ids = group["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
        return pd.DataFrame({"doc_id": ids, "n_tokens": n, "n_known": known, "base_score": base, "other": other, "numbers": held})

    coded = stored(dealt.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(numbered, kinds), "numbers")
    weights = train(coded.where(~held_out), initial(np.array([r.n for r in top], float), total, groups.tokens))
    # Counts of training words are one too high for other documents; groups get the share of their smoothed words.
    trained = docs.sparkSession.sparkContext.broadcast(smoothed(weights, groups.tokens, groups.shares))

    def score(batches):
        for held, numbers in _gathered(batches):
            logs, at = log_probabilities(trained.value, numbers) / np.log(10), 0
            for batch in held:
                whole = pa.array(logs[at:at + batch.num_rows] + batch.column("other").to_numpy())
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], whole], [*kept, "score"])

    kept = ["doc_id", "n_tokens", "n_known", "base_score"]
    scored = coded.select(*kept, "other", "numbers").mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score")
