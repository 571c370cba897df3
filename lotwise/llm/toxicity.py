"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A document's probability is the noisy-or of its sentences', 1 - prod(1 - p_s), and the sentence model (logistic
regression over hashed words and word beginnings) is trained through it by gradient descent. The fit uses a bounded
sample of labelled rows: at most about ``FIT_DOCS`` documents chosen by a hash of their id, and of them those that fit into
``FIT_FEATURES`` features; a giant document is passed over, not those after it. Scoring covers every whole text.

Rules: a NULL or empty text has no sentence and scores 0; a document with several labels counts as toxic if one says
so; NULL labels and labels of unknown documents are left out; without any label of both kinds every score is 0; a sample that
has lost all documents of one label is an error; equal
texts score alike. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import annotated, stored
from lotwise.llm.words import Hasher, Texts, alphanumeric, texts_of, total_by, words_of

FIT_DOCS = 6000
FIT_FEATURES = 8_000_000
FIT_SHARE = 20            # a document with more than one part in so many of FIT_FEATURES is not learned from
BITS = 18
PREFIXES = (4, 5, 6)      # beginnings of words, in bytes, beside the whole word
THRESHOLD = 0.7
_MIN_DOCS, _MIN_SHARE = 4, 0.002   # a feature of fewer sample documents is not used
_STEPS, _RATE, _STEEP = 400, 0.5, 0.1
_MOST_WORDS = 64          # a sentence without end marks is cut after so many words


def _instances(texts: Texts, fold: np.ndarray, flags: np.ndarray):
    """(feature numbers: one row per word; first word of each sentence; first sentence of each row; byte borders)."""
    folded = fold[texts.data]
    words = words_of(texts, flags)
    ends = np.cumsum(np.isin(texts.data, np.frombuffer(b".!?\n", np.uint8)))
    n = len(words.starts)
    row = np.repeat(np.arange(texts.rows), np.diff(words.bounds))
    mark = ends[words.starts] if n else np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    begin = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    new |= (np.arange(n) - begin) % _MOST_WORDS == 0
    first = np.flatnonzero(new)
    hashed = Hasher(folded)
    sizes = words.ends - words.starts
    columns = [hashed(words.starts, words.ends)]
    for k in PREFIXES:
        columns.append(hashed(words.starts, words.starts + np.minimum(sizes, k)) ^ np.uint64(k * 0x9E3779B97F4A7C1))
    features = np.stack([(c >> np.uint64(64 - BITS)).astype(np.int32) for c in columns], 1)
    return features, first, np.searchsorted(first, words.bounds), words


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def sentences(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of each sentence."""
        if not len(first):
            return np.zeros(0)
        return self.bias + np.add.reduceat(self.weights[features].sum(1, dtype=np.float64), first)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))


def fit(sample: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Fits on (features, first words of the sentences, label) of some documents.

    Gradient descent over all of them. A step moves the steepest features only, and as far as the steepest one may
    go: those that speak for many documents get ahead of those that merely occur in a few. Weights stay above 0,
    a word is evidence or none. Equal texts count once.
    """
    size = 1 << BITS
    sample = list({(s[0].tobytes(), s[2]): s for s in sample if len(s[1])}.values())
    labels = np.array([s[2] for s in sample], float)
    if not len(sample) or labels.min() == labels.max():
        return Model(np.zeros(size, np.float32), -50.0)
    frequency = np.zeros((2, size))
    for features, _, label in sample:
        frequency[label, np.unique(features)] += 1
    # Only what toxic documents hold clearly more often than clean ones can become evidence.
    rates = frequency / np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]])
    used = (frequency.sum(0) >= max(_MIN_DOCS, _MIN_SHARE * len(sample))) & (rates[1] >= 1.5 * rates[0])
    number = np.cumsum(used) - 1
    # Sparse form: used features of each sentence.
    sentence_of, columns, doc_of = [], [], []
    base = 0
    for d, (features, first, _) in enumerate(sample):
        place = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(features))))
        ok = used[features]
        sentence_of.append(np.repeat(place[:, None], features.shape[1], 1)[ok].astype(np.int32) + base)
        columns.append(number[features[ok]].astype(np.int32))
        doc_of.append(np.full(len(first), d, np.int32))
        base += len(first)
    sentence_of, columns, doc_of = map(np.concatenate, (sentence_of, columns, doc_of))
    n = int(used.sum())
    # Both classes weigh the same up to a factor, so that rare toxic documents are heard.
    rate = labels.mean()
    weight = np.where(labels == 1, min(4.0, (1 - rate) / rate), 1.0)
    weight /= weight.sum()
    w, bias, steady = np.zeros(n), -5.0, np.zeros(n)
    first = second = 0.0
    for step in range(1, _STEPS + 1):
        odds = np.clip(np.bincount(sentence_of, w[columns], minlength=base) + bias, -40, 40)
        miss = np.bincount(doc_of, _softplus(odds), minlength=len(sample))  # -log(1 - p) of the document
        p = -np.expm1(-miss)
        # d loss / d miss: 1 for clean documents, -(1 - p) / p for toxic ones; d miss / d odds: the sentence's p
        slope = weight * np.where(labels == 1, -(1 - p) / np.maximum(p, 1e-9), 1.0)
        each = slope[doc_of] / (1 + np.exp(-odds))
        steady = 0.7 * steady + 0.3 * np.bincount(columns, each[sentence_of], minlength=n)
        top = np.abs(steady).max(initial=0.0)
        if top > 0:
            w = np.maximum(w - _RATE * np.where(np.abs(steady) >= _STEEP * top, steady / top, 0), 0)
        slope_of_bias = each.sum()
        first, second = 0.9 * first + 0.1 * slope_of_bias, 0.99 * second + 0.01 * slope_of_bias ** 2
        bias -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return Model(weights, float(bias))


def _featurizer():
    fold, flags = alphanumeric()

    def compute(column: pa.Array) -> list[pa.Array]:
        features, firsts = [], []
        for texts in texts_of(column):
            got, first, rows, words = _instances(texts, fold, flags)
            for a, b, s, t in zip(words.bounds[:-1], words.bounds[1:], rows[:-1], rows[1:], strict=True):
                features.append(got[a:b].tobytes())
                firsts.append((first[s:t] - a).astype(np.int32).tobytes())
        return [pa.array(features, pa.binary()), pa.array(firsts, pa.binary())]
    return compute


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, docs_limit: int = FIT_DOCS,
                 features_limit: int = FIT_FEATURES) -> Model:
    """The model of a bounded sample of the labelled documents for which ``learn`` (of doc_id) holds."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, docs_limit / max(1, marked.count()))
    # A uniform number of each id; the sample has docs_limit documents on average, and never more than twice that.
    chance = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))).alias("chance")
    chosen = marked.select("doc_id", "toxic", chance).where(F.col("chance") < share).limit(2 * docs_limit)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(chosen), "doc_id"))
    rows = stored(annotated(texts, ["doc_id", "toxic", "chance"], _featurizer(), "features binary, firsts binary"),
                  "toxic-sample").withColumn("size", F.length("features") / 4)
    # Whole documents in the order of their numbers, each that is no giant and still fits.
    taken, total, kinds = set(), 0, {True: 0, False: 0}
    found = sorted((r.chance, r.size, r.toxic != 0) for r in rows.select("chance", "size", "toxic").collect())
    for chance, size, toxic in found:
        if size <= features_limit // FIT_SHARE and total + size <= features_limit:
            taken.add((chance, size))
            total, kinds[toxic] = total + size, kinds[toxic] + 1
    if len({toxic for *_, toxic in found}) == 2 and not all(kinds.values()):
        raise ValueError("the bounded sample has lost all documents of one label; raise features_limit")
    fits = docs.sparkSession.createDataFrame(sorted(taken), "chance double, size double")
    width = 1 + len(PREFIXES)
    sample = [(r.chance, r.features, np.frombuffer(r.firsts, np.int32), int(r.toxic != 0))
              for r in rows.join(F.broadcast(fits), ["chance", "size"]).toLocalIterator()]
    sample.sort(key=lambda s: (s[0], s[1]))
    return fit([(np.frombuffer(f, np.int32).reshape(-1, width), first, label) for _, f, first, label in sample])


def _scorer(model):
    fold, flags = alphanumeric()

    def compute(column: pa.Array) -> list[pa.Array]:
        scores, worst, spans = [], [], []
        for texts in texts_of(column):
            features, first, rows, words = _instances(texts, fold, flags)
            odds = np.clip(Model(*model.value).sentences(features, first), -40, 40)
            scores.append(-np.expm1(-total_by(_softplus(odds), rows)))
            # Offending sentences: byte borders in the text of those that are toxic on their own.
            bad = np.flatnonzero(odds >= np.log(THRESHOLD / (1 - THRESHOLD)))
            row = np.searchsorted(rows, bad, "right") - 1
            last = np.append(first[1:], len(words.starts))[bad] - 1
            at = texts.bounds[row]
            spans.append(pa.ListArray.from_arrays(
                pa.array(np.searchsorted(bad, rows).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array((words.starts[first[bad]] - at).astype(np.int32)),
                                            pa.array((words.ends[last] - at).astype(np.int32)),
                                            pa.array(1 / (1 + np.exp(-odds[bad])))], ["start", "end", "p"])))
        return [pa.array(np.concatenate(scores)), pa.concat_arrays(spans)]
    return compute


def score_toxicity(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with score, toxic_sentences (byte borders and probability) and predicted."""
    # A fixed number of weights, as plain values: workers need not have this package.
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    out = annotated(docs, keep, _scorer(held), "score double, toxic_sentences array<struct<start: int, end: int, p: double>>")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
