"""Near-duplicates, components, mixing and top-k against brute force."""

import itertools
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import neardup, topk
from lotwise.llm.components import components
from lotwise.llm.mixing import leaf_budgets, mixed_documents, mixture

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grouped(edges, nodes):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 700)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = grouped(edges, {x for e in edges for x in e})
    alone = {x for e in edges for x in e} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets_of(texts, size):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    draw = random.Random(size)
    words = [f"w{k}" for k in range(400)]
    base = [[draw.choice(words) for _ in range(draw.randint(20, 150))] for _ in range(12)]
    texts = [None, "", " \n", "One", "one", "a b", "b a", "A  b"]
    for _ in range(160):  # copies at all distances, so that groups hang together by chains
        w = list(draw.choice(base))
        for _ in range(draw.randint(0, max(1, len(w) // 30))):
            w[draw.randrange(len(w))] = draw.choice(words)
        texts.append(" ".join(w))
    texts += [texts[20]] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as component", "2 as doc", "3 as signature")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, size).collect()}
    sets = sets_of(texts, size)
    edges = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = grouped(edges, range(len(texts)))
    assert got == {k: (len(sets[k]), want[k], want[k] == k) for k in want}


@pytest.mark.parametrize("size,short", [(4, "a b"), (4, "a b c"), (5, "a b"), (5, "a b c"), (5, "a b c d")])
def test_short_texts_alone_in_a_slice(spark, size, short):
    """As the only row, and before and after a text of more than a slice, a text shorter than a shingle is one shingle."""
    alone = spark.createDataFrame([(1, short)], "doc_id long, text string")
    assert [tuple(r) for r in neardup.near_duplicates(alone, size).collect()] == [(1, 1, 1, True)]
    words = [f"w{k}" for k in range(1 << 18)]
    texts = [short, " ".join(words), short.upper()]
    assert len(texts[1]) > 1 << 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = sorted(tuple(r) for r in neardup.near_duplicates(docs, size).collect())
    assert got == [(0, 1, 0, True), (1, len(words) - size + 1, 1, True), (2, 1, 0, False)]


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    one, two, three = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30)), " ".join(f"c{k}" for k in range(30))
    docs = spark.createDataFrame([(1, one), (2, one), (2, two), (5, two), (7, three), (None, three), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert got == sorted([(1, 1, True), (2, 1, False), (2, 1, False), (5, 1, False), (7, 7, True), (0, 0, True), (0, 0, True)])
    assert neardup.near_duplicates(docs.where("false")).count() == 0


def test_links_across_components_are_found(spark, monkeypatch):
    """With pairs made by stars alone a chain around one bucket's centre would fall apart."""
    draw = random.Random(9)
    words = [f"w{k}" for k in range(1000)]
    base = [draw.choice(words) for _ in range(100)]
    texts = []
    for _ in range(60):
        w = list(base)
        for k in draw.sample(range(100), 2):
            w[k] = draw.choice(words)
        texts.append(" ".join(w))
    monkeypatch.setattr(neardup, "_CHUNK", 16)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 5, 84).collect()}
    sets = sets_of(texts, 5)
    edges = [(a, b) for a, b in itertools.combinations(range(60), 2) if 100 * len(sets[a] & sets[b]) >= 84 * len(sets[a] | sets[b])]
    assert got == grouped(edges, range(60))


def water(budget, children):
    full = {}
    while True:
        weight, left = sum(w for n, w, _ in children if n not in full), budget - sum(full.values())
        new = {n: c for n, w, c in children if n not in full and Fraction(left * w, weight) >= c} if weight else {}
        if not new:
            break
        full |= new
    rest = [(n, w) for n, w, _ in children if n not in full]
    weight, left = sum(w for _, w in rest), budget - sum(full.values())
    out = full | {n: left * w // weight for n, w in rest}
    over = left - sum(out[n] for n, _ in rest)
    for n, _ in sorted(rest, key=lambda x: (-(left * x[1] % weight), x[0]))[:over]:
        out[n] += 1
    return out


@pytest.mark.parametrize("seed,share", [(1, (1, 10)), (2, (1, 2)), (3, (3, 1)), (4, (9, 1))])
def test_budgets_equal_brute_force(spark, seed, share):
    draw = random.Random(seed)
    rows = [(d, lang, f"s{k}", draw.choice([1, 5, 50, 1000])) for d in "ab" for lang in ("en", "fr", "de") for k in range(draw.randint(1, 4))]
    weights = {("a",): 3, ("b",): draw.randint(1, 9), ("a", "en"): draw.randint(0, 9), ("b", "fr"): 0, ("a", "de"): 4, ("b", "en", "s1"): 5}
    got = {(r.d, r.l, r.s): r.budget for r in leaf_budgets(spark.createDataFrame(rows, "d string, l string, s string, tokens long"),
                                                            ["d", "l", "s"], weights, share, 4).collect()}
    most = lambda p: sum(4 * r[3] for r in rows if r[:len(p)] == p and all(weights.get(r[:k], 1) for k in (1, 2, 3)))
    budget = {(): min(sum(r[3] for r in rows) * share[0] // share[1], most(()))}
    for k in range(3):
        for p in [p for p in budget if len(p) == k]:
            children = sorted({r[:k + 1] for r in rows if r[:k] == p})
            budget |= water(budget[p], [(c, weights.get(c, 1), most(c)) for c in children if most(c)])
    assert {k: v for k, v in got.items() if v} == {p: v for p, v in budget.items() if len(p) == 3 and v}
    assert sum(got.values()) == budget[()]


def test_mixture_takes_prefixes_of_epochs(spark):
    rows = [(k, "x " * (k % 7), "en" if k % 3 else None, f"s{k % 2}") for k in range(200)] + [(None, "a b", "en", None), (5, None, "en", "s1"), (8, "w w", "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as tokens", "2 as epoch")
    levels = {"language": F.col("lang"), "origin": F.col("source")}
    got = mixture(docs, levels, {("en",): 1, ("",): 9}, (3, 2), 3, 5).collect()
    assert sum(r.n_taken for r in got) == sum(len((t or "").split()) for _, t, _, _ in rows) * 3 // 2
    for _, part in itertools.groupby(sorted(got, key=lambda r: (r.language, r.origin, r.epoch, r.start)), key=lambda r: (r.language, r.origin, r.epoch)):
        place = 0
        for r in part:
            assert r.start == place and 0 < r.n_taken <= r.n_tokens
            place += r.n_taken
    whole = mixed_documents(docs, levels, {("en",): 1, ("",): 9}, (3, 2), 3, 5)
    assert whole.columns == docs.columns and whole.count() >= len(got)
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in got}
    assert mixture(docs.where("false"), levels, {}, (1, 2)).count() == 0 and mixed_documents(docs.where("false"), levels, {}, (1, 2)).count() == 0


def best(vectors, queries, k):
    return sorted((q, rank, v, s) for q, qv in queries.items()
                  for rank, (s, v) in enumerate(sorted(((sum(a * b for a, b in zip(qv, vv, strict=True)), v) for v, vv in vectors.items()
                                                        if v != q and len(vv) == len(qv)), key=lambda x: (-x[0], x[1]))[:k], 1))


@pytest.mark.parametrize("spread,query_bytes", [(3, 1 << 20), (40, 700)])
def test_top_k_equals_brute_force(spark, monkeypatch, spread, query_bytes):
    monkeypatch.setattr(topk, "QUERY_BYTES", query_bytes)
    draw = np.random.default_rng(spread)
    vectors = {k: draw.integers(-spread, spread + 1, 8).tolist() for k in range(900)} | {k: [1] * 8 for k in range(900, 1200)}
    vectors |= {1200: [0] * 8, 1201: [5, 6], 1220: [7, 8], 1202: [2**40] * 8, 1240: [2**40 + 1] * 8}
    rows = [(k, [float(x) for x in v]) for k, v in vectors.items()]
    bad = [(2000, None), (2020, []), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(3).selectExpr("*", "1 as score", "2 as vector")
    part = topk.taking_part(table, "embedding")
    got = sorted(tuple(r) for r in topk.top_k(part, part.where("vec_id % 20 = 0"), 20).collect())
    clip = lambda s: max(min(s, 2**63 - 1), -2**63)
    assert got == [(q, r, v, clip(s)) for q, r, v, s in best(vectors, {k: v for k, v in vectors.items() if k % 20 == 0}, 20)]
    assert topk.top_k(part.where("false"), part.where("false"), 20).columns == ["query_id", "rank", "vec_id", "score"]
