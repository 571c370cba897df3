"""Registered queries against their SQL, and the pipeline against a plain version of its stages."""

import itertools
import re

import pytest

import corpus_pipeline
from lotwise.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck
from tests.llm.test_set_operators import grouped, sets_of
from tests.llm.test_text_operators import _hits

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_queries_are_registered():
    import __spark_entry__ as contract
    registered = contract.queries()
    assert all(any(re.match(rf"op{n}_", q) for q in registered) for n in range(1, 14)) and "pipeline" in registered


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("*", "'mine' as score", "3 as n_words", "4 as _kept_0")
    docs = docs.unionByName(spark.createDataFrame([(90001, None, None, None, 0, "mine", 3, 4), (90002, "", "en", "src1", 0, "mine", 3, 4)], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near-duplicates", "decontamination", "mixing", "token ids"]
    clean = stages["toxicity"](spark, docs, FOLDER)
    assert clean.columns == docs.columns and {r.score for r in clean.collect()} == {"mine"}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    fine = [i for i in kept if labels.get(i) == 0]
    assert len(fine) >= 0.97 * sum(1 for r in docs.collect() if labels.get(r.doc_id) == 0)

    rows = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(rows)
    sets = dict(zip(ids, sets_of([rows[i] for i in ids], 5), strict=True))
    edges = [(a, b) for a, b in itertools.combinations(ids, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    single = stages["near-duplicates"](spark, docs, FOLDER)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == [i for i, c in sorted(grouped(edges, ids).items()) if i == c]

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = [i for i, hit in zip(ids, _hits([rows[i] for i in ids], items), strict=True) if not hit[1]]
    assert sorted(r.doc_id for r in stages["decontamination"](spark, docs, FOLDER).collect()) == want

    mixed = stages["mixing"](spark, docs, FOLDER)
    assert mixed.columns == docs.columns and 0 < mixed.count()
    assert stages["token ids"](spark, mixed, FOLDER).count() == mixed.count()
    for stage in stages.values():
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert rows and all(b.start == a.start + a.n_tokens for a, b in itertools.pairwise(rows))
