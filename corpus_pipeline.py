"""From raw documents to token files: toxicity, near-duplicates, benchmark passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and all but the last
return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.base import held_out, read, stored
from lotwise.llm.decontamination import contamination
from lotwise.llm.mixing import mixed_documents
from lotwise.llm.neardup import near_duplicates
from lotwise.llm.queries import byte_bpe
from lotwise.llm.settings import MIX_SEED, MIX_SHARE, MIX_WEIGHTS, mix_levels
from lotwise.llm.token_output import tokenized
from lotwise.llm.toxicity import fit_toxicity, score_toxicity


_CORE = ["doc_id", "text", "lang", "source"]


def _whole_rows(stage):
    """Carries all further columns of documents through a stage under names that none of its own can take."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"_kept_{k}" for k, c in enumerate(docs.columns) if c not in _CORE}
        out = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in names.items()}).select(*(F.col(f"`{c}`") for c in docs.columns))
    return run_stage


@_whole_rows
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labels outside its hold-out fold, does not call toxic."""
    model = fit_toxicity(docs, read(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 3, 1))
    return score_toxicity(docs, model, docs.columns).where("predicted = 0").select(*docs.columns)


@_whole_rows
def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each group of near-duplicates (five words, 0.8) with the smallest id.

    Rows without id stay; rows that repeat the id of a kept document stay with it.
    """
    groups = near_duplicates(docs, size=5, threshold=80)
    dropped = groups.where("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped.hint("merge"), F.col("doc_id") == F.col("_dropped"), "left_anti").select(*docs.columns)


@_whole_rows
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"), docs.columns)
    return found.where("not contaminated").select(*docs.columns)


@_whole_rows
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, once per epoch."""
    return mixed_documents(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, max_epochs=2, seed=MIX_SEED)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token file of the mixture."""
    return tokenized(docs, byte_bpe())


STAGES = [
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicate_removal),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token ids", token_output),
]

#: A learned model, similarity search and a tokenizer are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
