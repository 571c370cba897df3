"""The registered queries of this package: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import oracle
from lotwise.llm.base import held_out, read, scratch_path
from lotwise.llm.chat import chat_digests, read_chats, read_examples, write_chats
from lotwise.llm.decontamination import contamination
from lotwise.llm.exact import exact_duplicates
from lotwise.llm.lines import without_repeated_lines
from lotwise.llm.merkle import merkle_proofs
from lotwise.llm.mixing import mixture
from lotwise.llm.neardup import near_duplicates
from lotwise.llm.repair import repair_report
from lotwise.llm.repeats import without_repeats
from lotwise.llm.scoring import score_documents
from lotwise.llm.settings import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, mix_levels
from lotwise.llm.token_output import tokenized
from lotwise.llm.topk import taking_part, top_k
from lotwise.llm.toxicity import fit_toxicity, score_toxicity


def byte_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(read(spark, sf_dir, "documents"), byte_bpe())


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    folder = scratch_path(spark, "chats")
    write_chats(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra), folder)
    return chat_digests(read_chats(spark, folder), read_examples(spark, folder))


def digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items), 256)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest(F.col("hit_items")).alias("items_sha256"), "contaminated")


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"), 400)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = taking_part(read(spark, sf_dir, "embeddings"), "embedding")
    whole = vectors.select("vec_id", F.transform("vector", lambda x: F.floor(x * 64).cast("double")).alias("vector"))
    return top_k(whole, whole.where("vec_id % 20 = 0"), 20)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = fit_toxicity(docs, read(spark, sf_dir, "labels"), ~out)
    return score_toxicity(docs, model, ["doc_id"]).select("doc_id", out.alias("held_out"), "score", "predicted")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=4, threshold=80)


def _hex(column: str) -> Column:
    return F.lower(F.hex(column))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with the faults that the check plants by crc32 of id and turn."""
    whole = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(whole["conv_id"], F.lit(":"), whole["turn"])) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(whole["text"], "[.!?]", "")).otherwise(whole["text"])
    role = F.when(kind == 4, F.lit("user")).otherwise(whole["role"])
    return (rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("_times"))
            .select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "_times")).alias("_copy")).drop("_copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(rows)).withColumnRenamed("conv_id", "_id")
    every = rows.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce(_hex("repaired"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(read(spark, sf_dir, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", _hex("digest").alias("text_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    proofs = merkle_proofs(read(spark, sf_dir, "documents"), F.when(altered, lowered).otherwise(F.col("text")))
    return proofs.select("doc_id", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"),
                         _hex("proof").alias("proof_sha256"), _hex("folded").alias("folded_root"), "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_mixing": op2_mixing,
    "op3_chat_format": op3_chat_format,
    "op4_decontamination": op4_decontamination,
    "op5_repeated_strings": op5_repeated_strings,
    "op6_line_dedup": op6_line_dedup,
    "op7_top_k": op7_top_k,
    "op8_language_model": op8_language_model,
    "op9_toxicity": op9_toxicity,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Tokenizing, learning and searching for similar sets are not SQL; tests compare those with brute force.
ORACLES: dict[str, str] = {
    "op2_mixing": oracle.mixing(),
    "op4_decontamination": oracle.DECONTAMINATION,
    "op6_line_dedup": oracle.LINE_DEDUP,
    "op7_top_k": oracle.TOP_K,
    "op11_conversation_repair": oracle.REPAIR,
    "op12_exact_dedup": oracle.EXACT_DEDUP,
    "op13_merkle_manifest": oracle.merkle_manifest(),
}
