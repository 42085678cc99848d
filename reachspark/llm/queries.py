"""Queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.llm import oracles
from reachspark.llm.bfd_packing import pack_ids
from reachspark.llm.embedding_forest import link_embeddings
from reachspark.llm.exact_topk import exact_top_k
from reachspark.llm.kneser_ney import score_documents
from reachspark.llm.language_id import languages
from reachspark.llm.license_scan import scan_licenses
from reachspark.llm.line_dedup import dedup_lines
from reachspark.llm.merkle_manifest import lower_cased, verify
from reachspark.llm.minhash_dedup import near_duplicates
from reachspark.llm.mixing import mix
from reachspark.llm.superkmers import dedup_windows
from reachspark.llm.turn_repair import damaged, repair
from reachspark.llm.vector_packing import conversation_examples, document_examples, pack


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.98)


def op2_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_ids(_documents(spark, sf_dir), capacity=2048).withColumn("n_segments", F.size("doc_ids"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir), weights=(1, 2, 3), share=1.0, most=3)


def op4_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir), words=2, percent=80)


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(document_examples(_documents(spark, sf_dir)), capacity=1024, with_ids=False)


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir), order=3)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_documents(spark, sf_dir))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=5, every=50)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir)).drop("spans")


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir)).select("row.doc_id", "n_lines", "n_kept", F.col("clean").alias("text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return verify(docs, lower_cased(docs)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_windows(_documents(spark, sf_dir), window=50).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of the mix: sizes and targets, not which documents are taken."""
    return op3_mix_sources(spark, sf_dir).select("doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"))


def ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the model to five decimals, as far as sums in another order agree."""
    return op6_kneser_ney(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 5).alias("base_score"), F.round("score", 5).alias("score"))


def instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations packed as instruction data: limits on tokens, segments and loss-bearing tokens (those of the assistant's turns) at once."""
    return pack(conversation_examples(spark.read.parquet(f"{sf_dir}/conversations.parquet")), capacity=1024, segments=3, loss=640, with_ids=False)


def license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the phrases and their labels, without those of the templates."""
    return op9_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def queries() -> dict:
    ops = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return ops | {f.__name__: f for f in (mix_targets, ngram_scores, license_places, instruction_packing)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_projection_forest": oracles.EMBEDDINGS, "op4_minhash_bayes": oracles.DOCUMENTS, "op8_exact_topk": oracles.TOP_K, "op10_fuzzy_lines": oracles.LINES,
        "mix_targets": oracles.TARGETS, "ngram_scores": oracles.SCORES, "license_places": oracles.LICENSES,
        "op11_merkle_manifest": oracles.MANIFEST, "op12_turn_repair": oracles.REPAIR, "op13_super_kmers": oracles.WINDOWS,
    }
