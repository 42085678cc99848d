"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame: all but the last with the columns of documents, changed or fewer or repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.llm.language_id import UNKNOWN, fit, identify
from reachspark.llm.line_dedup import dedup_lines
from reachspark.llm.minhash_dedup import keep_first
from reachspark.llm.mixing import mixed
from reachspark.llm.session import discard, materialise, release_shuffles
from reachspark.llm.vector_packing import document_examples, pack

#: No stage is expressible in SQL as a whole (models, MinHash, hash functions of the engine, a tokenizer): tested against brute force instead.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that no language is found for: those whose text is null or has no letter. With nothing to learn from, the same ones go."""
    model = fit(docs)
    if model is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    return identify(docs, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that nearly equal an earlier one go. Documents stay, unless no word of a text that had some is left."""
    out = dedup_lines(docs)
    word = r"[^\x20\x09-\x0D]"
    left = out.where((F.col("n_kept") == F.col("n_lines")) | F.col("clean").rlike(word))
    changed = {"text": F.col("clean"), "n_chars": F.when(F.col("n_kept") == F.col("n_lines"), F.col("row.n_chars")).otherwise(F.length("clean").cast("long"))}
    return left.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least doc_id."""
    return keep_first(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: each document as often as the mix takes it."""
    return mixed(docs, weights=(1, 2, 3))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids."""
    return pack(document_examples(docs), capacity=1024, with_ids=False)


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near duplicates", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, "stage")
            discard(before)  # nothing reads the stage before last
            release_shuffles(spark)
    return docs
