"""MinHash near-dedup of documents with sequential Bayesian verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.components import least_by_root
from reachspark.llm.neardup import Linker
from reachspark.llm.session import Bloom, discard, join_skewed, materialise, small, thrifty

BANDS, ROWS = 28, 5  # at similarity 0.8 a pair shares no band once in 65,000


def _described(shingles: K.Shingles, width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = K.raw(b.column(2))
            for i, j in K.chunks(off):
                u, bound = shingles.sets(data, off, i, j)
                own = [b.column(c).slice(i, j - i) for c in range(3)]
                sid = K.longs(K.set_ids(u, bound))
                if with_text:
                    yield pa.RecordBatch.from_arrays([sid, own[2]], ["sid", "text"])
                else:
                    yield pa.RecordBatch.from_arrays([*own[:2], sid, pa.array(np.diff(bound)), K.binary(K.signatures(u, bound, width))], ["doc_id", "thash", "sid", "n_shingles", "sig"])

    return run


def _rooted(docs: DataFrame, words: int, percent: int, miss: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of docs (doc_id, thash, sid, n_shingles), and of each set its root and the first of the root's rows, by (id, text's hash), rows without an id last: (sid, component, n), n being the number of the set's rows."""
    spark = docs.sparkSession
    shingles, text = K.Shingles("words", words), F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), text.alias("text"))
    base = materialise(docs.mapInArrow(thrifty(_described(shingles, bands * rows, False)), "doc_id long, thash long, sid long, n_shingles long, sig binary"), "docs")
    full = base.where("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "thash")
    first = materialise(full.groupBy("sid").agg(F.min(place).alias("first"), F.count("*").alias("n")), "first")

    def fetch(sids: DataFrame) -> DataFrame:
        ids = first.join(sids, "sid", "left_semi").select(F.col("first.doc_id").alias("least"))
        # both sides of an equality of nulls: documents without an id can be candidates too
        own = docs.join(small(materialise(ids, "least")), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
        return own.mapInArrow(thrifty(_described(shingles, 0, True)), "sid long, text string").join(sids, "sid", "left_semi").dropDuplicates(["sid"])

    def describe(texts: DataFrame) -> DataFrame:
        return full.select("sid", "sig").join(small(texts.select("sid")), "sid", "left_semi").dropDuplicates(["sid"])

    comps = Linker(spark, full.select("sid", "sig"), fetch, shingles, percent, bands, rows, miss, describe).components()
    rooted = materialise(first.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "rooted")
    named = materialise(least_by_root(rooted, "first", "component").select("sid", "component", "n"), "named")
    discard(rooted)
    discard(first)
    return base, named


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 1e-5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Components of near-duplicate documents.

    docs: doc_id long, text string; other columns are not read. A document's set holds its distinct shingles of
    ``words`` words ([^\\x20\\x09-\\x0D]+, A-Z lowered; with fewer words the whole sequence is the one
    shingle). Documents link if the Jaccard similarity of their sets is at least percent/100.
    Candidates share a band of their MinHash signatures; batches of 20 hashes prune those whose
    posterior chance of being similar falls below ``miss``; the rest are verified on the full sets.

    Returns one row per row of docs: doc_id, n_shingles long, component_id (least doc_id
    reachable), kept (doc_id = component_id). Null or blank text: n_shingles 0, linked
    with nothing, kept. Rows with equal sets are one node, whatever their doc_id; rows
    that repeat a doc_id are linked only by their texts. A null doc_id: component_id
    is the least doc_id of its component if there is one, and the row is kept only if there is none.
    An empty table gives an empty result.
    """
    base, named = _rooted(docs, words, percent, miss, bands, rows)
    blank = base.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    linked = join_skewed(base.where("n_shingles > 0").select("doc_id", "sid", "n_shingles"), named, "sid").select("doc_id", "n_shingles", F.col("component.doc_id").alias("component_id"))
    return linked.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())).unionByName(blank)


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of docs, with their own columns: one of each component of near-duplicates.

    Of a component the first row stays, by (doc_id, hash of the text), rows without an id last; rows that equal it in both are one. Each row is judged by its own text, so of two texts with one doc_id one can stay and the other go.
    Rows without a word all stay, but for repeats in doc_id and text."""
    base, named = _rooted(docs, words, percent, 1e-5, BANDS, ROWS)
    key = ["doc_id", "thash"]
    count = base.groupBy(*key).agg(F.any_value("sid").alias("sid"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n"))
    judged = join_skewed(count.where("n_shingles > 0"), named, "sid").unionByName(count.where("n_shingles = 0"), allowMissingColumns=True).withColumn("goes", (F.col("n_shingles") > 0) & ~(F.col("doc_id").eqNullSafe(F.col("component.doc_id")) & (F.col("thash") == F.col("component.thash"))))
    touched = materialise(judged.where("goes or n > 1").select(F.col("doc_id").alias("id"), F.col("thash").alias("th"), "goes"), "touched")
    discard(base)
    # most rows are not among those: a filter lets them by, only the others travel
    some = Bloom(touched.select(F.xxhash64("id", "th").alias("h")), "h")
    text = F.col("text").cast("string")
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash")).withColumn("may", some.column(F.xxhash64("doc_id", "thash")))
    # found ones that go end here, without their texts; of repeats one stays
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("thash") == F.col("th"))
    may = row.where("may")
    goes, once = small(touched.where("goes")), small(touched.where("not goes"))
    left = may.join(goes, same, "left_anti")
    return row.where("not may").select("row.*").unionByName(left.join(once, same, "left_anti").select("row.*")).unionByName(left.join(once, same, "left_semi").dropDuplicates(key).select("row.*"))
