"""Mixing sources to target weights by nested hash thresholds. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm.session import materialise, small

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that each histogram resolves, and how many there are.
BITS, LEVELS = 12, 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """Orders the documents of a source: depends on id and text alone, so reruns agree and a larger budget contains a smaller one."""
    return F.xxhash64(doc_id, text.cast("string"), F.lit(17))


def digit(h: Column, level: int) -> Column:
    return F.shiftrightunsigned(h, 64 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def prefix(h: Column, level: int) -> Column:
    return F.shiftrightunsigned(h, 64 - BITS * level)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of (source, source_size): shares of share x the whole by weight, each at most
    most x its source's size, what is over going to the others by weight until none is above.

    With sources in order of how soon they are full (most x size / weight), the level at which budget
    per weight stands if the first i are full is right for the first i whose next source it doesn't fill; later ones
    lie lower. It comes from running sums."""
    by_name, one = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    order = Window.orderBy("fills", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    return (
        sizes.withColumn("w", w)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("fills", F.col("cap") / F.col("w"))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(one))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("fills"), F.col("level"))).over(one))
        .select("source", "source_size", F.least("cap", F.coalesce("level", F.lit(float("inf"))) * F.col("w")).alias("target"))
    )


def thresholds(sized: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: float = 3) -> DataFrame:
    """(source, source_size, target, copies, cut) of sized (source, size, h): each document is taken copies times, and once more if
    the first LEVELS x BITS bits of h are below cut.

    Each level sums sizes by source and hash bucket, finds the bucket in which the budget ends and
    goes on inside that bucket only. Nothing is sorted but a source's buckets, at most 2^BITS."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = targets(sizes, weights, share, most).withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(F.lit(0)).cast("long"))
    state = materialise(state.withColumn("rest", F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0))).withColumn("at", F.lit(0).cast("long")), "targets")
    buckets = Window.partitionBy("source").orderBy("bucket")
    for level in range(LEVELS):
        s = small(state.where("rest > 0").select(F.col("source").alias("s"), "at", "rest"))
        # the boundary bucket of the level before: all of the source at first
        inside = sized.join(s, sized.source.eqNullSafe(F.col("s")) & ((prefix(F.col("h"), level) == F.col("at")) if level else F.lit(True)))
        sums = inside.groupBy("source", digit(F.col("h"), level).alias("bucket"), "rest").agg(F.sum("size").alias("n"))
        run = sums.withColumn("upto", F.sum("n").over(buckets)).where("upto - n < rest").groupBy("source").agg(F.max_by("bucket", "bucket").alias("bucket"), F.max_by(F.col("upto") - F.col("n"), "bucket").alias("below"), F.max_by("n", "bucket").alias("n"))
        run = run.withColumnRenamed("source", "s")
        state = state.join(run, state.source.eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "copies",
            (F.col("at") * (1 << BITS) + F.coalesce("bucket", F.lit(0))).alias("at"),
            (F.col("rest") - F.coalesce("below", F.lit(0))).alias("rest"),
            F.coalesce("n", F.lit(0)).alias("last"),
        )
        state = materialise(state, "cut")
    # the last bucket goes in whole if that ends nearer to the target
    return state.select("source", "source_size", "target", "copies", (F.col("at") + F.when(F.col("rest") * 2 >= F.col("last"), F.when(F.col("last") > 0, 1).otherwise(0)).otherwise(0)).alias("cut"))


def times(size: Column, h: Column) -> Column:
    """How often a document is taken."""
    return F.when(size > 0, F.col("copies") + F.when(prefix(h, LEVELS) < F.col("cut"), 1).otherwise(0)).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: float = 3) -> DataFrame:
    """How many words of each document a mix of the sources takes.

    docs: doc_id long, text and source string; others are not read. Sources in order of code points, null (a source of its own) last, weigh
    ``weights`` in turn and share ``share`` x all words; see targets(). Of each source whole documents are taken: all of them
    as often as the target allows, then those whose hash is below the threshold at which the rest of the target is reached.

    Returns doc_id, source, size, source_size, target, taken, one row for each of docs. Null, empty or blank
    text: size 0, taken 0. Equal rows have equal hashes and are taken alike. An empty table gives
    an empty result; a source of size 0 has target 0."""
    sized = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), row_hash(F.col("doc_id").cast("long"), F.col("text")).alias("h")), "sized")
    t = small(thresholds(sized, weights, share, most).withColumnRenamed("source", "s"))
    return sized.join(t, sized.source.eqNullSafe(t.s)).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times(F.col("size"), F.col("h"))).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: float = 3) -> DataFrame:
    """The mix itself: the rows of docs, each as often as mix() takes it, with their own columns. Documents without words are not part of a mix by words and are kept once."""
    sized = materialise(docs.select(F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), row_hash(F.col("doc_id").cast("long"), F.col("text")).alias("h")), "sized")
    t = small(thresholds(sized, weights, share, most).withColumnRenamed("source", "s"))
    row = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("of"), n_words(F.col("text")).alias("size"), row_hash(F.col("doc_id").cast("long"), F.col("text")).alias("h"))
    n = F.when(F.col("size") == 0, 1).otherwise(times(F.col("size"), F.col("h"))).cast("int")
    return row.join(t, row.of.eqNullSafe(t.s)).select("row", n.alias("n")).where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
