"""Substring dedup by super-k-mers: words go that lie in a window of words which an earlier document has, too.

A window's minimiser is the least hash of the short word sequences in it; equal windows have equal minimisers. Consecutive windows that share a minimiser travel as one packed string
(their words, joined by spaces) to the minimiser's bucket. Buckets of one document alone are found first by minimisers alone, without strings; equal strings
become one before they reach a bucket, so a bucket holds distinct strings, and sorting its windows tells the first document of each exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.session import Bloom, bounded_batches, discard, materialise, release_shuffles, small, thrifty

WINDOW = 50
#: Words of the sequences that minimisers are chosen from: long ones are rarely shared by chance, short ones make longer strings.
SEED = 12
#: Windows of a string at most: repetitive texts share one minimiser over any length.
LONGEST = 256
#: Buckets of more distinct strings than this are dealt out window by window instead.
CROWDED = 4096
#: Windows of crowded buckets in an Arrow batch.
EMIT = 20_000
ID = ["mini", "sid", "sid2"]
FIRSTS = "mini long, sid long, sid2 long, windows int, starts array<int>, firsts array<long>"


def super_kmers(h: np.ndarray, at: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with word hashes h and bounds at: (text, first window, number of windows, minimiser) of each run of windows that share a minimiser."""
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, none, none.view(np.uint64)
    with np.errstate(over="ignore"):
        g = h[: len(h) - seed + 1] * K._COMB[0]
        for t in range(1, seed):
            g += h[t : len(h) - seed + 1 + t] * K._COMB[t]
    g = K.mix(g)
    span, width = window - seed + 1, 1
    while 2 * width <= span:  # least of g[i:i+width], width doubling
        g = np.minimum(g[:-width], g[width:])
        width *= 2
    if width < span:
        g = np.minimum(g[: len(g) - (span - width)], g[span - width :])
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    i = np.flatnonzero(np.arange(len(g)) + window <= at[1:][text[: len(g)]])  # windows that end in their text
    if not len(i):
        return none, none, none, none.view(np.uint64)
    v, t = g[i], text[i]
    new = np.ones(len(i), bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    head = np.flatnonzero(new)
    since = np.arange(len(i)) - np.repeat(head, np.diff(np.append(head, len(i))))
    head = np.flatnonzero(since % LONGEST == 0)
    return t[head], i[head] - at[t[head]], np.diff(np.append(head, len(i))), v[head]


def _each(col: pa.Array, window: int, seed: int):
    data, off = K.raw(col)
    for i, j in K.chunks(off):
        h, _, at = K.words(data, off, i, j, lower=False)
        yield (i, *super_kmers(h, at, window, seed))


def _minimisers(window: int, seed: int):
    """(doc_id, thash, minis) of the texts that have a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text, _, _, mini in _each(b.column(2), window, seed):
                rows, start = np.unique(text, return_index=True)
                if len(rows):
                    minis = [np.unique(x) for x in np.split(mini, start[1:])]
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in minis])]).astype(np.int32)
                    own = pa.array(rows + i)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own), pa.ListArray.from_arrays(pa.array(ends), K.longs(np.concatenate(minis)))], ["doc_id", "thash", "minis"])

    return run


def _packed(window: int, seed: int):
    """Strings of the wanted minimisers of each text: (mini, doc_id, thash, start, packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = b.column(3).cast(pa.list_(pa.int64()))
            for i, text, start, count, mini in _each(b.column(2), window, seed):
                row, first, keep, out = -1, [], [], []
                for k in np.flatnonzero(_among(text + i, mini, wanted)).tolist():
                    if text[k] != row:
                        row = int(text[k])
                        first = b.column(2)[row + i].as_py().encode().split()
                    keep.append(k)
                    out.append(b" ".join(first[start[k] : start[k] + count[k] + window - 1]))
                if keep:
                    own = pa.array(text[keep] + i)
                    yield pa.RecordBatch.from_arrays([K.longs(mini[keep]), b.column(0).take(own), b.column(1).take(own), pa.array(start[keep].astype(np.int32)), pa.array(out, pa.binary()).cast(pa.string())], ["mini", "doc_id", "thash", "start", "packed"])

    return run


def _among(row: np.ndarray, mini: np.ndarray, wanted: pa.ListArray) -> np.ndarray:
    """Which minimisers are among those wanted of their row."""
    ok = np.zeros(len(row), bool)
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    for a, e in zip(heads.tolist(), np.append(heads[1:], len(row)).tolist()):
        ok[a:e] = np.isin(mini[a:e].view(np.int64), wanted[int(row[a])].values.to_numpy())
    return ok


def window_ranks(words: pa.Array, window: int) -> np.ndarray:
    """A number for each place i such that the window words of two places are equal exactly if their numbers are: sequences of 1, 2, 4 ... words are named by pairs of names."""
    name = lambda x: pc.dictionary_encode(x).indices.to_numpy().astype(np.int64)
    rank, width = name(words), 1
    while 2 * width <= window:
        rank = name(pa.array(rank[:-width] << 32 | rank[width:]))
        width *= 2
    return rank if width == window else name(pa.array(rank[: len(rank) - (window - width)] << 32 | rank[window - width :]))


def first_documents(packed: pa.Array, least: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The least document of each window over all strings (least: that of a string), string by string, and the bounds of each string's windows."""
    split = pc.split_pattern(packed, " ")
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    off = split.offsets.to_numpy().astype(np.int64)
    words = split.values
    words = words.slice(off[0], off[-1] - off[0])
    off = off - off[0]
    rank = window_ranks(words, window)
    count = np.diff(off) - window + 1
    bound = np.concatenate([[0], np.cumsum(count)])
    place = np.repeat(off[:-1] - bound[:-1], count) + np.arange(bound[-1])
    rank, doc = rank[place], np.repeat(least, count)
    order = np.argsort(rank, kind="stable")  # the sort that brings equal windows together
    head = np.flatnonzero(np.diff(rank[order], prepend=-1))
    first = np.empty(len(rank), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(doc[order], head), np.diff(np.append(head, len(rank)))) if len(rank) else doc
    return first, bound


def _buckets(window: int):
    """Strings sorted by bucket (mini, sid, sid2, packed, least, most) to runs of windows with their first documents, for strings that lose some windows in some document."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        mini, least, most = (t.column(c).to_numpy() for c in ("mini", "least", "most"))
        same = np.concatenate([[False], mini[1:] == mini[:-1], [False]])
        shared = np.flatnonzero(same[:-1] | same[1:])
        packed = t.column("packed").combine_chunks()
        # alone in its bucket, all of a string's windows are first in its own first document
        count = pc.add(pc.count_substring(packed, " "), 2 - window).to_numpy(zero_copy_only=False).astype(np.int64)
        run_of, run_at, run_first = [np.setdiff1d(np.arange(len(mini)), shared)], [np.zeros(len(mini) - len(shared), np.int64)], [least[np.setdiff1d(np.arange(len(mini)), shared)]]
        if len(shared):
            first, bound = first_documents(packed.take(pa.array(shared)), least[shared], window)
            owner = np.repeat(np.arange(len(shared)), np.diff(bound))
            new = np.flatnonzero((np.diff(first, prepend=first[0] - 1) != 0) | (np.diff(owner, prepend=-1) != 0))
            run_of.append(shared[owner[new]])
            run_at.append(new - bound[owner[new]])
            run_first.append(first[new])
        of, at, fst = np.concatenate(run_of), np.concatenate(run_at), np.concatenate(run_first)
        order = np.lexsort((at, of))
        of, at, fst = of[order], at[order], fst[order]
        loses = np.zeros(len(mini), bool)
        loses[of[fst < most[of]]] = True
        keep = loses[of]
        of, at, fst, own = of[keep], at[keep], fst[keep], np.flatnonzero(loses)
        ends = pa.array(np.searchsorted(of, np.append(own, len(mini))).astype(np.int32))
        ids = [pa.array(t.column(c).to_numpy()[own]) for c in ID]
        return pa.RecordBatch.from_arrays([*ids, pa.array(count[own].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(fst))], [*ID, "windows", "starts", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None and held.num_rows else t
            mini = t.column("mini").to_numpy()
            cut = int(np.searchsorted(mini, mini[-1])) if len(mini) else 0  # the last bucket may go on
            if cut:
                yield solve(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held)

    return run


def _windows(window: int):
    """Each window of each string: (key, mini, sid, sid2, w, least, most), key a 128-bit digest of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, of, at = [], [], []
            for k, text in enumerate(b.column(3).to_pylist()):
                words = text.encode().split(b" ")
                for w in range(len(words) - window + 1):
                    keys.append(hashlib.blake2b(b" ".join(words[w : w + window]), digest_size=16).digest())
                    of.append(k)
                    at.append(w)
                if len(keys) >= EMIT or k == b.num_rows - 1:
                    own = pa.array(of, pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[b.column(c).take(own) for c in (0, 1, 2)], pa.array(at, pa.int32()), b.column(4).take(own), b.column(5).take(own)], ["key", *ID, "w", "least", "most"])
                    keys, of, at = [], [], []

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, spans = b.column(1).to_pylist(), b.column(2).to_pylist()
        out, total, removed = [], [], []
        for text, own in zip(texts, spans):
            words = (text or "").encode().split()
            total.append(len(words))
            if own:
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, [s["a"] for s in own], 1)
                np.add.at(gone, [s["b"] for s in own], -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
            removed.append(total[-1] - len(words))
            out.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "kept"])


def _crowded(strings: DataFrame, window: int) -> DataFrame:
    """The same as _buckets, for buckets of any size: windows are rows, grouped by their words."""
    rows = materialise(strings.mapInArrow(thrifty(_windows(window)), "key binary, mini long, sid long, sid2 long, w int, least long, most long"), "windows")
    first = rows.groupBy("key").agg(F.min("least").alias("first"))
    of = rows.join(first, "key").groupBy(*ID).agg(F.sort_array(F.collect_list(F.struct("w", "first"))).alias("r"), F.max("most").alias("most"))
    return of.where(F.array_min("r.first") < F.col("most")).select(*ID, F.size("r").alias("windows"), F.col("r.w").alias("starts"), F.col("r.first").alias("firsts"))


def dedup_windows(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Documents without the words that lie in a window of ``window`` consecutive words whose sequence also starts in a document with a smaller doc_id.

    docs: doc_id long, text string and any others. Words: [^\\x20\\x09-\\x0D]+, compared as they are. Windows are those of the input, not of what is left.
    Returns (row, n_words, n_removed, kept), a row for each of docs: row a struct of its columns but text, kept the words that stay, joined by one space.

    Null and blank texts: 0 words, kept is empty. Texts of fewer words than a window keep all. A null doc_id is neither smaller nor larger than another: such rows keep all and
    take nothing from others. Rows with one doc_id take nothing from each other, whether their texts are equal or not. An empty table gives no rows. Other columns pass through inside row, whatever their names."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), text.alias("text"))
    # 1. minimisers of each text; those of more than one document
    seeds = materialise(own.where("doc_id is not null and text is not null").mapInArrow(thrifty(_minimisers(window, seed)), "doc_id long, thash long, minis array<long>"), "minis")
    each = seeds.select("doc_id", "thash", F.explode("minis").alias("mini"))
    several = materialise(each.groupBy("mini").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("mini"), "several")
    wanted = materialise(each.join(small(several), "mini").groupBy("doc_id", "thash").agg(F.collect_set("mini").alias("minis")), "wanted")
    discard(seeds)
    discard(several)
    release_shuffles(spark)
    # 2. strings of these, from the texts that have some; others don't travel
    strings = materialise(_joined(own, wanted, "minis").select("doc_id", "thash", "text", "minis").mapInArrow(thrifty(_packed(window, seed)), "mini long, doc_id long, thash long, start int, packed string").withColumn("sid", F.xxhash64("packed")).withColumn("sid2", F.xxhash64(F.lit(1), "packed")), "strings")
    discard(wanted)
    # 3. equal strings are one; buckets are sorted, the few with very many strings are dealt out by window
    distinct = materialise(strings.groupBy(*ID, "packed").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "distinct")
    crowded = materialise(distinct.groupBy("mini").count().where(F.col("count") > CROWDED).select("mini"), "crowded")
    some = small(crowded)
    columns = [*ID, "packed", "least", "most"]
    sorted_ = distinct.join(some, "mini", "left_anti").select(*columns).repartition("mini").sortWithinPartitions("mini")
    firsts = sorted_.mapInArrow(thrifty(_buckets(window)), FIRSTS).unionByName(_crowded(distinct.join(some, "mini", "left_semi").select(*columns), window))
    firsts = materialise(firsts, "firsts")
    # 4. what each document loses
    run = F.transform("firsts", lambda f, k: F.struct((F.col("start") + F.col("starts")[k]).alias("a"), (F.col("start") + F.coalesce(F.get("starts", k + 1), F.col("windows")) + window - 1).alias("b"), f.alias("f")))
    lost = strings.drop("packed").join(firsts, ID).select("doc_id", "thash", F.filter(run, lambda x: x["f"] < F.col("doc_id")).alias("spans")).where("size(spans) > 0")
    lost = materialise(lost.groupBy("doc_id", "thash").agg(F.flatten(F.collect_set("spans")).alias("spans")), "lost")
    for done in (strings, distinct, crowded, firsts):
        discard(done)
    release_shuffles(spark)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("thash"), text.alias("text"))
    cut = _joined(keyed, lost, "spans", others=True).select("row", "text", "spans")
    return cut.mapInArrow(thrifty(_cut), cut.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string"))


def _joined(rows: DataFrame, found: DataFrame, column: str, others: bool = False) -> DataFrame:
    """rows (doc_id, thash, ...) with ``column`` of found (doc_id, thash: one row each). others: rows without one stay, null. A filter lets most of them by, so that their texts aren't shuffled."""
    filter_ = Bloom(found.select(F.xxhash64("doc_id", "thash").alias("h")), "h")
    rows = rows.withColumn("may", filter_.column(F.xxhash64("doc_id", "thash")))
    named = found.select(F.col("doc_id").alias("found_id"), F.col("thash").alias("found_hash"), column)
    got = rows.where("may").join(named, (F.col("thash") == F.col("found_hash")) & (F.col("doc_id") == F.col("found_id")), "left" if others else "inner").drop("may", "found_id", "found_hash")
    return got.unionByName(rows.where("not may").drop("may").withColumn(column, F.lit(None).cast(found.schema[column].dataType))) if others else got
