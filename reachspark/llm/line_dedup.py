"""Fuzzy line dedup: one line stays of each component of near-equal lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.components import least_by_root
from reachspark.llm.neardup import Linker
from reachspark.llm.session import Bloom, bounded_batches, discard, join_skewed, materialise, release_shuffles, small, thrifty

CHARS = 5
BANDS, ROWS = 36, 7  # at similarity 0.8 a pair of lines shares no band once in 4,800, at 0.85 once in 1,300,000
#: Lines of up to so many distinct shingles have MinHash values of independent hashes: one permutation varies too much for them.
SHORT = 64
#: Bytes of text whose signatures are made at once.
SIGNED = 1 << 19
#: Blanks at the ends of lines that are taken off one by one; where lines have more, all bytes of their texts are looked at.
TRIMS = 6
LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _lines(data: np.ndarray, off: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Non-blank lines of texts i to j-1, trimmed and A-Z lowered: joined bytes, their bounds, text of each line, number of each in its text."""
    d = data[off[i] : off[j]]
    start, end, first = K.line_spans(d, off[i : j + 1] - off[i])
    some = np.flatnonzero(end > start)
    s, e = start[some], end[some]
    for step in range(TRIMS):  # few lines begin or end in more than a blank or two
        if not len(s):
            break
        left, right = ~K.SPACED[d[s]], ~K.SPACED[d[e - 1]]
        if not left.any() and not right.any():
            break
        s, e = s + left, e - right
        keep = e > s
        if not keep.all():
            some, s, e = some[keep], s[keep], e[keep]
    else:
        solid = np.flatnonzero(K.SPACED[d])
        at, to = np.searchsorted(solid, s), np.searchsorted(solid, e)
        keep = to > at
        some, s, e = some[keep], solid[at[keep]], solid[to[keep] - 1] + 1
    if not len(some):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.empty(2 * len(s) + 1, np.int64)
    edge[0], edge[1::2], edge[2::2] = 0, s, e
    inside = np.zeros(2 * len(s), bool)
    inside[1::2] = True
    text = np.searchsorted(first, some, side="right") - 1
    return LOW[d[: e[-1]][np.repeat(inside, np.diff(edge))]], np.concatenate([[0], np.cumsum(e - s)]), text, some - first[text]


def _line_ids(flat: np.ndarray, bound: np.ndarray) -> np.ndarray:
    p, inv = K.powers(len(flat))
    with np.errstate(over="ignore"):
        return K.mix(np.add.reduceat(K._BYTE[flat] * p[: len(flat)], bound[:-1]) * inv[bound[:-1]])


def _each(batches: Iterator[pa.RecordBatch], column: int):
    for b in batches:
        data, off = K.raw(b.column(column))
        for i, j in K.chunks(off):
            flat, bound, text, number = _lines(data, off, i, j)
            if len(text):
                yield b, i, flat, bound, text, number


def _occurrences(wanted: Bloom):
    """Every line of every text; with its own text where its id is wanted, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = Fresh()
        for b, i, flat, bound, text, number in _each(batches, 2):
            ids = _line_ids(flat, bound)
            want = np.flatnonzero(wanted.has(ids))
            want = want[given.first(ids[want])]
            own = np.full(len(ids), None, object)
            for r in want.tolist():
                own[r] = flat[bound[r] : bound[r + 1]].tobytes().decode("utf-8", "replace")
            at = pa.array(text + i)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(number.astype(np.int32)), K.longs(ids), pa.array(own, pa.string())], ["doc_id", "thash", "line", "sid", "text"])

    return run


class Fresh:
    """Ids that a task meets for the first time; it remembers some hundred thousand, then starts anew: a repeat does no harm."""

    def __init__(self, most: int = 500_000):
        self.seen: set[int] = set()
        self.most = most

    def first(self, ids: np.ndarray) -> np.ndarray:
        """Rows of ids that are new, of equal ones the first."""
        rows = np.unique(ids, return_index=True)[1]
        new = [r for r, v in zip(rows.tolist(), ids[rows].tolist()) if v not in self.seen]
        if len(self.seen) > self.most:
            self.seen.clear()
        self.seen.update(ids[new].tolist())
        return np.array(new, np.int64)


def _some(cp: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the given lines (in order) alone, and their bounds."""
    if len(rows) < len(size):
        chosen = np.zeros(len(size), bool)
        chosen[rows] = True
        cp = cp[np.repeat(chosen, size)]
    return cp, np.concatenate([[0], np.cumsum(size[rows])])


def _signed(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = Fresh()
        for b in batches:
            data, off = K.raw(b.column(0))
            for i, j in K.chunks(off, SIGNED):
                flat, bound, text, _ = _lines(data, off, i, j)
                if not len(text):
                    continue
                ids = _line_ids(flat, bound)
                own = fresh.first(ids)
                if not len(own):
                    continue
                own.sort()
                ids = ids[own]
                cp, bound = K.characters(*_some(flat, np.diff(bound), own))
                # sets of few shingles get independent hashes, others one permutation; sizes between get both, so
                # that two sets with sizes within a quarter of each other have one kind in common. Repeats don't count: lines with equal sets are of one size, however
                # long they are. A set has at least as many shingles as bins that it fills; only where that leaves the kind open are they counted.
                # A line of fewer than k characters is its own only shingle: it is like no other line
                chars = np.diff(bound)
                size = chars - k + 1
                long = np.flatnonzero(size > SHORT)
                if len(long):
                    sub, sb = _some(cp, chars, long)
                    g = K.run_hashes(sub, k)
                    sig, filled = K.one_permutation_of_runs(g, sb, k, width)
                    open_ = np.flatnonzero(filled <= SHORT * 5 // 4)
                    size[long] = np.maximum(filled, SHORT + SHORT)
                    for r in open_.tolist():
                        x = np.sort(g[sb[r] : sb[r + 1] - k + 1])
                        size[long[r]] = 1 + np.count_nonzero(x[1:] != x[:-1])
                    keep = size[long] > SHORT
                    yield _kinds(ids[long[keep]], sig[keep], 1)
                rows = np.flatnonzero((size > 0) & (size <= SHORT * 5 // 4))
                if len(rows):
                    sub, sb = _some(cp, chars, rows)
                    g = K.run_hashes(sub, k)
                    yield _kinds(ids[rows], K.signatures(*K.within(g, sb, k), width), 0)

    return run


def _kinds(ids: np.ndarray, sig: np.ndarray, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([K.longs(ids), K.binary(np.hstack([sig, np.full((len(ids), 1), kind, np.uint8)]))], ["sid", "sig"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, gone = b.column(1).to_pylist(), b.column(2).to_pylist()
        out, lines, kept = [], [], []
        for t, g in zip(texts, gone):
            if t is None:
                out.append(None)
                lines.append(0)
                kept.append(0)
                continue
            part = t.split("\n")
            lines.append(len(part))
            if g:
                drop = set(g)
                part = [x for n, x in enumerate(part) if n not in drop]
                t = "\n".join(part)
            kept.append(len(part))
            out.append(t)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(lines, pa.int64()), pa.array(kept, pa.int64())], ["row", "clean", "n_lines", "n_kept"])


def dedup_lines(docs: DataFrame, percent: int = 80, chars: int = CHARS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Documents without the lines that nearly equal an earlier line.

    docs: doc_id long, text string and any others. Lines are what line feeds separate. A line is compared trimmed and with A-Z lowered,
    by its set of shingles of ``chars`` characters (a shorter line is its own shingle). Lines link if
    the Jaccard similarity is at least percent/100; candidates share a band of MinHash signatures and all are
    verified exactly. Of each component the first line stays (by doc_id, nulls last; then hash of the text; then line number), the others go.

    Returns (row, clean, n_lines, n_kept), a row for each of docs: row a struct of its other columns, clean the text left
    (lines that stay are unchanged), n_lines and n_kept the numbers of lines before and after. Blank lines stay. Null
    text stays null, with 0 lines; an empty one has one blank line. Rows equal in
    doc_id and text are one occurrence and lose the same lines. Columns of any name pass through inside row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col("text").cast("string")
    thash = F.xxhash64(text)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), thash.alias("thash"), text.alias("text"))
    shingles, width = K.Shingles("chars", chars), bands * rows
    seen: list[DataFrame] = []

    def fetch(sids: DataFrame) -> DataFrame:
        # a second pass over the texts: all lines without their text, but for candidates
        wanted = Bloom(sids, "sid")
        seen.append(materialise(own.mapInArrow(thrifty(_occurrences(wanted)), "doc_id long, thash long, line int, sid long, text string"), "lines"))
        return seen[0].where("text is not null").select("sid", "text").join(small(sids), "sid", "left_semi").dropDuplicates(["sid"])

    def signed(texts: DataFrame) -> DataFrame:
        return texts.select("text").mapInArrow(thrifty(_signed(chars, width)), "sid long, sig binary")

    comps = Linker(spark, own.select("text"), fetch, shingles, percent, bands, rows, None, signed, likeliest=False, prepare=_signed(chars, width)).components()
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "thash", "line")
    lines = seen[0].drop("text")
    first = lines.groupBy("sid").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    # lines that are alone lose nothing and need no second look
    rooted = first.join(small(comps.withColumnRenamed("node", "sid")), "sid", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "sid"))
    rooted = materialise(rooted, "rooted")
    keep = materialise(least_by_root(rooted, "first", "keep").select("sid", "keep", "n"), "keep")
    gone = join_skewed(lines, keep, "sid", width=64).where(place != F.col("keep")).groupBy("doc_id", "thash").agg(F.collect_set("line").alias("gone"))
    gone = materialise(gone, "gone")
    for done in (seen[0], rooted, keep):
        discard(done)
    release_shuffles(spark)
    # most documents lose nothing: a filter lets them by, and only the others' texts travel to the join
    loses = Bloom(gone.select(F.xxhash64("doc_id", "thash").alias("h")), "h")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), thash.alias("thash"), text.alias("text"))
    keyed = keyed.withColumn("may", loses.column(F.xxhash64("doc_id", "thash")))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    whole = keyed.where("not may").select("row", F.col("text").alias("clean"), n.alias("n_lines"), n.alias("n_kept"))
    lists = gone.withColumnRenamed("doc_id", "gone_id").withColumnRenamed("thash", "gone_hash")
    some = keyed.where("may").join(lists, (F.col("thash") == F.col("gone_hash")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select("row", "text", "gone")
    return whole.unionByName(some.mapInArrow(thrifty(_cut), some.select("row").schema.add("clean", "string").add("n_lines", "long").add("n_kept", "long")))
