"""License scan by diagonal voting: rolling word k-gram hashes meet template positions in a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.license_texts import TEMPLATES
from reachspark.llm.session import materialise, thrifty

K_WORDS = 4

# Phrases that name a license, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

def _hashes(texts: list[str]) -> list[np.ndarray]:
    data, off = K.raw(pa.array(texts, pa.string()))
    h, _, at = K.words(data, off, 0, len(texts), K.ALNUM)
    return [h[a:b] for a, b in zip(at[:-1], at[1:])]


def template_positions(templates: dict[str, list[str]], k: int) -> list[tuple[int, int, int, str, int]]:
    """(hash, template, position, label, words of the template) of every k-gram: as many rows as the fixed texts have words."""
    flat = [(label, t) for label, texts in templates.items() for t in texts]
    out = []
    for n, ((label, _), h) in enumerate(zip(flat, _hashes([t for _, t in flat]))):
        if len(h) >= k:
            g, _ = K.grams(h, np.array([0, len(h)]), k)
            out += [(int(x), n, p, label, len(h)) for p, x in enumerate(g.view(np.int64).tolist())]
    return out


def _scan(phrases: dict[str, str], known: np.ndarray, k: int):
    wanted = list(zip(_hashes(list(phrases)), phrases.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for b in batches:
            data, off = K.raw(b.column(1))
            for i, j in K.chunks(off):
                h, _, at = K.words(data, off, i, j, K.ALNUM)
                n = j - i
                of = np.repeat(np.arange(n), np.diff(at))
                n_base, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
                labels: list[set[str]] = [set() for _ in range(n)]
                for want, label in wanted:
                    m = len(want)
                    if m == 0 or len(h) < m:
                        continue
                    spot = np.flatnonzero(h[: len(h) - m + 1] == want[0])
                    spot = spot[of[spot] == of[spot + m - 1]]
                    for t in range(1, m):
                        spot = spot[h[spot + t] == want[t]]
                    doc, pos = of[spot], spot - at[of[spot]]
                    np.add.at(n_base, doc, 1)
                    for d, p in zip(doc.tolist(), pos.tolist()):
                        labels[d].add(label)
                        first[d] = p if first[d] < 0 else min(first[d], p)
                        last[d] = max(last[d], p)
                hits: list[list[dict] | None] = [None] * n
                if len(h) >= k and len(known):
                    roll, _ = K.grams(h, np.array([0, len(h)]), k)
                    ok = of[: len(roll)] == of[k - 1 :]
                    spot = np.searchsorted(known, roll)
                    spot[spot == len(known)] = 0
                    for s in np.flatnonzero(ok & (known[spot] == roll)).tolist():
                        d = int(of[s])
                        if hits[d] is None:
                            hits[d] = []
                        hits[d].append({"h": int(roll[s : s + 1].view(np.int64)[0]), "p": s - int(at[d])})
                own = [h[a:e].tobytes() if x else None for x, a, e in zip(hits, at[:-1].tolist(), at[1:].tolist())]
                none = first < 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)), b.column(0).slice(i, n), pa.array(np.diff(at)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                        pa.array([sorted(x) for x in labels], pa.list_(pa.string())), pa.array(hits, pa.list_(pa.struct([("h", pa.int64()), ("p", pa.int64())]))), pa.array(own, pa.binary()),
                    ],
                    ["row_no", "doc_id", "n_words", "n_base", "first_word", "last_word", "base", "hits", "own"],
                )
                row += n

    return run


def _verified(words: list[np.ndarray]):
    """How many words of its template each merged diagonal covers, compared word by word: a template's word counts if the text has it at one of the group's offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = []
            for template, offsets, start, stop, own in zip(*[b.column(c).to_pylist() for c in range(1, 6)]):
                text, want = np.frombuffer(own, np.uint64), words[template]
                hit = np.zeros(len(want), bool)
                for d in offsets:
                    lo, hi = max(0, start - d), min(len(want), stop - d)
                    if lo < hi:
                        hit[lo:hi] |= want[lo:hi] == text[lo + d : hi + d]
                n.append(int(hit.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), pa.array(n, pa.int64())], ["row_no", "template", "start", "stop", "covered"])

    return run


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None, k: int = K_WORDS, drift: int = 3, share: float = 0.8, words: int = 30) -> DataFrame:
    """License labels of documents by phrases and by diagonals of template matches.

    docs: doc_id long, text string; others are not read. Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z is lowered. Base: places where a phrase's words stand one
    after another. Beyond it, the rolling hashes of k words of every text are joined with the positions
    of the templates' k-grams (hashes that no template has are dropped at the scan, before the join); matches vote for their
    diagonal (place in the text less place in the template); diagonals at most ``drift`` apart merge; merged ones are verified word by word: one counts if it
    covers at least ``share`` of the template's words or of ``words`` words, whichever is less, in a stretch of the text at most
    1.5 times as long as what it covers.

    Returns a row for each row of docs: doc_id, n_words, n_base (all places), first_word and last_word (least and largest
    start of a place, words from 0, or null), base_labels and labels (distinct, sorted, comma-joined; labels has the base ones and the diagonals'),
    score (1 with a base label, else the largest part of a template covered, 0 without label) and spans (array of label, template, start, stop in
    words, covered part). Null text: empty, no words or labels. Repeated rows are each scanned. An empty table gives an empty result."""
    spark = docs.sparkSession
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    rows = template_positions(templates, k)
    known = np.unique(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    schema = "row_no long, doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, hits array<struct<h:long,p:long>>, own binary"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(thrifty(_scan(phrases, known, k)), schema)
    found = materialise(found, "scan")
    # a row for each word of the fixed templates: a proven bound, so broadcast
    positions = F.broadcast(spark.createDataFrame(rows or [(0, -1, 0, "", 1)], "h long, template int, q int, label string, size int"))
    votes = found.where("hits is not null").select("row_no", F.explode("hits").alias("x")).select("row_no", F.col("x.h").alias("h"), F.col("x.p").alias("p")).join(positions, "h").withColumn("diagonal", F.col("p") - F.col("q"))
    lines = votes.groupBy("row_no", "template", "label", "size", "diagonal").agg(F.collect_set(F.struct("q", "p")).alias("at"))
    beside = Window.partitionBy("row_no", "template").orderBy("diagonal")
    lines = lines.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(beside) <= drift, 0).otherwise(1)).withColumn("group", F.sum("new").over(beside))
    merged = lines.groupBy("row_no", "template", "label", "size", "group").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at"))
    # an edited word spoils k k-grams: half of what is asked for suffices to be verified
    q = F.array_sort(F.array_distinct(F.transform("at", lambda x: x["q"])))
    rough = F.aggregate(q, F.struct(F.lit(0).alias("n"), F.lit(-(10**6)).alias("end")), lambda a, x: F.struct((a["n"] + F.least(F.lit(k), x + k - a["end"])).alias("n"), (x + k).alias("end")), lambda a: a["n"])
    merged = merged.withColumn("start", F.array_min(F.transform("at", lambda x: x["p"]))).withColumn("stop", F.array_max(F.transform("at", lambda x: x["p"])) + k)
    merged = merged.where(rough >= F.lit(share / 2) * F.least("size", F.lit(words))).select("row_no", "template", F.array_distinct(F.transform("at", lambda x: (x["p"] - x["q"]).cast("long"))).alias("offsets"), "start", "stop")
    flat = [(label, t) for label, texts in templates.items() for t in texts]
    sizes = F.broadcast(spark.createDataFrame([(n, label, len(h)) for n, ((label, _), h) in enumerate(zip(flat, _hashes([t for _, t in flat])))] or [(-1, "", 1)], "template int, label string, size int"))
    checked = merged.join(found.where("own is not null").select("row_no", "own"), "row_no").select("row_no", "template", "offsets", "start", "stop", "own")
    checked = checked.mapInArrow(thrifty(_verified(_hashes([t for _, t in flat]))), "row_no long, template int, start long, stop long, covered long").join(sizes, "template")
    good = checked.where((F.col("covered") >= F.lit(share) * F.least("size", F.lit(words))) & (F.col("stop") - F.col("start") <= 1.5 * F.col("covered")))
    spans = good.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "label", "template", (F.col("covered") / F.col("size")).alias("part")))).alias("spans"))
    none = F.array().cast("array<struct<start:long,stop:long,label:string,template:int,part:double>>")
    both = found.drop("hits", "own").join(spans, "row_no", "left").withColumn("spans", F.coalesce("spans", none))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("spans", lambda x: x["label"]))))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda x: F.least(x["part"], F.lit(1.0)))), F.lit(0.0)))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), "spans")
