"""Hierarchical language identification: family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm.session import bounded_batches, materialise, small, thrifty

from reachspark.llm import textkernel as K

#: Feature buckets, and the labelled documents that a model is fitted on (more only if LEAST of each language are).
BUCKETS, SAMPLE = 2048, 4000
#: Documents of each language that a model is fitted on at least, and bits of a hash that documents are drawn by first.
LEAST, BITS = 8, 16
UNKNOWN = "und"

# Language families of ISO 639-1 codes. Codes that are not here form one family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru pl cs sk uk be bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky tt",
    "semitic": "ar he am mt",
    "indic": "hi bn ur pa gu mr ne si",
    "sinitic": "zh yue",
}
_FAMILY = {code: f for f, codes in FAMILIES.items() for code in codes.split()}

# Letters keep their (lower) byte, bytes beyond ASCII too; everything else is a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


def family(code: str) -> str:
    return _FAMILY.get(code.lower().split("-")[0].split("_")[0], "other")


def features(data: np.ndarray, off: np.ndarray, i: int, j: int) -> np.ndarray:
    """Rows of unit length: square roots of counts of hashed 1- to 3-grams of bytes, over whole texts."""
    n, d = j - i, _FOLD[data[off[i] : off[j]]].astype(np.uint32)
    bound = off[i : j + 1] - off[i]
    if len(d) > 1:  # runs of spaces count once
        keep = np.ones(len(d), bool)
        keep[1:] = (d[1:] != 32) | (d[:-1] != 32)
        bound = np.concatenate([[0], np.cumsum(keep)])[bound]
        d = d[keep]
    of = np.repeat(np.arange(n), np.diff(bound))
    x = np.zeros(n * BUCKETS)
    key = np.zeros(len(d), np.uint32)
    for m in range(3):
        if len(d) <= m:
            break
        key = key[: len(d) - m] * np.uint32(257) + d[m:] + np.uint32(1) if m else d + np.uint32(1)
        spot = (((key * np.uint32(2654435761)) ^ np.uint32(m * 40503)) >> np.uint32(21)).astype(np.int64)
        same = of[: len(spot)] == of[m:]
        x += np.bincount((of[: len(spot)] * BUCKETS + spot)[same], minlength=n * BUCKETS)
    x = np.sqrt(x).reshape(n, BUCKETS)
    return (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


def _small_chunks(off: np.ndarray) -> Iterator[tuple[int, int]]:
    for i, j in K.chunks(off):
        for a in range(i, j, 512):
            yield a, min(j, a + 512)


def train_svm(x: np.ndarray, y: np.ndarray, epochs: int = 40, c: float = 10.0) -> np.ndarray:
    """A linear SVM (hinge loss, L2) by dual coordinate descent, classes of equal weight; y of -1 and 1; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    w, a = np.zeros(x.shape[1], np.float32), np.zeros(len(x))
    q = (x * x).sum(1)
    top = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        change = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * float(x[i] @ w) - 1
            new = min(max(a[i] - g / q[i], 0.0), top[i])
            if new != a[i]:
                w += np.float32((new - a[i]) * y[i]) * x[i]
                change = max(change, abs(new - a[i]))
                a[i] = new
        if change < 1e-3:
            break
    return w


class Model:
    """weights: of each family against the others, then of each pair of languages of a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family(v) for v in self.langs})
        y, fam = np.array(langs, object), np.array([family(v) for v in langs], object)
        self.family_w = np.stack([train_svm(x, np.where(fam == f, 1, -1)) for f in self.families]) if len(self.families) > 1 else None
        self.of = {f: [v for v in self.langs if family(v) == f] for f in self.families}
        self.pair_w = {}
        for f in self.families:
            for a, b in combinations(self.of[f], 2):
                pick = (y == a) | (y == b)
                self.pair_w[a, b] = train_svm(x[pick], np.where(y[pick] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1: chance of the family times the mean chance of the language against each other of the family)."""
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        squash = lambda m: 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))
        n = len(x)
        if self.family_w is not None:
            m = squash(x @ self.family_w.T)
            which, sure = m.argmax(1), m.max(1) / np.maximum(m.sum(1), 1e-12)
        else:
            which, sure = np.zeros(n, int), np.ones(n)
        out, score = np.empty(n, object), sure.astype(float)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(which == f)
            own = self.of[name]
            if not len(rows):
                continue
            if len(own) == 1:
                out[rows] = own[0]
                continue
            votes, chance = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
            for (a, b), w in ((p, w) for p, w in self.pair_w.items() if p[0] in own):
                m = x[rows] @ w
                i, j = own.index(a), own.index(b)
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                chance[:, i] += squash(m)
                chance[:, j] += 1 - squash(m)
            best = (votes + chance / (len(own) + 1)).argmax(1)  # ties in votes go to the surer
            out[rows] = np.array(own, object)[best]
            score[rows] *= chance[np.arange(len(rows)), best] / (len(own) - 1)
        return out.tolist(), score


def remainder() -> object:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from documents with text and lang whose remainder is not 0; the only columns read.

    Every language is learned. Of each the rows with the least hashes are taken, ``sample`` shared out equally but no fewer than LEAST of each
    (or all that it has); copies of a row count once. Only the sample's features reach the driver. There is a classifier for every two languages of a family, so time and
    the model's size grow with the square of their number. None if there is nothing to learn from."""
    train = docs.where(remainder() != 0).where("text is not null and lang is not null").select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    train = train.withColumn("draw", F.xxhash64("doc_id", "text", F.lit(5)))
    # rows of each language by the first bits of their hash: up to which bits there are enough
    cell = materialise(train.groupBy("lang", F.shiftrightunsigned("draw", 64 - BITS).alias("cell")).agg(F.count_distinct("draw").alias("n")), "cells")
    by = Window.partitionBy("lang").orderBy("cell")
    n = cell.select("lang").distinct().count()
    if not n:
        return None
    each = max(LEAST, sample // n)
    upto = cell.withColumn("before", F.sum("n").over(by) - F.col("n")).where(F.col("before") < each).groupBy("lang").agg(F.max("cell").alias("upto"))
    drawn = train.join(small(upto, n), "lang").where(F.shiftrightunsigned("draw", 64 - BITS) <= F.col("upto")).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("draw", 64 - BITS), "draw", "text"))
    picked = drawn.withColumn("place", place).where(F.col("place") <= each).select("lang", "text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = K.raw(b.column(1))
            for i, j in _small_chunks(off):
                x = features(data, off, i, j).astype(np.float16)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), K.binary(x.view(np.uint8))], ["lang", "x"])

    got = picked.mapInArrow(thrifty(made), "lang string, x binary").toArrow()
    x = K.matrix(got.column("x"), 2 * BUCKETS).view(np.float16).astype(np.float32)
    langs = got.column("lang").to_pylist()
    if not langs:
        return None
    order = sorted(range(len(langs)), key=lambda r: (langs[r], x[r].tobytes()))  # the same model whatever order rows came in
    return Model(x[order], [langs[r] for r in order])


def _predicted(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            data, off = K.raw(col)
            for i, j in _small_chunks(off):
                n = j - i
                seen = np.concatenate([[0], np.cumsum(_LETTER[data[off[i] : off[j]]])])
                letter = np.diff(seen[off[i : j + 1] - off[i]]) > 0
                for r in np.flatnonzero(~letter).tolist():
                    text = col[i + r].as_py()
                    letter[r] = bool(text) and any(ch.isalpha() for ch in text)
                langs, score = model.predict(features(data, off, i, j)) if model else ([UNKNOWN] * n, np.zeros(n))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), pa.array([v if ok else UNKNOWN for v, ok in zip(langs, letter)], pa.string()), pa.array(np.where(letter, score, 0.0))], ["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(row, lang_pred, score) for each row of docs, row a struct of its columns; only text is an input. Whole texts are read.

    Null text, or one without a letter: und, score 0; without a model every row is und. Empty tables give empty results; repeated rows get equal predictions."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(thrifty(_predicted(model)), rows.select("row").schema.add("lang_pred", "string").add("score", "double"))


def languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Fits on docs (see fit) and predicts all of them: doc_id, held_out (remainder is 0), lang_pred, score."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("lang"))
    return identify(slim.select("doc_id", "text"), fit(slim, sample)).select("row.doc_id", "lang_pred", "score").select("doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score")
