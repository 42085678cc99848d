"""Interpolated modified Kneser-Ney model of n-grams, counted in Spark, kept as sorted hash arrays that workers map into memory."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.session import bounded_batches, discard, materialise, new_path, partitions, release_shuffles, thrifty

START, END = np.uint64(0x1234567), np.uint64(0x7654321)
#: Tokens that a task counts together before it sends them; training tokens of a shard on average (some 200 MB while a worker makes it); bytes scored at once.
SEGMENT, SHARD, SCORED = 1_500_000, 5_000_000, 2 << 20
#: Number of the start token; others have numbers by how frequent they are.
FIRST = np.uint32(0xFFFFFFFF)


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix(u * np.uint64(0x9E3779B97F4A7C15) + w)


def ngrams(data: np.ndarray, off: np.ndarray, i: int, j: int, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the tokens of texts i to j-1 (each text's words, then its end), each with the order-1 tokens before it (first the furthest; before a text stand order-1 starts), and where each text's begin."""
    h, _, at = K.words(data, off, i, j)
    n = j - i
    last = at[1:] + np.arange(n)
    w = np.empty(len(h) + n, np.uint64)
    word = np.ones(len(w), bool)
    word[last] = False
    w[word], w[last] = h, END
    bound = at + np.arange(n + 1)
    place = np.arange(len(w)) - np.repeat(bound[:-1], np.diff(bound))
    out = [w]
    for k in range(1, order):
        u = np.full(len(w), START)
        u[k:] = np.where(place[k:] >= k, w[:-k], START)
        out.insert(0, u)
    return out, bound


def contexts_of(words: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the contexts of 1, 2, ... words before the last of words."""
    out = [words[-2]]
    for u in words[-3::-1]:
        out.append(pair_hash(out[-1], u))
    return out


def shard_key(k: int, order: int) -> int:
    """Words of the context by which n-grams of contexts of k words are dealt to shards: two lengths share one, so that a shard has all n-grams of both."""
    while order > 3 and k < order - 2:
        order -= 2
    return max(1, order - 2)


def _run(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of key, and where each value begins in it."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    return order, np.flatnonzero(first)


class Store:
    """Files under a folder that driver and executors share. file: folders are used in place; others are reached through pyarrow and a file is copied to the worker before it is mapped."""

    def __init__(self, path: str):
        self.path = path
        self.local = urlparse(path).path if urlparse(path).scheme in ("", "file") else None
        self._kept: dict[str, Table] = {}

    def __getstate__(self):
        return {"path": self.path, "local": self.local, "_kept": {}}

    def save(self, name: str, parts: list[np.ndarray]) -> None:
        """Whole or not at all, and the same bytes if a task runs again."""
        data = b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)
        if self.local:
            os.makedirs(self.local, exist_ok=True)
            part = f"{self.local}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, f"{self.local}/{name}.bin")
            return
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.path)
        where.create_dir(root, recursive=True)
        with where.open_output_stream(f"{root}/{name}.bin") as f:
            f.write(data)

    def map(self, name: str) -> np.ndarray:
        if self.local:
            return np.asarray(np.memmap(f"{self.local}/{name}.bin", np.uint8, "r"))
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.path)
        with tempfile.NamedTemporaryFile(suffix=".bin") as out:  # its name goes at once, the mapping stays
            with where.open_input_stream(f"{root}/{name}.bin") as f:
                while block := f.read(1 << 24):
                    out.write(block)
            out.flush()
            return np.asarray(np.memmap(out.name, np.uint8, "r"))

    def load(self, name: str) -> Table:
        if name not in self._kept:
            self._kept[name] = Table(self.map(name))
        return self._kept[name]


class Table:
    """A mapped file of rows of counts by sorted hash. The first bits of a hash name a bucket of about eight, the next 32 are kept: a hash that isn't there is taken for one that
    is once in 500 million times, unless the table was made ``whole``: then all 64 bits are compared. Of each row a byte is kept, the number of its counts in a list of the 255 most frequent rows; others lie in a list of their own."""

    def __init__(self, data: np.ndarray):
        head = data[:48].view(np.int64)
        self.bits, self.n, self.width, kinds, more, whole = (int(x) for x in head)
        at = 48
        for name, size, kind, shape in (("start", (1 << self.bits) + 1, np.uint32, None), ("rest", self.n, np.uint32, None), ("code", self.n, np.uint8, None), ("value", kinds * self.width, np.int64, self.width), ("big", more, np.uint64, None), ("large", more * self.width, np.int64, self.width), ("whole", whole, np.uint64, None)):
            span = size * np.dtype(kind).itemsize
            a = data[at : at + span].view(kind)
            setattr(self, name, a.reshape(-1, shape) if shape else a)
            at += span + -span % 8

    @staticmethod
    def parts(h: np.ndarray, values: np.ndarray, whole: bool = False) -> list[np.ndarray]:
        """h: sorted distinct hashes; values: a row of counts for each; whole: keep the hashes themselves too."""
        bits = min(30, (len(h) // 8).bit_length())
        top = h >> np.uint64(64 - bits) if bits else np.zeros(len(h), np.uint64)
        start = np.searchsorted(top, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
        rest = (h >> np.uint64(32 - bits)).astype(np.uint32)
        key = np.zeros(len(h), np.int64)
        for c in range(values.shape[1]):
            key = (key << 15) | np.minimum(values[:, c], 32767)
        _, first, kind, often = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        kept = np.argsort(-often, kind="stable")
        kept = kept[(values[first[kept]] < 32767).all(1)][:255]
        code = np.full(len(first), 255, np.uint8)
        code[kept] = np.arange(len(kept))
        code = code[kind.ravel()]
        wide = np.flatnonzero(code == 255)
        return [np.array([bits, len(h), values.shape[1], len(kept), len(wide), len(h) if whole else 0], np.int64), start, rest, code, values[first[kept]].astype(np.int64), h[wide], values[wide].astype(np.int64), h if whole else h[:0]]

    def find(self, q: np.ndarray) -> np.ndarray:
        """Rows of counts of hashes q, zeros where there is none."""
        out = np.zeros((len(q), self.width), np.int64)
        if not self.n or not len(q):
            return out
        bucket = (q >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(q), np.int64)
        lo, end = self.start[bucket].astype(np.int64), self.start[bucket + 1].astype(np.int64)
        kept, r = (self.whole, q) if len(self.whole) else (self.rest, (q >> np.uint64(32 - self.bits)).astype(np.uint32))
        hi = end.copy()
        for _ in range(int((end - lo).max()).bit_length()):
            mid = (lo + hi) >> 1
            less = (lo < hi) & (kept[np.minimum(mid, self.n - 1)] < r)
            hi = np.where(less, hi, mid)
            lo = np.where(less, mid + 1, lo)
        at = np.minimum(lo, self.n - 1)
        ok = np.flatnonzero((lo < end) & (kept[at] == r))
        code = self.code[at[ok]]
        got = np.zeros((len(ok), self.width), np.int64)
        short = np.flatnonzero(code < 255)
        got[short] = self.value[code[short]]
        wide = np.flatnonzero(code == 255)
        if len(wide):
            spot = np.minimum(np.searchsorted(self.big, q[ok[wide]]), len(self.big) - 1)
            got[wide] = np.where((self.big[spot] == q[ok[wide]])[:, None], self.large[spot], 0)
        out[ok] = got
        return out


def discounts(n: list[int]) -> list[float]:
    """Of counts 1, 2, 3 and more, from how many n-grams have counts 1 to 4; fixed fallbacks where those are too few to tell."""
    n1, n2, n3, n4 = n
    if min(n1, n2, n3) <= 0:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [x if 0 < x < k else f for x, k, f in zip(d, (1, 2, 3), (0.5, 0.75, 0.9))]


class Model:
    """Tables in shards. For each length k of contexts: b{k}, counts of the n-grams of contexts of k words; c{k}, contexts with totals and numbers of n-grams of count 1, 2, more; and u,
    tokens with raw and continuation counts. The longest n-grams have raw counts, shorter ones the number of distinct words before them."""

    def __init__(self, store: Store, shards: int, order: int, about: dict):
        self.store, self.shards, self.order, self.about = store, shards, order, about

    def lookup(self, name: str, key: np.ndarray, value: np.ndarray, width: int) -> np.ndarray:
        """Counts of hashes value, each in the shard of its key: shard by shard, so that each table is in cache while it is searched."""
        out = np.zeros((len(value), width), np.int64)
        shard = (key % np.uint64(self.shards)).astype(np.uint16 if self.shards <= 1 << 16 else np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            pick = order[cut[s] : cut[s + 1]]
            out[pick] = self.store.load(f"{name}-{s}").find(value[pick])
        return out

    def log_probs(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(w|context) of n-grams (words, the last of them w), and the raw training count of w."""
        a, w, contexts = self.about, words[-1], contexts_of(words)
        d1 = a["d1"]
        tokens, back = np.unique(w, return_inverse=True)
        raw, cont = self.lookup("u", tokens, tokens, 2).T
        kinds = max(1, a["bigrams"])
        rest = (d1[0] * a["cont"][0] + d1[1] * a["cont"][1] + d1[2] * a["cont"][2]) / kinds if a["bigrams"] else 1.0
        low = np.maximum(cont - np.take([0.0, *d1], np.minimum(cont, 3)), 0) / kinds + rest / (a["tokens"] + 1)
        p, raw = low[back], raw[back]
        for k, (u, d) in enumerate(zip(contexts, a["d"]), 1):
            key = contexts[shard_key(k, self.order) - 1]
            some, at, of = np.unique(u, return_index=True, return_inverse=True)
            t = self.lookup(f"c{k}", key[at], some, 4)
            total = t[:, 0].astype(float)
            gamma = np.where(total > 0, (t[:, 1:] @ np.array(d)) / np.maximum(total, 1), 1.0)
            count = self.lookup(f"b{k}", key, pair_hash(u, w), 1)[:, 0]
            high = np.maximum(count - np.take([0.0, *d], np.minimum(count, 3)), 0) / np.maximum(total[of], 1)
            p = high + gamma[of] * p
        return np.log10(np.maximum(p, 1e-300)), raw


class Names:
    """Numbers of tokens: in each shard they are sorted by descending count, and number = place x shards + shard, so frequent tokens have small numbers without a sort of all."""

    def __init__(self, store: Store, shards: int):
        self.store, self.shards = store, shards
        self._kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return {"store": self.store, "shards": self.shards, "_kept": {}}

    def save(self, s: int, t: np.ndarray, n: np.ndarray) -> None:
        t = t[np.lexsort((t, -n))]
        self.store.save(f"n-{s}", [np.array([len(t)], np.int64), t, np.argsort(t).astype(np.uint32)])

    def _load(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        if s not in self._kept:
            data = self.store.map(f"n-{s}")
            n = int(data[:8].view(np.int64)[0])
            self._kept[s] = data[8 : 8 + 8 * n].view(np.uint64), data[8 + 8 * n : 8 + 12 * n].view(np.uint32)
        return self._kept[s]

    def _each(self, shard: np.ndarray):
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            yield s, order[cut[s] : cut[s + 1]]

    def numbers(self, t: np.ndarray) -> np.ndarray:
        """Of distinct tokens, all of which were counted, or the start."""
        out = np.full(len(t), FIRST)
        real = np.flatnonzero(t != START)
        for s, pick in self._each((t[real] % np.uint64(self.shards)).astype(np.int64)):
            names, order = self._load(s)
            out[real[pick]] = order[np.searchsorted(names, t[real[pick]], sorter=order)] * np.uint32(self.shards) + np.uint32(s)
        return out

    def tokens(self, numbers: np.ndarray) -> np.ndarray:
        some, back = np.unique(numbers, return_inverse=True)
        out = np.full(len(some), START)
        real = np.flatnonzero(some != FIRST)
        for s, pick in self._each((some[real] % np.uint32(self.shards)).astype(np.int64)):
            out[real[pick]] = self._load(s)[0][some[real[pick]] // np.uint32(self.shards)]
        return out[back]


BLOBS = "shard int, n int, cells binary"


def _sent(words: list[np.ndarray], numbers: list[np.ndarray], counts: np.ndarray, shards: int) -> list[tuple]:
    """n-grams (hashes of words, and their numbers) for each shard: numbers and counts, sorted and compressed byte by byte."""
    m = len(words)
    shard = (contexts_of(words)[max(1, m - 2) - 1] % np.uint64(shards)).astype(np.int64)
    by = np.lexsort((*[numbers[c] for c in ((m - 1, 0, *range(m - 2, 0, -1)) if m > 2 else (1, 0))], shard))
    cut = np.searchsorted(shard[by], np.arange(shards + 1))
    rows = []
    for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        pick = by[cut[s] : cut[s + 1]]
        cells = np.stack([*(c[pick] for c in numbers), counts[pick]]).astype("<u4").view(np.uint8).reshape(m + 1, len(pick), 4)
        rows.append((s, len(pick), pa.compress(np.ascontiguousarray(cells.transpose(0, 2, 1)).tobytes(), "zstd", asbytes=True)))
    return rows


def _received(batches: Iterator[pa.RecordBatch], m: int) -> dict[int, np.ndarray]:
    """Of each shard the numbers and counts (m + 1 rows)."""
    got: dict[int, list] = {}
    for b in batches:
        for s, n, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            own = got.setdefault(s, [np.zeros((m + 1, 0), "<u4")])
            if n:
                x = np.frombuffer(pa.decompress(cells.as_buffer(), (m + 1) * n * 4, "zstd"), np.uint8).reshape(m + 1, 4, n)
                own.append(np.ascontiguousarray(x.transpose(0, 2, 1)).view("<u4").reshape(m + 1, n))
    return {s: np.concatenate(parts, axis=1) for s, parts in got.items()}


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["shard", "n", "cells"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t, n): tokens of some texts and how often they are there."""

    def counted(kept: list[np.ndarray]) -> pa.RecordBatch:
        t, n = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([K.longs(t), pa.array(n)], ["t", "n"])

    kept, held = [], 0
    for b in batches:
        data, off = K.raw(b.column(0))
        for i, j in K.chunks(off):
            kept.append(ngrams(data, off, i, j, 1)[0][0])
            held += len(kept[-1])
            if held >= 4 * SEGMENT:
                yield counted(kept)
                kept, held = [], 0
    if held:
        yield counted(kept)


def _counted(order: int, shards: int, vocabulary: Names):
    """n-grams of some texts, counted together, as blobs for each shard."""

    def distinct(held: list[list[np.ndarray]]) -> list[tuple]:
        last = np.concatenate([h[-1] for h in held])
        names, w = np.unique(last, return_inverse=True)
        of = [w.astype(np.uint32)]
        for c in range(order - 1):
            u = np.concatenate([h[c] for h in held])
            of.insert(c, np.where(u == START, len(names), np.minimum(np.searchsorted(names, u), len(names) - 1)).astype(np.uint32))
        names = np.append(names, START)  # no word has this hash but by chance, and then it does no harm
        bits = int(len(names)).bit_length()
        if order * bits > 64:
            by = np.lexsort(of)
            at = np.flatnonzero(np.append(True, np.any([c[by][1:] != c[by][:-1] for c in of], axis=0)))
            of, n = [c[by[at]] for c in of], np.diff(np.append(at, len(by)))
        else:
            key = np.zeros(len(w), np.uint64)
            for c in of:
                key = (key << np.uint64(bits)) | c
            key, n = np.unique(key, return_counts=True)
            of = [(key >> np.uint64(bits * (order - 1 - c))) & np.uint64((1 << bits) - 1) for c in range(order)]
        numbers = vocabulary.numbers(names)
        return _sent([names[c] for c in of], [numbers[c] for c in of], n, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for b in batches:
            data, off = K.raw(b.column(0))
            for i, j in K.chunks(off):
                kept.append(ngrams(data, off, i, j, order)[0])
                held += len(kept[-1][0])
                if held >= SEGMENT:
                    yield _blobs(distinct(kept))
                    kept, held = [], 0
        if held:
            yield _blobs(distinct(kept))

    return run


#: Facts of a level: n-grams of counts 1 to 4, and all. Token rows have level 0.
SUMS = "level int, t long, n long"


def _stored(store: Store, vocabulary: Names, m: int, shards: int, further: bool):
    """Takes n-grams of m words; stores those, and those of m-1 words, and their contexts, for its shards. Gives sums of counts (level, t, n), and for tokens how many
    distinct bigrams end in them; or, if n-grams of two or more words are left, blobs of those."""

    def contexts(k: int, s: int, u: np.ndarray, n: np.ndarray) -> None:
        by, at = _run(u)
        v = np.stack([n, n == 1, n == 2, n > 2], 1).astype(np.int64)[by]
        store.save(f"c{k}-{s}", Table.parts(u[by][at], np.add.reduceat(v, at) if len(at) else v))

    def facts(k: int, n: np.ndarray) -> list[tuple[int, int, int]]:
        return [(k, q, int((n == q).sum())) for q in (1, 2, 3, 4)] + [(k, 5, len(n))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _received(batches, m)
        for s in list(got):
            cells = got.pop(s)
            words, n = [vocabulary.tokens(cells[c]) for c in range(m)], cells[m].astype(np.int64)
            del cells
            u = contexts_of(words)
            h = pair_hash(u[m - 2], words[-1])
            by, at = _run(h)
            n = np.add.reduceat(n[by], at) if len(at) else n
            pick = by[at]
            store.save(f"b{m - 1}-{s}", Table.parts(h[pick], n[:, None]))
            contexts(m - 1, s, u[m - 2][pick], n)
            words, u, sums = [w[pick] for w in words], [v[pick] for v in u[: m - 2]], facts(m - 1, n)
            del h, by, at, pick
            if m > 2:
                u = u[m - 3]
                h = pair_hash(u, words[-1])
                by, at = _run(h)
                pick, n = by[at], np.diff(np.append(at, len(by)))
                store.save(f"b{m - 2}-{s}", Table.parts(h[pick], n[:, None]))
                contexts(m - 2, s, u[pick], n)
                words, sums = [w[pick] for w in words[1:]], sums + facts(m - 2, n)
            lower = words[1:]
            one = pa.RecordBatch.from_arrays([pa.array([x[c] for x in sums], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["level", "t", "n"])
            if not further:
                t, n = np.unique(lower[0], return_counts=True)
                yield one
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(t), np.int32)), K.longs(t), pa.array(n)], ["level", "t", "n"])
                continue
            c = contexts_of(lower)
            by, at = _run(pair_hash(c[-1], lower[-1]))
            lower = [w[by[at]] for w in lower]
            names, cells = np.unique(np.concatenate(lower), return_inverse=True)
            rows = _sent(lower, list(vocabulary.numbers(names)[cells].reshape(len(lower), -1)), np.diff(np.append(at, len(by))), shards)
            head, tail = ["level", "t", "n"], ["shard", "n_", "cells"]
            yield pa.RecordBatch.from_arrays([*one.columns, *(pa.nulls(len(sums), t) for t in (pa.int32(), pa.int32(), pa.binary()))], head + tail)
            if rows:
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), t) for t in (pa.int32(), pa.int64(), pa.int64())), *_blobs(rows).columns], head + tail)

    return run


def _by_shard(shards: int, make: Callable[[int, np.ndarray, np.ndarray], list[int]], names: list[str]):
    """Rows (shard, t, counts...) of each shard, a null t standing for none, go to make(shard, t, counts), whose numbers are summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list] = {}
        for b in batches:
            s, real = b.column(0).to_numpy(), b.column(1).is_valid().to_numpy(zero_copy_only=False)
            t, n = b.column(1).fill_null(0).to_numpy().view(np.uint64), np.stack([c.to_numpy() for c in b.columns[2:]], 1)
            for q in np.unique(s).tolist():
                pick = (s == q) & real
                got.setdefault(q, []).append((t[pick], n[pick]))
        sums = np.zeros(len(names), np.int64)
        for s, parts in got.items():
            sums += make(s, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums.tolist()], names)

    return run


def train(texts: DataFrame, shards: int | None = None, order: int = 2) -> Model:
    """Counts every text of the one string column of texts and stores the model.

    A first pass counts tokens, and with them how many shards the model needs. The second sends n-grams, summed over some million tokens of a task, to the shard of the words between first and last: there all
    n-grams of these words and of one word less are complete, so two orders need one shuffle (higher orders one more for each two). A frequent word's shard is larger than others, by the distinct pairs of words around it.
    Only sums of counts reach the driver."""
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = texts.sparkSession
    tokens = materialise(texts.mapInArrow(thrifty(_tokens), "t long, n long").groupBy("t").agg(F.sum("n").alias("n")), "tokens")
    release_shuffles(spark)
    total, kinds = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    shards = shards or max(partitions(spark), -(-total // SHARD))
    store = Store(new_path(spark, "kneser-ney"))
    vocabulary = Names(store, shards)
    # every shard has a row, so that its tables are written even if they are empty
    ids = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    shard = F.pmod(F.conv(F.hex("t"), 16, 10).cast("decimal(20,0)"), F.lit(shards).cast("decimal(20,0)")).cast("int").alias("shard")
    zero = F.lit(0).cast("long")

    def number(s: int, t: np.ndarray, n: np.ndarray) -> list[int]:
        vocabulary.save(s, t, n[:, 0])
        return [len(t)]

    numbered = tokens.select(shard, "t", "n").unionByName(ids.select("shard", F.lit(None).cast("long").alias("t"), zero.alias("n"))).repartition(shards, "shard")
    numbered.mapInArrow(thrifty(_by_shard(shards, number, ["n"])), "n long").agg(F.sum("n")).first()
    every = ids.select("shard", F.lit(0).alias("n"), F.lit(b"").alias("cells"))
    blobs, m, sums = texts.mapInArrow(thrifty(_counted(order, shards, vocabulary)), BLOBS), order, []
    while True:
        further = m > 3
        made = blobs.unionByName(every).repartition(shards, "shard").mapInArrow(thrifty(_stored(store, vocabulary, m, shards, further)), f"{SUMS}, shard int, n_ int, cells binary" if further else SUMS)
        if not further:
            break
        made = materialise(made, "lower")
        sums.append(made.where("level is not null").select("level", "t", "n"))
        blobs, m = made.where("shard is not null").select("shard", F.col("n_").alias("n"), "cells"), m - 2
    last = materialise(made.groupBy("level", "t").agg(F.sum("n").alias("n")), "continued")
    release_shuffles(spark)
    levels = last.where("level > 0")
    for part in sums:
        levels = levels.unionByName(part)
    facts = {(r[0], r[1]): r[2] for r in levels.groupBy("level", "t").agg(F.sum("n")).collect()}
    both = tokens.join(last.where("level = 0").select("t", F.col("n").alias("kinds")), "t").select(shard, "t", "n", "kinds")

    def keep(s: int, t: np.ndarray, n: np.ndarray) -> list[int]:
        by = np.argsort(t)
        store.save(f"u-{s}", Table.parts(t[by], n[by], whole=True))
        return [int((n[:, 1] == q).sum()) for q in (1, 2, 3, 4)]

    marks = ["m1", "m2", "m3", "m4"]
    both = both.unionByName(ids.select("shard", F.lit(None).cast("long").alias("t"), zero.alias("n"), zero.alias("kinds"))).repartition(shards, "shard")
    f = both.mapInArrow(thrifty(_by_shard(shards, keep, marks)), ", ".join(f"{c} long" for c in marks)).agg(*[F.sum(c) for c in marks]).first()
    for table in (tokens, last):
        discard(table)
    about = {"d": [discounts([facts.get((k, q), 0) for q in (1, 2, 3, 4)]) for k in range(1, order)], "d1": discounts(list(f)), "cont": [f[0], f[1], kinds - f[0] - f[1]], "bigrams": facts.get((1, 5), 0), "tokens": kinds, "total": total}
    return Model(store, shards, order, about)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = model.about["total"], model.about["tokens"]
        for b in batches:
            data, off = K.raw(b.column(1))
            for i, j in K.chunks(off, SCORED):
                words, bound = ngrams(data, off, i, j, model.order)
                p, raw = model.log_probs(words)
                base = np.log10((raw + 0.5) / (n + 0.5 * (v + 1)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(np.diff(bound)), pa.array(np.add.reduceat((raw > 0).astype(np.int64), bound[:-1])), pa.array(np.add.reduceat(base, bound[:-1])), pa.array(np.add.reduceat(p, bound[:-1]))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def held_out():
    """crc32 of the id as text leaves 1 when divided by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def score_documents(docs: DataFrame, order: int = 2) -> DataFrame:
    """Perplexity scores of whole texts by an interpolated modified Kneser-Ney model of n-grams of up to ``order`` (2 or more) tokens of the documents that are not held out.

    docs: doc_id long, text string; others are not read. Tokens are the words [^\\x20\\x09-\\x0D]+ (A-Z lowered) and one end. P(w|u) = max(c(u,w) - D(c(u,w)), 0) / c(u) + g(u) P(w|u without its first word), lower orders from
    continuation counts, discounted in the same way, the lowest over a uniform share of V + 1 tokens; g(u) is the mass that discounts set aside, 1 for a context
    not seen. Before each text stand order-1 starts. The model grows with the training text; nothing is pruned.

    Returns a row for each of docs: doc_id, held_out, n_tokens, n_known (seen in training), train_tokens, base_score (add-half unigrams), score (log10 of the
    text's probability) and perplexity (10^(-score/n_tokens)). Null or empty text: its end alone. Without training text every token is unknown (P = 1). Repeated
    rows are each counted and each scored. An empty table gives an empty result."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(own.where(~held_out()).select("text"), order=order)
    got = own.mapInArrow(thrifty(_scored(model)), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return got.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.about["total"]).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
