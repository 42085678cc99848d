"""Vector bin packing of token examples under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm.session import bounded_batches, thrifty

from reachspark.llm.tokens import encoder

#: Pieces that wait to be placed before a sequence is filled.
POOL = 1024


class Packer:
    """Fills one sequence at a time by the dot-product heuristic.

    Of the waiting pieces that fit, the one goes in whose demand (tokens, one segment, loss-bearing tokens, each as a share of its limit and
    weighted by how much of it all waiting pieces ask for) has the largest inner product with what is left of the sequence.
    If none fits whole, the best one is cut to fill the rest. Sequences leave full; what stays at the end goes into
    ones whose lengths are powers of two."""

    def __init__(self, capacity: int, segments: int, loss: int):
        if min(capacity, segments, loss) < 1:
            raise ValueError("limits must be at least 1")
        self.limit = np.array([capacity, segments, loss], float)
        self.capacity = capacity
        n = 2 * POOL
        self.length, self.loss = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.item: list[tuple | None] = [None] * n  # (example, start, length)
        self.free = list(range(n))[::-1]
        self.count = 0

    def add(self, example, start: int, length: int) -> Iterator[list[tuple]]:
        """Take in ids start to start+length of an example: ids (array), bears (running count of loss-bearing ids from 0). Yields sequences (lists of pieces)."""
        while length >= self.capacity and example.loss(start, start + self.capacity) <= self.limit[2]:
            yield [(example, start, self.capacity)]
            start, length = start + self.capacity, length - self.capacity
        while length > 0:
            n = self.longest(example, start, min(length, self.capacity), int(self.limit[2]))
            self.put(example, start, n)
            start, length = start + n, length - n
            while self.count >= POOL:
                yield self.fill()

    @staticmethod
    def longest(example, start: int, length: int, loss: int) -> int:
        """The most of so many ids that have at most so many loss-bearing ones; 0 if not one."""
        return length if example.loss(start, start + length) <= loss else example.reach(start, length, loss)

    def put(self, example, start: int, length: int) -> None:
        k = self.free.pop()
        self.item[k], self.length[k], self.loss[k] = (example, start, length), length, example.loss(start, start + length)
        self.count += 1

    def take(self, k: int) -> tuple:
        out = self.item[k]
        self.item[k], self.length[k], self.loss[k] = None, 0, 0
        self.free.append(k)
        self.count -= 1
        return out

    def fill(self) -> list[tuple]:
        left, out = self.limit.copy(), []
        ask = np.array([self.length.sum(), self.count, self.loss.sum()], float) / self.limit
        weight = ask / max(ask.sum(), 1e-12) / self.limit
        while self.count and left[0] >= 1 and left[1] >= 1:
            here = self.length > 0
            r = left * weight / self.limit
            score = np.where(here, self.length * r[0] + r[1] + self.loss * r[2], -1.0)
            fits = here & (self.length <= left[0]) & (self.loss <= left[2])
            if left[1] < 2 and left[0] > self.length.max(where=fits, initial=0):
                fits &= self.length >= left[0]  # the last segment had better fill the sequence: cut a longer one
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                left -= (self.length[k], 1, self.loss[k])
                out.append(self.take(k))
                continue
            k = int(np.argmax(score))
            example, start, length = self.item[k]
            n = self.longest(example, start, int(min(length, left[0])), int(left[2]))
            if n < 1:
                break
            self.take(k)
            out.append((example, start, n))
            left -= (n, 1, example.loss(start, start + n))
            if n < length:
                self.put(example, start + n, length - n)
        return out

    def rest(self) -> Iterator[list[tuple]]:
        while self.count:
            pieces = self.fill()
            total = sum(p[2] for p in pieces)
            while total and total != self.capacity and total & (total - 1):
                part, need = [], 1 << (total.bit_length() - 1)
                total -= need
                while need:
                    example, start, length = pieces[0]
                    n = min(need, length)
                    part.append((example, start, n))
                    pieces = ([(example, start + n, length - n)] if n < length else []) + pieces[1:]
                    need -= n
                yield part
            yield pieces


class Example:
    __slots__ = ("key", "ids", "bears")

    def __init__(self, key, ids: np.ndarray, bears: np.ndarray | None):
        self.key, self.ids, self.bears = key, ids, bears

    def loss(self, a: int, b: int) -> int:
        return b - a if self.bears is None else int(self.bears[b] - self.bears[a])

    def reach(self, start: int, length: int, loss: int) -> int:
        if self.bears is None:
            return min(length, loss)
        return int(np.searchsorted(self.bears[start : start + length + 1], self.bears[start] + loss, side="right")) - 1


def _packed(limits: tuple[int, int, int], folder: str | None, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        enc, packer = encoder(folder), Packer(*limits)
        cols: list[list] = [[] for _ in range(9)]
        made = 0

        def emit(pieces: list[tuple]) -> None:
            nonlocal made
            at = 0
            for example, start, n in pieces:
                part = example.ids[start : start + n]
                for c, v in zip(cols, (example.key, start, n, zlib.crc32(part.tobytes()), len(example.ids), base + made, at, example.loss(start, start + n), part.astype(np.int32) if with_ids else None)):
                    c.append(v)
                at += n
            made += 1

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64()] * 8 + [pa.list_(pa.int32())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(cols, kinds))[: 9 if with_ids else 8]], names[: 9 if with_ids else 8])
            for c in cols:
                c.clear()
            return out

        for b in batches:
            keys, parts = b.column(0).to_pylist(), b.column(1)
            for r, key in enumerate(keys):
                spans = parts[r].as_py() or []
                ids = [enc.ids(s["text"] or "") for s in spans] + [np.array([end_id], np.uint32)]
                bears = None
                if not all(s["loss"] for s in spans):
                    marks = np.concatenate([[0], *[np.full(len(i), bool(s["loss"])) for i, s in zip(ids, spans)], [bool(spans[-1]["loss"])]])
                    bears = np.cumsum(marks.astype(np.int64))
                whole = np.ascontiguousarray(np.concatenate(ids))
                for pieces in packer.add(Example(key, whole, bears), 0, len(whole)):
                    emit(pieces)
                if len(cols[0]) >= (200 if with_ids else 20_000):
                    yield batch()
        for pieces in packer.rest():
            emit(pieces)
        if cols[0]:
            yield batch()

    return run


def pack(examples: DataFrame, capacity: int = 1024, segments: int = 64, loss: int | None = None, tokenizer_folder: str | None = None, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Packs examples (doc_id long, parts array<struct<text string, loss boolean>>) into sequences.

    An example is the ids of its parts' texts and end_id; an id bears loss if its part does (end_id as the last part). A sequence has at most
    ``capacity`` ids, ``segments`` pieces and ``loss`` loss-bearing ids (default: capacity). Examples are cut where that
    fills a sequence; each id lies in exactly one piece. Each task packs what it reads, in order, holding some
    thousand pieces at most: no shuffle, and a lost task makes the same sequences again.

    Returns a row for each piece: doc_id, start (ids of the example before it), length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit), doc_tokens (ids of the example), sequence_id (task and number in it), offset (in the sequence, gapless),
    loss_tokens and, if asked for, ids. Null or empty text: end_id alone. Repeated rows are examples of their own. An empty table gives an empty result."""
    bounded_batches(examples.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long" + (", ids array<int>" if with_ids else "")
    return examples.select("doc_id", "parts").mapInArrow(thrifty(_packed((capacity, segments, loss or capacity), tokenizer_folder, end_id, with_ids)), schema)


def document_examples(docs: DataFrame) -> DataFrame:
    """Whole documents as examples; all their ids bear loss."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array(F.struct(F.col("text").cast("string").alias("text"), F.lit(True).alias("loss"))).alias("parts"))


def conversation_examples(turns: DataFrame, roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as examples: turns in order, those of the given roles bear loss. Rows without conv_id are left out."""
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return turns.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("doc_id")).agg(F.transform(said, lambda t: F.struct(t["text"].alias("text"), F.coalesce(t["role"].isin(*roles), F.lit(False)).alias("loss"))).alias("parts"))
