"""Token-id output: best-fit-decreasing packing with a segment tree over capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm.session import bounded_batches, thrifty

from reachspark.llm.tokens import encoder

#: Ids (not documents) that are packed together; a task holds no more than these and one document.
WINDOW = 2_000_000


class Capacities:
    """A segment tree over room left (0 to size) that counts bins with that room, and finds the least room that is enough in log steps."""

    def __init__(self, size: int):
        self.n = 1 << size.bit_length()
        self.tree = [0] * (2 * self.n)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        k = room + self.n
        while k:
            self.tree[k] += 1
            k >>= 1

    def best(self, need: int) -> int | None:
        """Take out a bin with the least room that is at least need: the latest such bin."""
        k = need + self.n
        if not self.tree[k]:
            while k > 1 and (k & 1 or not self.tree[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.n:
                k = 2 * k if self.tree[2 * k] else 2 * k + 1
        room = k - self.n
        while k:
            self.tree[k] -= 1
            k >>= 1
        return self.bins[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first (ties in order), each into the bin it fills most."""
    rooms, bins, left = Capacities(capacity), [], []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        k = rooms.best(n)
        if k is None:
            k = len(bins)
            bins.append([])
            left.append(capacity)
        bins[k].append(item)
        left[k] -= n
        if left[k]:
            rooms.add(left[k], k)
    return bins


def _packed(capacity: int, folder: str | None, end_id: int, pad_id: int):
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int64()]
    names = ["sequence_id", "ids", "cu_seqlens", "position_ids", "doc_ids", "starts", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number, enc = (context.partitionId() if context else 0) << 33, encoder(folder)
        pieces: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, pieces, held
            rows = []
            for items in best_fit_decreasing([len(p[2]) for p in pieces], capacity):
                own = [pieces[i] for i in items]
                size = [len(p[2]) for p in own]
                used = sum(size)
                ids, pos = np.full(capacity, pad_id, np.int32), np.zeros(capacity, np.int32)
                ids[:used] = np.concatenate([p[2] for p in own])
                pos[:used] = np.concatenate([np.arange(n) for n in size])
                rows.append((number, ids.tobytes(), np.concatenate([[0], np.cumsum(size)]).astype(np.int32).tobytes(), pos.tobytes(), [p[0] for p in own], [p[1] for p in own], used, zlib.crc32(ids[:used].tobytes())))
                number += 1
                if len(rows) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            pieces, held = [], 0

        for b in batches:
            keys = b.column(0).to_pylist()
            for r, key in enumerate(keys):
                ids = np.append(enc.ids(b.column(1)[r].as_py() or ""), np.uint32(end_id)).astype(np.int32)
                for a in range(0, len(ids), capacity):
                    pieces.append((key, a, ids[a : a + capacity]))
                held += len(ids)
                if held >= WINDOW:
                    yield from flush()
        if pieces:
            yield from flush()

    return run


def pack_ids(docs: DataFrame, capacity: int = 2048, tokenizer_folder: str | None = None, end_id: int = 50256, pad_id: int = 50256) -> DataFrame:
    """Packs whole documents into rows of ``capacity`` token ids.

    docs: doc_id long, text string; others are not read. A document is its ids and end_id. One of more than ``capacity`` ids is split
    losslessly into full pieces and a last one; shorter documents are never cut. Within a window of some million ids of a task the longest
    pieces go first, each into the sequence with the least room that holds it.

    Returns a row for each sequence: sequence_id, ids (binary, capacity little-endian 32-bit ids, padded with pad_id), cu_seqlens (binary, 32-bit bounds of segments
    from 0 to n_tokens), position_ids (binary, 32-bit, from 0 again in each segment; 0 in the padding), doc_ids and starts (for each segment: its document
    and the ids before it there), n_tokens, ids_crc32 (of the ids that aren't padding). Null or empty text: end_id alone. Repeated rows are documents of their own.
    An empty table gives an empty result."""
    bounded_batches(docs.sparkSession)
    schema = "sequence_id long, ids binary, cu_seqlens binary, position_ids binary, doc_ids array<long>, starts array<long>, n_tokens int, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(thrifty(_packed(capacity, tokenizer_folder, end_id, pad_id)), schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes sequences as Parquet: id matrices, segment bounds and position resets as raw little-endian columns, ready to be mapped as matrices."""
    packed.write.mode("overwrite").parquet(path)


def matrices(batch: pa.RecordBatch, capacity: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of rows read back: the id matrix, segment bounds of each row, the position matrix."""
    rows = {n: [np.frombuffer(v, np.int32) for v in batch.column(n).to_pylist()] for n in ("ids", "cu_seqlens", "position_ids")}
    shape = (batch.num_rows, capacity)
    return np.array(rows["ids"]).reshape(shape), rows["cu_seqlens"], np.array(rows["position_ids"]).reshape(shape)
