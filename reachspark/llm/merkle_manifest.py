"""Merkle manifest of a dataset: leaves of rows, one tree for each source, a tree over the sources, and authentication paths by fractal traversal.

Every 16 consecutive nodes have a parent. A source's leaves are cut into aligned blocks of 16^3; within a block one pass emits the path of each leaf from a stack of
subtrees: of each level the run that holds the leaf's ancestor (existing), and the run after it, which grows by a leaf with every path emitted (desired). What
lies above blocks is built by Spark level by level, and its paths are appended to those of the block."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachspark.llm.ranking import ranked
from reachspark.llm.session import bounded_batches, discard, materialise, small

ARITY = 16
#: Levels of a block's own tree: 4096 leaves.
DEPTH = 3
#: Paths in an Arrow batch.
EMIT = 512
STEP = "struct<before:string,after:string>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put one after another."""
    return F.sha2(F.concat(*texts), 256)


def row_digest(columns: dict[str, Column]) -> Column:
    """Leaf of a row: each value as UTF-8 byte count, colon and text; null as a dash."""
    texts = [c.cast("string") for c in columns.values()]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class Growing:
    """A run of nodes of one level, grown from its leaves one by one; below the run it holds at most 15 nodes of each level."""

    def __init__(self, level: int):
        self.open: list[list[str]] = [[] for _ in range(level)]
        self.nodes: list[str] = []

    def add(self, leaf: str) -> None:
        for waiting in self.open:
            waiting.append(leaf)
            if len(waiting) < ARITY:
                return
            leaf = parent(waiting)
            waiting.clear()
        self.nodes.append(leaf)

    def whole(self) -> list[str]:
        """The run, once no leaf follows: last runs below may be short."""
        last: str | None = None
        for waiting in self.open:
            if last is not None:
                waiting.append(last)
            last = parent(waiting) if waiting else None
            waiting.clear()
        if last is not None:
            self.nodes.append(last)
        return self.nodes


def grown(leaves: list[str], level: int, most: int | None = None) -> list[str]:
    run = Growing(level)
    for x in leaves[:most]:
        run.add(x)
    return run.whole()


def height(n: int) -> int:
    """Levels above n leaves: none above one."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def block_root(leaves: list[str], levels: int) -> str:
    return parent(grown(leaves, levels - 1)) if levels else leaves[0]


def paths(leaves: list[str], levels: int) -> Iterator[list[tuple[str, str]]]:
    """Of each leaf of a block in turn: what stands before and after its ancestor in the run of each level, lowest level first."""
    span = [ARITY ** (j + 1) for j in range(levels)]
    existing = [grown(leaves, j, span[j]) for j in range(levels)]
    desired = [Growing(j) for j in range(levels)]
    for i in range(len(leaves)):
        for j in range(levels):
            if i and i % span[j] == 0:
                existing[j], desired[j] = desired[j].whole(), Growing(j)
        at = [i // ARITY**j % ARITY for j in range(levels)]
        yield [("".join(e[:p]), "".join(e[p + 1 :])) for e, p in zip(existing, at)]
        for j in range(levels):  # a run lasts as many leaves as its successor needs: one with each path keeps pace
            if i + span[j] < len(leaves):
                desired[j].add(leaves[i + span[j]])


def _roots(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = [block_root(x.values.field("leaf").to_pylist(), min(depth, height(n))) for x, n in zip(b.column("rows"), b.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("skey"), b.column("block"), b.column("size"), _strings(roots)], ["skey", "block", "size", "hash"])

    return run


def _strings(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


def _emit(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield from _paths(b, k, depth)

    return run


def _paths(b: pa.RecordBatch, k: int, depth: int) -> Iterator[pa.RecordBatch]:
    """A block's leaves with their paths, those above the block appended."""
    rows = b.column("rows")[k].values
    above = [(x["before"], x["after"]) for x in b.column("above")[k].as_py()]
    top = [b.column(c)[k].as_py() for c in ("subroot", "root")]
    leaves = rows.field("leaf").to_pylist()
    walk = paths(leaves, min(depth, height(b.column("size")[k].as_py())))
    for i in range(0, len(leaves), EMIT):
        part = rows.slice(i, EMIT)
        steps = [next(walk) + above for _ in range(len(part))]
        flat = [s for p in steps for s in p]
        pairs = pa.StructArray.from_arrays([_strings([s[0] for s in flat]), _strings([s[1] for s in flat])], ["before", "after"])
        ends = np.concatenate([[0], np.cumsum([len(p) for p in steps])]).astype(np.int32)
        same = [pa.array([x] * len(part), pa.string()) for x in top]
        yield pa.RecordBatch.from_arrays([part.field("doc_id"), part.field("leaf"), part.field("claim"), *same, pa.ListArray.from_arrays(pa.array(ends), pairs)], ["doc_id", "leaf", "claim", "subroot", "root", "path"])


def raised(nodes: DataFrame) -> DataFrame:
    """Trees over nodes (key, idx, size, hash; size: nodes of the key, idx from 0): (key, idx, top, path) of each node, path up to its key's top.

    Each level is one grouping of at most 16 nodes, so the tables shrink by 16 with each; paths come down again by one join a level. Written at each level."""
    levels, now = [], materialise(nodes, "nodes")
    while (now.agg(F.max("size")).first()[0] or 0) > 1:
        run = now.groupBy("key", (F.col("idx") / ARITY).cast("long").alias("idx"), "size").agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"))
        one = F.col("size") == 1  # such a key has its top already
        run = materialise(run.withColumn("hash", F.when(one, F.col("kids")[0]["hash"]).otherwise(F.sha2(F.array_join("kids.hash", ""), 256))).withColumn("raised", ~one).withColumn("size", F.ceil(F.col("size") / ARITY)), "nodes")
        levels.append(run)
        if len(levels) == 1:
            discard(now)
        now = run
    out = now.select("key", "idx", F.col("hash").alias("top"), F.array().cast(f"array<{STEP}>").alias("path"))
    for run in reversed(levels):
        kid = run.join(out, ["key", "idx"]).select("key", "top", "path", "kids", "raised", F.posexplode("kids").alias("p", "kid"))
        hashes = F.col("kids.hash")
        side = F.struct(F.array_join(F.slice(hashes, F.lit(1), F.col("p")), "").alias("before"), F.array_join(F.slice(hashes, F.col("p") + 2, F.lit(ARITY)), "").alias("after"))
        out = kid.select("key", F.col("kid.idx").alias("idx"), "top", F.when(F.col("raised"), F.concat(F.array(side), F.col("path"))).otherwise(F.col("path")).alias("path"))
    out = materialise(out, "paths")
    for run in levels or [now]:
        discard(run)
    return out


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def path_digest(path: Column) -> Column:
    """SHA-256 of a path's siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def authenticate(docs: DataFrame, claim: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """Manifest of documents (doc_id, source, lang, n_chars, text; other columns count for nothing): one row each with doc_id, leaf, claim, subroot, root and
    path (array of (before, after), siblings as concatenated hex: of the leaf's level first, the top over sources last). depth: levels of a block, which has 16^depth leaves.

    claim: a column over docs, a leaf that is to be proven instead of the row's own (null: its own). Leaves of a source ascend by doc_id (null first), then by
    leaf: equal rows are leaves of their own, side by side. A null source is a source, before all others. A source with one row has its leaf as subroot, and a
    dataset with one source has its subroot as root. An empty table has no rows. Only ids, sources and digests are shuffled, never texts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    own = row_digest({c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")})
    source = F.col("source").cast("string")
    leaves = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("skey"), own.alias("leaf"), (F.lit(None) if claim is None else claim).cast("string").alias("claim")), "leaves")
    placed = ranked(leaves, ["skey"], ["doc_id", "leaf"])
    discard(leaves)
    blocks = placed.groupBy("skey", (F.col("idx") / ARITY**depth).cast("long").alias("block"), "size").agg(F.sort_array(F.collect_list(F.struct("idx", "doc_id", "leaf", "claim"))).alias("rows"))
    blocks = materialise(blocks, "blocks")
    discard(placed)
    roots = blocks.mapInArrow(_roots(depth), "skey string, block long, size long, hash string")
    of_source = raised(roots.select(F.col("skey").alias("key"), F.col("block").alias("idx"), F.ceil(F.col("size") / ARITY**depth).alias("size"), "hash"))
    sources = ranked(of_source.where("idx = 0").select(F.col("key").alias("skey"), F.col("top").alias("hash")), [], ["skey"])
    over = raised(sources.select(F.lit("").alias("key"), "idx", "size", "hash"))
    above = sources.join(over.select("idx", F.col("top").alias("root"), F.col("path").alias("rest")), "idx").select("skey", F.col("hash").alias("subroot"), "root", "rest")
    above = of_source.select(F.col("key").alias("skey"), F.col("idx").alias("block"), "path").join(above, "skey").select("skey", "block", "subroot", "root", F.concat("path", "rest").alias("above"))
    above = materialise(above, "above")
    out = blocks.join(small(above, width=8000), ["skey", "block"]).mapInArrow(_emit(depth), f"doc_id long, leaf string, claim string, subroot string, root string, path array<{STEP}>")
    for used in (of_source, sources, over):
        discard(used)
    return out


def verify(docs: DataFrame, claim: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """authenticate(), and what follows from each claim: proof_sha256 (of the path's siblings), folded_root and verified."""
    got = authenticate(docs, claim, depth)
    got = got.withColumn("proof_sha256", path_digest(F.col("path"))).withColumn("folded_root", fold(F.coalesce("claim", "leaf"), F.col("path")))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased(docs: DataFrame, every: int = 5) -> Column:
    """Leaves of rows that were tampered with: A-Z of the text made small where ``every`` divides the CRC-32 of doc_id's digits; null elsewhere."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, row_digest({c: F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}))
