"""Near-duplicate components over shingle sets: banded MinHash candidates, optional
sequential Bayesian pruning, exact verification, union-find. Shared by document and line dedup."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.llm import textkernel as K
from reachspark.llm.components import connected_components
from reachspark.llm.session import Bloom, discard, materialise, partitions, release_shuffles, small, thrifty

#: Signatures whose band keys are held at once before they are grouped.
SEGMENT = 20_000
#: Members of a tile; buckets of more are large ones.
TILE = 256
#: Pairs of signatures that are compared at once.
PAIRS = 300_000
#: Texts of a block in which pairs are verified.
BLOCK = 64


def stop_rule(k: int, step: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """After n of k hashes, the least number of matches with which a pair goes on: with a uniform
    prior the chance that similarity is at least percent/100 after m matches of n is
    P(Bin(n+1, percent/100) <= m); pairs for which it is below miss go."""
    out = []
    for n in [*range(step, k, step), k]:
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * (percent / 100) ** m * (1 - percent / 100) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def survives(sa: np.ndarray, sb: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices are left by the sequential rule; each batch of hashes is compared only for pairs left so far."""
    left = np.arange(len(sa))
    hits = np.zeros(len(sa), np.int32)
    was = 0
    for n, least in rule:
        hits = hits + (sa[left, was:n] == sb[left, was:n]).sum(1)
        ok = hits >= least
        left, hits, was = left[ok], hits[ok], n
    return left


def grouped(key: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of key: keys, members, where a key begins, and the least member of each row's key.

    Keys are compared by their upper bits, 32 or more: as many as leave room for a row's number beside them, so that plain numbers are sorted; the others are zero in the result."""
    low = max(len(key) - 1, 1).bit_length()
    if low <= 32:
        mask = np.uint64((1 << low) - 1)
        key = key & ~mask | np.arange(len(key), dtype=np.uint64)
        key.sort()
        who = who[(key & mask).view(np.int64)]
        key &= ~mask
    else:
        order = np.argsort(key)
        key, who = key[order], who[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    return key, who, first, np.repeat(np.minimum.reduceat(who, at), np.diff(np.append(at, len(key)))) if len(at) else who


def shard_bounds(shards: int) -> np.ndarray:
    """Where the ranges of a key's upper 32 bits begin that are the shards, and where the last ends."""
    return np.array([-(-s * (1 << 32) // shards) for s in range(shards + 1)], np.uint64)


def bucket_ids(key: np.ndarray, shards: int) -> np.ndarray:
    """What band keys are told apart by: their shard, and 32 of the bits below those that a shard has in common. Rounds use the same ids, so their buckets are the same ones."""
    spare = min(10, shards.bit_length() - 1)
    shard = (key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    return shard << np.uint64(32) | key >> np.uint64(32 - spare) & np.uint64(0xFFFFFFFF)


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs without repeats."""
    with np.errstate(over="ignore"):
        order = np.argsort(K.mix(a.view(np.uint64) * np.uint64(K._BASE) ^ b.view(np.uint64)))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def merged_buckets(members: DataFrame, tile: int = TILE) -> DataFrame:
    """Members (bkey, sid, comp, n) of buckets, those of large buckets that are much the same ones once only, in the buckets' union.

    Near copies share most of their bands, so they meet in many large buckets. A bucket joins the one that is the largest for most of its members, in chains up to a root; where
    a root's members make no more pairs than its buckets do together, their union takes the buckets' place: with a negative key, each member once. No pair of a bucket is lost by it."""
    large = members.where(F.col("n") > tile)
    if large.isEmpty():
        return members
    own = large.groupBy("sid").agg(F.collect_list(F.struct("n", "bkey")).alias("own"), F.any_value("comp").alias("comp"))  # a bucket for each band at most
    own = materialise(own.withColumn("home", F.array_max("own")["bkey"]), "own")
    each = own.select("sid", "comp", "home", F.explode("own").alias("b")).select("sid", "comp", "home", "b.bkey", "b.n")
    share = materialise(each.groupBy("bkey", "n", "home").agg(F.count("*").alias("c")), "share")
    parent = materialise(share.groupBy("bkey", "n").agg(F.max_by("home", F.struct("c", "home")).alias("home")), "parent")
    roots = connected_components(parent.select(F.col("bkey").alias("a"), F.col("home").alias("b"))).withColumnRenamed("node", "bkey")
    rooted = materialise(parent.join(roots, "bkey", "left").select("bkey", "n", F.coalesce("root", "bkey").alias("root")), "rooted")
    # most members are in buckets of their home's root only: of these no row for each bucket is joined
    root, at_home = small(rooted.select("bkey", "root")), small(rooted.select(F.col("bkey").alias("home"), F.col("root").alias("at")))
    strays = materialise(share.join(root, "bkey").join(at_home, "home").where("root <> at").select("bkey", "home", "root"), "strays")
    union = own.join(at_home, "home").select(F.expr("-1 - at").alias("bkey"), "sid", "comp")
    union = union.unionByName(each.join(small(strays, width=24), ["bkey", "home"]).select(F.expr("-1 - root").alias("bkey"), "sid", "comp"))
    union = materialise(union.distinct(), "union")
    pairs = rooted.groupBy(F.expr("-1 - root").alias("key")).agg(F.sum(F.expr("double(n) * n")).alias("pairs"), F.count("*").alias("buckets")).where("buckets > 1")
    fewer = union.groupBy(F.col("bkey").alias("key")).agg(F.count("*").alias("n")).join(pairs, "key").where("double(n) * n <= pairs").select("key", "n")
    fewer = materialise(fewer, "fewer")
    gone = materialise(rooted.join(fewer, F.expr("-1 - root") == F.col("key"), "left_semi").select("bkey"), "gone")
    out = members.join(small(gone), "bkey", "left_anti").select("bkey", "sid", "comp", "n").unionByName(union.join(small(fewer.withColumnRenamed("key", "bkey")), "bkey").select("bkey", "sid", "comp", "n"))
    out = materialise(out, "members")
    for table in (own, share, parent, rooted, strays, union, fewer, gone, members):
        discard(table)
    return out


def tile_pairs(members: DataFrame, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Members (bkey, sid, comp, n) of buckets with their tile t, and the pairs of tiles (bkey, x, y) that hold all pairs of members in different components.

    In a bucket of more than ``tile`` members a component of half as many or more has tiles of its own; smaller ones share tiles, each component whole in one. Two tiles of one
    component never meet: a bucket of one component and a few strangers makes as many pairs as the strangers' tiles times its tiles, not the square of its size."""
    spark = members.sparkSession
    count = members.groupBy("bkey", "comp").agg(F.count("*").alias("c"), F.any_value("n").alias("n"))
    own = (F.col("n") > tile) & (2 * F.col("c") >= tile)
    kind = count.withColumn("own", own).withColumn("k", F.when(F.col("own"), F.ceil(F.col("c") / tile)).otherwise(F.ceil(F.col("n") / tile)).cast("int"))
    kind = materialise(kind, "kinds")
    which = F.when(F.col("own"), F.xxhash64("comp", F.pmod(F.xxhash64("sid"), "k"), F.lit(1))).when(F.col("n") > tile, F.xxhash64(F.pmod(F.xxhash64("comp"), "k"), F.lit(2))).otherwise(F.lit(0).cast("long"))
    placed = members.drop("n").join(small(kind, width=40), ["bkey", "comp"]).withColumn("t", which).select("bkey", "sid", "comp", "t", "own")
    tiles = materialise(placed.groupBy("bkey", "t").agg(F.any_value("own").alias("own"), F.min("comp").alias("comp")), "tilelist")
    top = kind.where("own").groupBy("bkey").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"))
    marked = tiles.join(small(materialise(top, "tops")), "bkey", "left").withColumn("main", F.coalesce(F.col("own") & (F.col("comp") == F.col("top")), F.lit(False)))
    a = marked.where("not main").select("bkey", F.col("t").alias("x"), F.col("own").alias("xo"), F.col("comp").alias("xc"))
    b = marked.select("bkey", F.col("t").alias("y"), F.col("own").alias("yo"), F.col("comp").alias("yc"), "main")
    meet = a.join(b, "bkey").where((F.col("main") | (F.col("x") <= F.col("y"))) & ~(F.col("xo") & F.col("yo") & (F.col("xc") == F.col("yc"))))
    return placed, materialise(meet.select("bkey", "x", "y"), "tilepairs")


class Linker:
    """Finds the components of nodes (sid long, sig binary) whose shingle sets have Jaccard similarity of at least percent/100.

    nodes are read once; equal sids stand for equal texts and may repeat. With prepare, nodes are other rows, of which it makes batches of (sid, sig) in the same worker.
    fetch(sids): (sid, text), one row for each of the given distinct sids. It is called once, for all candidates.
    describe(texts): (sid, sig) of such texts.
    """

    def __init__(self, spark: SparkSession, nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], shingles: K.Shingles, percent: int, bands: int, rows: int, miss: float | None, describe: Callable[[DataFrame], DataFrame], likeliest: bool = True, prepare: Callable | None = None):
        self.spark, self.nodes, self.fetch, self.shingles, self.percent = spark, nodes, fetch, shingles, percent
        self.bands, self.rows = bands, rows
        #: Without a miss chance, signatures carry their kind, and only pairs that agree in less than a third of a quarter of the places
        #: are pruned: more than seven standard deviations off at a similarity of 0.8, for either kind.
        k = bands * rows
        self.rule = stop_rule(k, 20, percent, miss) if miss else []
        self.width, self.likeliest = k + (not miss), likeliest
        #: Places of a signature that pairs are pruned by: with kinds, the kind and the first quarter suffice.
        self.head = self.width if miss else k // 4 + 1
        if not miss:
            self.rule = [(k // 4, k // 12)]
        self.describe, self.prepare = describe, prepare
        self.scrap: list[DataFrame] = []

    def centre_pairs(self) -> DataFrame:
        """For each band bucket the pairs of its least member with each other one, each pair once.

        Every task groups its own rows by bucket first: it sends a bucket's least member and pairs the
        others with that one, so a bucket with very many members sends one row for each task. What is
        sent are blobs of sorted (bucket, member) for each shard, not a row for each."""
        width, bands, rows, shards = self.width, self.bands, self.rows, 4 * partitions(self.spark)

        def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def flush(sids: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
                kind = sig[:, bands * rows :].sum(1, dtype=np.int64)  # a sid may have a signature of each kind
                _, at = np.unique(sids ^ (kind << 56), return_index=True)
                sids = sids[at]
                key, who, first, lead = grouped(K.band_keys(sig[at], bands, rows).ravel(), np.repeat(sids, bands))
                rest = np.flatnonzero(lead != who)
                p, q = distinct_pairs(lead[rest], who[rest])
                # keys are sorted, and a shard is a range of them
                key, lead = key[first], lead[first]
                cut = np.searchsorted(key >> np.uint64(32), shard_bounds(shards))
                k1 = bucket_ids(key, shards).astype(np.uint32)
                out = [(s, 0, k1[a:b].tobytes(), lead[a:b].tobytes()) for s, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if b > a]
                spot = p.view(np.uint64) % np.uint64(shards)
                for s in np.unique(spot).tolist():
                    out.append((s, 1, p[spot == s].tobytes(), q[spot == s].tobytes()))
                return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["shard", "kind", "x", "y"])

            have: list[tuple[np.ndarray, np.ndarray]] = []
            n = 0
            for b in batches:
                for i in range(0, b.num_rows, SEGMENT):
                    part = b.slice(i, SEGMENT)
                    have.append((part.column(0).to_numpy(zero_copy_only=False), K.matrix(part.column(1), width)))
                    n += part.num_rows
                    if n >= SEGMENT:
                        yield flush(np.concatenate([h[0] for h in have]), np.concatenate([h[1] for h in have]))
                        have, n = [], 0
            if n:
                yield flush(np.concatenate([h[0] for h in have]), np.concatenate([h[1] for h in have]))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list[tuple]] = {}
            for b in batches:
                for shard, kind, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                    y = np.frombuffer(y.as_buffer(), np.int64)
                    if kind:
                        x = np.frombuffer(x.as_buffer(), np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
                    else:
                        parts.setdefault(shard, []).append((np.frombuffer(x.as_buffer(), np.uint32).copy(), y.copy()))
            for shard in list(parts):
                have = parts.pop(shard)
                key = np.concatenate([h[0] for h in have]).astype(np.uint64) << np.uint64(32)
                _, who, _, lead = grouped(key, np.concatenate([h[1] for h in have]))
                rest = np.flatnonzero(lead != who)
                p, q = distinct_pairs(lead[rest], who[rest])
                for i in range(0, len(p), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(p[i : i + 50_000]), pa.array(q[i : i + 50_000])], ["a", "b"])

        prepare = self.prepare
        blobs = self.nodes.mapInArrow(thrifty((lambda batches: group(prepare(batches))) if prepare else group), "shard int, kind int, x binary, y binary")
        return blobs.repartition(partitions(self.spark), "shard").mapInArrow(thrifty(merge), "a long, b long").distinct()

    def verified(self, pairs: DataFrame, prune_first: bool) -> DataFrame:
        """Of pairs (a, b), those whose sets are similar enough; materialised. Signatures prune first if that is asked for."""
        rule, width, percent, shingles = self.rule, self.head, self.percent, self.shingles

        def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sa, sb = K.matrix(b.column(2), width), K.matrix(b.column(3), width)
                left = survives(sa, sb, rule)
                left = left[(sa[left, rule[-1][0] :] == sb[left, rule[-1][0] :]).all(1)]  # of one kind
                yield b.select(["a", "b"]).take(pa.array(left))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, 200):
                    b = whole.slice(i, 200)
                    a_ids = b.column(0).to_numpy(zero_copy_only=False)
                    fresh = np.ones(len(a_ids), bool)  # rows come sorted by a: its set is made once
                    fresh[1:] = a_ids[1:] != a_ids[:-1]
                    x = np.cumsum(fresh) - 1
                    judge = shingles.alike(pa.concat_arrays([b.column(2).filter(pa.array(fresh)), b.column(3)]), x, x[-1] + 1 + np.arange(len(x)), percent)
                    yield b.select(["a", "b"]).filter(pa.array([judge(r) for r in range(len(x))], pa.bool_()))

        if prune_first:
            sig = small(self.heads(), self.n_nodes, self.head + 32)
            pairs = (
                pairs.join(sig.select(F.col("sid").alias("b"), F.col("sig").alias("sb")), "b")
                .join(sig.select(F.col("sid").alias("a"), F.col("sig").alias("sa")), "a")
                .select("a", "b", "sa", "sb")
                .mapInArrow(prune, "a long, b long")
            )
        pairs = materialise(pairs, "pairs")
        ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "ids")
        texts = self.texts.join(small(ids), "sid", "left_semi").select("sid", "text")
        links = (
            pairs.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb")
            .mapInArrow(thrifty(exact), "a long, b long")
        )
        links = materialise(links, "links")
        for table in (pairs, ids):
            discard(table)
        release_shuffles(self.spark)
        return links

    def heads(self) -> DataFrame:
        """(sid, sig): what pairs are pruned by; the kind, if there is one, comes last."""
        if self.head == self.width:
            return self.nodes.select("sid", "sig")
        return self.nodes.select("sid", F.concat(F.substring("sig", 1, self.head - 1), F.substring("sig", self.width, 1)).alias("sig"))

    def members(self, comps: DataFrame) -> DataFrame:
        """(bkey, sid, comp, n) of the buckets whose n members are in two or more components so far.

        The one pair of a bucket of two was judged as its centre pair, so such buckets are left out."""
        width, bands, rows, shards = self.width, self.bands, self.rows, 4 * partitions(self.spark)

        def united(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
            order = np.argsort(key)
            key = key[order]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return key[at], np.minimum.reduceat(lo[order], at), np.maximum.reduceat(hi[order], at), np.add.reduceat(n[order], at)

        def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # of each bucket the least and the greatest component and the number of members; blobs for each shard, not a row for each bucket
            for whole in batches:
                for i in range(0, whole.num_rows, SEGMENT):
                    b = whole.slice(i, SEGMENT)
                    comp = np.repeat(b.column(2).to_numpy(zero_copy_only=False), bands)
                    found = united(bucket_ids(K.band_keys(K.matrix(b.column(1), width), bands, rows).ravel(), shards), comp, comp, np.ones(len(comp), np.int64))
                    cut = np.searchsorted(found[0] >> np.uint64(32), np.arange(shards + 1, dtype=np.uint64)).tolist()
                    some = [s for s in range(shards) if cut[s + 1] > cut[s]]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32())] + [pa.array([v[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary()) for v in found], ["shard", "key", "lo", "hi", "n"])

        def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list[list[np.ndarray]]] = {}
            for b in batches:
                for r, shard in enumerate(b.column(0).to_pylist()):
                    parts.setdefault(shard, []).append([np.frombuffer(b.column(c)[r].as_py(), t) for c, t in ((1, np.uint64), (2, np.int64), (3, np.int64), (4, np.int64))])
            for shard in list(parts):
                key, lo, hi, n = united(*(np.concatenate(v) for v in zip(*parts.pop(shard))))
                several = (lo != hi) & (n > 2)
                yield pa.RecordBatch.from_arrays([K.longs(key[several]), pa.array(n[several])], ["bkey", "n"])

        own = self.nodes.join(small(comps.select(F.col("node").alias("sid"), "root")), "sid", "left").select("sid", "sig", F.coalesce("root", "sid").alias("comp"))
        blobs = own.mapInArrow(thrifty(spans), "shard int, key binary, lo binary, hi binary, n binary").repartition("shard")
        several = materialise(blobs.mapInArrow(thrifty(mixed), "bkey long, n long"), "several")
        wanted = Bloom(several, "bkey")

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                key = bucket_ids(K.band_keys(K.matrix(b.column(1), width), bands, rows).ravel(), shards)
                at = np.flatnonzero(wanted.has(key))
                yield pa.RecordBatch.from_arrays([K.longs(key[at])] + [b.column(c).take(pa.array(at // bands)) for c in (0, 2)], ["bkey", "sid", "comp"])

        return own.mapInArrow(thrifty(keyed), "bkey long, sid long, comp long").join(small(several), "bkey")

    def tiles(self, members: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
        """Pairs of members of a bucket in different components, compared by signature in tiles of about TILE x TILE at most. A tile's members are packed into one row before tiles meet.

        Without blocks: for each component of a tile the pair whose signatures agree most, (a, b). With blocks (sid, block):
        all pairs that the signatures leave, one row (bx, by, pairs) for each two blocks of a tile."""
        rule, width, bands, rows, whole, shards = self.rule, self.head, self.bands, self.rows, self.head == self.width, 4 * partitions(self.spark)
        placed, pairs = tile_pairs(members)
        placed = placed.join(small(self.heads(), self.n_nodes, width + 32), "sid")
        if blocks is not None:
            placed = placed.join(small(blocks), "sid")
        item = ["sid", "comp", "sig"] + ["block"] * (blocks is not None)
        content = materialise(placed.groupBy("bkey", "t").agg(F.collect_list(F.struct(*item)).alias("m")), "tilecontent")
        self.scrap.append(content)
        own = pairs.where("x = y").join(content.select("bkey", F.col("t").alias("x"), F.col("m").alias("mx")), ["bkey", "x"]).select("bkey", "mx", F.col("mx").alias("my"))
        met = pairs.where("x <> y").repartition(partitions(self.spark)).join(content.select("bkey", F.col("t").alias("x"), F.col("m").alias("mx")), ["bkey", "x"]).join(content.select("bkey", F.col("t").alias("y"), F.col("m").alias("my")), ["bkey", "y"])
        both = own.unionByName(met.select("bkey", "mx", "my"))

        def crossed(b: pa.RecordBatch) -> Iterator[tuple]:
            """For some rows at a time: columns of both sides, and row, x and y of every pair of members in different components."""
            flat = []
            for c in (1, 2):
                m = b.column(c).flatten()
                flat.append([m.field(0).to_numpy(zero_copy_only=False), m.field(1).to_numpy(zero_copy_only=False), K.matrix(m.field(2), width)] + [m.field(q).to_numpy(zero_copy_only=False) for q in range(3, m.type.num_fields)])
            nx, ny = (b.column(c).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
            ox, oy, upto = np.cumsum(nx) - nx, np.cumsum(ny) - ny, np.concatenate([[0], np.cumsum(nx * ny)])
            r = 0
            while r < b.num_rows:
                e = max(r + 1, int(np.searchsorted(upto, upto[r] + PAIRS, side="right")) - 1)
                row = np.repeat(np.arange(r, e), np.diff(upto[r : e + 1]))
                k = np.arange(upto[r], upto[e]) - upto[row]
                i, j = ox[row] + k // ny[row], oy[row] + k % ny[row]
                ok = flat[0][1][i] != flat[1][1][j]
                yield flat[0], flat[1], row[ok], i[ok], j[ok]
                r = e

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for x, y, row, i, j in crossed(b):
                    left = survives(x[2][i], y[2][j], rule)
                    row, i, j = row[left], i[left], j[left]
                    if not len(i):
                        continue
                    same = np.concatenate([(x[2][i[s : s + 50_000]] == y[2][j[s : s + 50_000]]).sum(1) for s in range(0, len(i), 50_000)])
                    comp, pair = np.concatenate([x[1][i], y[1][j]]), np.concatenate([np.arange(len(i))] * 2)
                    order = np.lexsort((pair, -same[pair], comp, row[pair]))
                    first = np.ones(len(order), bool)
                    first[1:] = (comp[order][1:] != comp[order][:-1]) | (row[pair[order]][1:] != row[pair[order]][:-1])
                    pick = np.unique(pair[order][first])
                    p, q = x[0][i[pick]], y[0][j[pick]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

        def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bkey = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                for x, y, row, i, j in crossed(b):
                    left = survives(x[2][i], y[2][j], rule)
                    row, i, j = row[left], i[left], j[left]
                    ok = np.ones(len(i), bool)
                    if whole:  # a pair is listed in the first bucket that it shares, and in merged ones (negative keys); else once for each. It is verified once for each two blocks
                        kx, ky = (bucket_ids(K.band_keys(v[2], bands, rows), shards) for v in (x, y))
                        for s in range(0, len(i), 50_000):
                            part = slice(s, s + 50_000)
                            both_ = kx[i[part]] == ky[j[part]]
                            ok[part] = (kx[i[part], both_.argmax(1)] == bkey[row[part]]) | (bkey[row[part]] >> np.uint64(63) > 0)
                    i, j = i[ok], j[ok]
                    if not len(i):
                        continue
                    (sx, _, _, bx), (sy, _, _, by) = x, y
                    swap = bx[i] > by[j]
                    u, v = np.where(swap, by[j], bx[i]), np.where(swap, bx[i], by[j])
                    p, q = np.where(swap, sy[j], sx[i]), np.where(swap, sx[i], sy[j])
                    order = np.lexsort((v, u))
                    u, v, pq = u[order], v[order], np.stack([p, q], 1)[order]
                    cut = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1]), [True]]))
                    yield pa.RecordBatch.from_arrays([pa.array(u[cut[:-1]]), pa.array(v[cut[:-1]]), pa.array([pq[c:d].tobytes() for c, d in zip(cut[:-1], cut[1:])], pa.binary())], ["bx", "by", "pairs"])

        if blocks is None:
            return both.mapInArrow(thrifty(best), "a long, b long").distinct()
        return both.mapInArrow(thrifty(every), "bx long, by long, pairs binary")

    def exhausted(self, members: DataFrame) -> DataFrame:
        """Links (a, b) between components from all candidate pairs that are left, verified exactly.

        Members of one large bucket share blocks of about BLOCK texts. The pairs of two blocks are verified in one tile, to which
        each text comes once, and of each tile leave only links that join components not joined in it yet:
        neither pairs nor links of a large group are ever rows."""
        percent, shingles = self.percent, self.shingles
        home = materialise(members.groupBy("sid").agg(F.max_by("bkey", F.struct("n", "bkey")).alias("home"), F.any_value("comp").alias("comp")), "home")
        many = home.groupBy("home").agg(F.expr(f"int(ceil(count(*) / {BLOCK}))").alias("n"))
        blocks = materialise(home.join(many, "home").select("sid", "comp", F.expr("xxhash64(home, pmod(xxhash64(sid, 5), n))").alias("block")), "blocks")
        tiles = materialise(self.tiles(members, blocks.select("sid", "block")).groupBy("bx", "by").agg(F.collect_list("pairs").alias("pairs")), "tiles")
        used = materialise(tiles.select(F.explode(F.array("bx", "by")).alias("block")).distinct(), "used")
        wanted = materialise(blocks.join(small(used), "block", "left_semi"), "wanted")
        texts = self.texts.join(small(wanted, width=40), "sid").groupBy("block").agg(F.collect_list(F.struct("sid", "comp", "text")).alias("m"))
        content = materialise(texts, "content")
        x, y = content.select(F.col("block").alias("bx"), F.col("m").alias("mx")), content.select(F.col("block").alias("by"), F.col("m").alias("my"))
        both = tiles.repartition(partitions(self.spark)).join(x, "bx").join(y, "by").select("pairs", "mx", F.when(F.col("bx") != F.col("by"), F.col("my")).alias("my"))

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in (whole.slice(s, 100) for whole in batches for s in range(0, whole.num_rows, 100)):
                side = [b.column(c).flatten() for c in (1, 2)]
                sid, comp = (np.concatenate([m.field(q).to_numpy(zero_copy_only=False) for m in side]) for q in (0, 1))
                tile = np.concatenate([np.repeat(np.arange(b.num_rows), pc.fill_null(b.column(c).value_lengths(), 0).to_numpy(zero_copy_only=False)) for c in (1, 2)])
                listed = [np.frombuffer(b"".join(v), np.int64).reshape(-1, 2) for v in b.column(0).to_pylist()]
                row, pairs = np.repeat(np.arange(b.num_rows), [len(v) for v in listed]), np.concatenate(listed)
                # where the members of each pair are, by tile and id
                known, code = np.unique(sid, return_inverse=True)
                place = tile * len(known) + code
                order = np.argsort(place)
                x, y = (order[np.searchsorted(place[order], row * len(known) + np.searchsorted(known, pairs[:, q]))] for q in (0, 1))
                order = np.lexsort((y, x, row))
                row, x, y = row[order], x[order], y[order]
                new = np.ones(len(x), bool)
                new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                row, x, y = row[new], x[new], y[new]
                # only texts that are in a pair are looked at
                used, inv = np.unique(np.concatenate([x, y]), return_inverse=True)
                texts = pa.concat_arrays([m.field(2) for m in side]).take(pa.array(used))
                judge = shingles.alike(texts, inv[: len(x)], inv[len(x) :], percent)
                top: dict[int, int] = {}  # component, and what it is joined with in this tile

                def root(v: int) -> int:
                    while top.get(v, v) != v:
                        v = top[v]
                    return v

                out, now = [], -1
                for k, (r, i, j) in enumerate(zip(row.tolist(), x.tolist(), y.tolist())):
                    if r != now:
                        now = r
                        top.clear()
                    u, v = root(int(comp[i])), root(int(comp[j]))
                    if u != v and judge(k):
                        out.append((int(sid[i]), int(sid[j])))
                        top[max(u, v)] = min(u, v)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], ["a", "b"])

        links = materialise(both.mapInArrow(thrifty(verify), "a long, b long"), "links")
        for table in (home, blocks, tiles, used, wanted, content):
            discard(table)
        release_shuffles(self.spark)
        return links

    def components(self) -> DataFrame:
        """(node, root) of every sid that is linked with another.

        Round 0 pairs each bucket's least member with its others; a second round pairs each component of a bucket with the member of
        another one that is likest by signature. Last, every pair of members of a bucket that
        are still in different components is compared, in tiles: no candidate pair between components is left out."""
        pairs = materialise(self.centre_pairs(), "centres")
        release_shuffles(self.spark)  # the bands of all nodes, by far the largest shuffle
        sids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "sids")
        self.texts = materialise(self.fetch(sids), "texts")
        self.nodes = materialise(self.describe(self.texts), "nodes")
        self.n_nodes = self.nodes.count()
        release_shuffles(self.spark)
        links = self.verified(pairs, True)
        discard(pairs)
        found = [links]
        comps = connected_components(links)
        for last in (False, True) if self.likeliest else (True,):
            members = merged_buckets(materialise(self.members(comps), "members"))
            new = self.exhausted(members) if last else self.verified(self.tiles(members), False)
            if not new.isEmpty():
                found.append(new)
                links = links.unionByName(new)
                comps = connected_components(links)
            for table in (members, *self.scrap):
                discard(table)
            self.scrap = []
        comps = materialise(comps, "comps")
        for table in (sids, self.texts, self.nodes, *found):
            discard(table)
        release_shuffles(self.spark)
        return comps
