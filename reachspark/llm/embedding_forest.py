"""Near-duplicate embeddings by a random-projection tree forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm.components import connected_components, least_by_root
from reachspark.llm.session import discard, join_skewed, materialise, partitions, release_shuffles

#: Trees, half width of the overlap at a split, vectors the splits are fitted on, vectors wanted in a leaf, rows of a tile's side, random directions of which a split takes the best.
TREES, SPILL, SAMPLE, LEAF, TILE, TRIED = 3, 0.014, 80_000, 256, 1024, 4


def vectors(col: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Usable rows of a column of arrays (not null, not empty, finite, not zero), grouped by dimension: row numbers, dimension of each, matrices."""
    rows, dims, mats = [], [], []
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.array([-1 if v is None else v for v in col.value_lengths().to_pylist()], np.int64)
    for d in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == d)
        flat = col.take(pa.array(at)).flatten().cast(pa.float64())
        m = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(at), d)  # null components become NaN
        ok = np.isfinite(m).all(1) & (m != 0).any(1)
        rows.append(at[ok])
        dims.append(np.full(int(ok.sum()), d))
        mats.append(m[ok])
    return (np.concatenate(rows) if rows else np.zeros(0, int)), (np.concatenate(dims) if dims else np.zeros(0, int)), mats


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)  # no overflow or underflow in the squares
    return m / np.sqrt((m * m).sum(1, keepdims=True))


class Forest:
    """Trees whose nodes split at the median of a sample's projections on a random direction: of TRIED ones that which fewest of the sample lie near the split of. A vector within
    ``spill`` of a split goes both ways. Two unit vectors of cosine 0.98 differ by 0.2 in length, so by about 0.2/sqrt(d) in projection."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, spill: float, seed: int = 7):
        self.depth, self.trees, self.spill, self.dim = depth, trees, spill, sample.shape[1]
        rng = np.random.default_rng(seed)
        self.axes, self.cuts = [], []
        for _ in range(trees):
            axes = np.zeros((max(1, (1 << depth) - 1), self.dim))
            cuts, at = np.zeros(len(axes)), np.zeros(len(sample), int)
            for level in range(depth):
                base, n = (1 << level) - 1, 1 << level
                order = np.argsort(at, kind="stable")
                edge = np.searchsorted(at[order], np.arange(n + 1))
                near = np.full(n, np.inf)
                for _ in range(TRIED):
                    tried = rng.standard_normal((n, self.dim))
                    tried /= np.sqrt((tried * tried).sum(1, keepdims=True))
                    p = np.einsum("ij,ij->i", sample, tried[at])
                    for node in range(n):
                        own = p[order[edge[node] : edge[node + 1]]]
                        cut = np.median(own) if len(own) else 0.0
                        close = (np.abs(own - cut) <= 2 * spill).sum()
                        if close < near[node]:
                            near[node], axes[base + node], cuts[base + node] = close, tried[node], cut
                p = np.einsum("ij,ij->i", sample, axes[base + at])
                at = 2 * at + (p > cuts[base + at])
            self.axes.append(axes)
            self.cuts.append(cuts)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf codes (tree and path), sorted by row then code."""
        rows_out, codes = [], []
        for t in range(self.trees):
            row, node = np.arange(len(x)), np.zeros(len(x), int)
            for level in range(self.depth):
                base = (1 << level) - 1
                p = np.einsum("ij,ij->i", x[row], self.axes[t][base + node]) - self.cuts[t][base + node]
                left, right = p <= self.spill, p > -self.spill
                row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows_out.append(row)
            codes.append((t << self.depth) + node)
        row, code = np.concatenate(rows_out), np.concatenate(codes)
        order = np.lexsort((code, row))
        return row[order], code[order]


def _compare(cosine: float):
    """Within a tile: counts of links that no earlier leaf holds, and a star for each component of the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                code, same = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                side = []
                for c in (2,) if same else (2, 3):
                    m = b.column(c)[r].values
                    ids = m.field(0).to_numpy(zero_copy_only=False)
                    n = m.field(1).to_numpy(zero_copy_only=False)
                    x = unit(m.field(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1))
                    cl = m.field(3)
                    side.append((ids, n, x, np.repeat(np.arange(len(ids)), np.diff(cl.offsets.to_numpy())), cl.flatten().to_numpy(zero_copy_only=False)))
                if same:
                    side.append(side[0])
                (ia, na, xa, ra, ca), (ib, nb, xb, rb, cb) = side
                link = xa @ xb.T >= cosine
                if same:
                    np.fill_diagonal(link, False)
                if not link.any():
                    continue
                # leaves before this one that both hold: the pair was counted there
                ea, eb = ca < code, cb < code
                names, spot = np.unique(np.concatenate([ca[ea], cb[eb]]), return_inverse=True)
                fa, fb = np.zeros((len(ia), len(names)), np.float32), np.zeros((len(ib), len(names)), np.float32)
                fa[ra[ea], spot[: int(ea.sum())]] = 1
                fb[rb[eb], spot[int(ea.sum()) :]] = 1
                new = link & ((fa @ fb.T) == 0) if len(names) else link
                ids = np.concatenate([ia, ib]) if not same else ia
                got = new @ nb.astype(float)
                got = got if same else np.concatenate([got, new.T @ na.astype(float)])
                # components of the tile: least id spreads along links
                label = np.arange(len(ids))
                i, j = np.nonzero(link)
                j = j if same else j + len(ia)
                while True:
                    was = label.copy()
                    np.minimum.at(label, i, label[j])
                    np.minimum.at(label, j, label[i])
                    label = label[label]
                    if (label == was).all():
                        break
                use = (got > 0) | (label != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(got[use].astype(np.int64)), pa.array(ids[label[use]])], ["sid", "n", "star"])

    return run


def link_embeddings(table: DataFrame, cosine: float = 0.98, trees: int = TREES, spill: float = SPILL, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Links between vectors of one label with cosine of at least ``cosine``, and their components.

    table: vec_id long, embedding array of floats or doubles, label; others are not read. Equal vectors of a label are one
    node with a count. A forest (its splits fitted on about ``sample`` distinct vectors, those of least hash, a documented bound; every vector is
    indexed) puts each vector into one or more leaves of each tree; leaves of one label are compared exactly in double precision, in tiles of about
    TILE rows a side where a leaf is large, so dense leaves are whole too. A pair counts in the first leaf that it shares.

    Returns a row for each row of table: vec_id, n_links (rows linked directly, equal vectors included), component_id (least vec_id
    reachable), kept (vec_id = component_id). Vectors that are null, empty or zero, have null or non-finite components, or no label: 0 links, their own component.
    Vectors of different lengths never link. Rows that repeat a vec_id are separate rows. A null vec_id: component_id is the least vec_id of its component if there is one,
    and the row is kept only if there is none. An empty table gives an empty result."""
    spark = table.sparkSession
    # floats stay floats on their way; cosines are of doubles
    kind = "float" if table.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    own = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), F.col("label").cast("string").alias("label"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, _, _ = vectors(b.column(1))
            ok = np.zeros(b.num_rows, bool)
            ok[rows] = True
            ok &= b.column(2).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ok)], ["vec_id", "embedding", "label", "ok"])

    # one node for each vector and label; -0.0 equals 0.0
    same = F.transform("embedding", lambda v: v.cast("double") + F.lit(0.0))
    keyed = own.mapInArrow(clean, f"vec_id long, embedding array<{kind}>, label string, ok boolean").withColumn("sid", F.when(F.col("ok"), F.xxhash64("label", same)))
    keyed = materialise(keyed, "vectors")
    good = keyed.where("ok")
    nodes = good.groupBy("sid").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"))
    nodes = materialise(nodes, "nodes")
    total = nodes.count()
    found, written = None, []
    if total:
        dims = [r[0] for r in nodes.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect()]
        for d in dims:
            part = nodes.where(F.size("embedding") == d)
            have = part.count()
            rate = min(1.0, sample / have)
            fit = part.where(F.pmod(F.xxhash64("sid", F.lit(3)), F.lit(1 << 30)) < int(rate * (1 << 30))).select("embedding").toArrow().column("embedding").combine_chunks()
            fit = unit(np.sort(fit.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(fit), d).view([("", float)] * d), axis=0).view(float).reshape(-1, d)) if len(fit) else np.zeros((0, d))
            depth = max(0, min(int(np.ceil(np.log2(max(1, have / leaf)))), int(np.log2(max(1, len(fit) / 4)))))
            forest = Forest(fit, depth, trees if depth else 1, spill * np.sqrt(64 / d))
            # the hashed identity of a forest: its leaves of a label
            held = spark.sparkContext.broadcast(forest)  # trees x 2^depth directions: at most trees x sample / 4 of them, some 30 MB of 64 dimensions

            def leaves(batches: Iterator[pa.RecordBatch], held=held, d=d) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    for i in range(0, b.num_rows, 2048):
                        part = b.slice(i, 2048)
                        x = unit(part.column(3).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, d))
                        row, code = held.value.leaves(x)
                        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(code.astype(np.int64)))
                        at = pa.array(row)
                        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), part.column(2).take(at), part.column(0).take(at), part.column(1).take(at), part.column(3).take(at), lists.take(at)], ["code", "label", "sid", "n", "embedding", "codes"])

            rows = part.select("sid", "n", "label", "embedding").repartition(partitions(spark)).mapInArrow(leaves, f"code long, label string, sid long, n long, embedding array<{kind}>, codes array<long>")
            rows = materialise(rows, "leaves")
            written.append(rows)
            size = rows.groupBy("code", "label").agg(F.expr(f"int(ceil(count(*) / {TILE}))").alias("k"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
            block = rows.join(size, ["code", "label"]).withColumn("t", F.expr("int(pmod(xxhash64(sid, 11), k))")).groupBy("code", "label", "t").agg(F.collect_list(F.struct("sid", "n", "embedding", "codes")).alias("m"), F.any_value("k").alias("k"))
            u, v = block.alias("u"), block.select("code", "label", "t", "m").alias("v")
            one = block.select("code", F.lit(True).alias("same"), "m", F.lit(None).cast(block.schema["m"].dataType).alias("m2"))
            two = u.where("k > 1").join(v, (F.col("u.code") == F.col("v.code")) & (F.col("u.label") == F.col("v.label")) & (F.col("u.t") < F.col("v.t"))).select(F.col("u.code").alias("code"), F.lit(False).alias("same"), F.col("u.m").alias("m"), F.col("v.m").alias("m2"))
            stars = one.unionByName(two).mapInArrow(_compare(cosine), "sid long, n long, star long")
            found = stars if found is None else found.unionByName(stars)
    if found is None:
        found = spark.createDataFrame([], "sid long, n long, star long")
    found = materialise(found, "stars")
    for table_ in written:
        discard(table_)
    release_shuffles(spark)
    comps = connected_components(found.select(F.col("sid").alias("a"), F.col("star").alias("b")))
    counts = found.groupBy("sid").agg(F.sum("n").alias("others"))
    rooted = materialise(nodes.select("sid", "least", "n").join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "rooted")
    named = least_by_root(rooted, "least", "component_id").join(counts, "sid", "left").select("sid", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", "n")
    linked = join_skewed(good.select("vec_id", "sid"), materialise(named, "named"), "sid").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
    alone = keyed.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)
