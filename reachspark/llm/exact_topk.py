"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm.session import discard, materialise, partitions

#: Leading rotated coordinates that a partial sum takes at a time; rows of a block of candidates, of a group of queries, and of those that meet a block at once.
STEP, BLOCK, QUERIES, AT_ONCE = 16, 4096, 2048, 512
#: Rows longer than this take no part in fitting the rotation: squares of theirs overflow.
LONG = 1e100
MOST = 2**63 - 1


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(256 * x) as doubles, in which these whole numbers are exact (up to the largest double, where larger ones end)."""
    for b in batches:
        col = b.column(1)
        size = np.array([-1 if v is None else v for v in col.value_lengths().to_pylist()], np.int64)
        for d in np.unique(size[size > 0]).tolist():
            at = np.flatnonzero(size == d)
            m = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), d)
            ok = np.isfinite(m).all(1) & b.column(0).take(pa.array(at)).is_valid().to_numpy(zero_copy_only=False)
            if not ok.any():
                continue
            with np.errstate(over="ignore"):
                v = np.clip(np.floor(256.0 * m[ok]), -np.finfo(float).max, np.finfo(float).max) + 0.0
                top = np.maximum(np.abs(v).max(1), 1.0)
                norm = top * np.sqrt(((v / top[:, None]) ** 2).sum(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * d), pa.array(v.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[ok])), lists, pa.array(norm)], ["vec_id", "v", "norm"])


def _mat(col: pa.Array) -> np.ndarray:
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, g): rows of the second moments of a task's vectors."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        size = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(size).tolist():
            m = _mat(b.column(0).filter(pa.array(size == d)))
            m = m[np.abs(m).max(1) < LONG]
            total[d] = total.get(d, 0) + m.T @ m
    for d, t in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(list(t), pa.list_(pa.float64()))], ["d", "i", "g"])


def best(q: np.ndarray, qid: np.ndarray, floor: np.ndarray, x: np.ndarray, norms: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates (query row, vec_id, score) that may be among the k best, from one block.

    q, x: vectors of whole numbers; floor: a score that k other rows of each query reach already (or -inf). Candidates come by
    descending norm. The inner product of rotated vectors is summed over leading coordinates; a pair is out once that sum and the product of
    the lengths of what remains (Cauchy-Schwarz), with slack for rounding, fall below the query's floor. The rest are scored in integers. What overflows stays in."""
    order = np.argsort(-norms, kind="stable")
    x, norms, ids = x[order], norms[order], ids[order]
    with np.errstate(over="ignore", invalid="ignore"):
        qr, xr = q @ turn, x @ turn
        d = q.shape[1]
        qn = np.sqrt((qr * qr).sum(1))
        rows, cands = np.meshgrid(np.arange(len(q)), np.arange(len(x)), indexing="ij")
        slack = 1e-9 * (qn[:, None] * norms[None, :] + 1)
        live = ~(qn[:, None] * norms[None, :] + slack < floor[:, None])
        live &= qid[:, None] != ids[None, :]
        part = np.zeros(live.shape)
        for a in range(0, d, step):
            b = min(d, a + step)
            if not live.any():
                break
            part += qr[:, a:b] @ xr[:, a:b].T
            left = np.sqrt(np.maximum((qr[:, b:] ** 2).sum(1), 0))[:, None] * np.sqrt(np.maximum((xr[:, b:] ** 2).sum(1), 0))[None, :]
            bound = part + left + slack
            live &= ~(bound < floor[:, None])
            if b < d and live.shape[1] > k:
                # what k live rows reach at least raises the floor
                low = np.where(live, part - left - slack, -np.inf)
                low[~np.isfinite(low)] = -np.inf
                floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
                live &= ~(bound < floor[:, None])
    r, c = rows[live], cands[live]
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * d < 2**62:
        q, x, score = q.astype(np.int64), x.astype(np.int64), np.empty(len(r), np.int64)
        for a in range(0, len(r), 1 << 16):
            score[a : a + (1 << 16)] = np.einsum("ij,ij->i", q[r[a : a + (1 << 16)]], x[c[a : a + (1 << 16)]])
    else:  # beyond 64 bits: exact in Python's integers, then the nearest that fits
        whole = lambda m: [[int(v) for v in row] for row in m.tolist()]
        wq, wx = whole(q), whole(x)
        score = np.array([max(-MOST, min(MOST, sum(u * v for u, v in zip(wq[i], wx[j])))) for i, j in zip(r.tolist(), c.tolist())], np.int64)
    order = np.lexsort((ids[c], -score, r))
    r, c, score = r[order], c[order], score[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    keep = rank < k
    return r[keep], ids[c[keep]], score[keep]


def _search(turns: dict[int, np.ndarray], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                m, p = b.column(0)[r].values, b.column(1)[r].values
                q, x = _mat(m.field(1)), _mat(p.field(1))
                floor = m.field(2).to_numpy(zero_copy_only=False).astype(float)
                qid, ids, copies = m.field(0).to_numpy(zero_copy_only=False), p.field(0).to_numpy(zero_copy_only=False), p.field(2)
                # a distinct vector stands for its k + 1 least ids
                at = np.repeat(np.arange(len(x)), copies.value_lengths().to_numpy(zero_copy_only=False))
                names = copies.flatten().to_numpy(zero_copy_only=False)
                for a in range(0, len(q), AT_ONCE):
                    part = slice(a, a + AT_ONCE)
                    got = best(q[part], qid[part], floor[part], x[at], ids[at], names, turns[q.shape[1]], k)
                    yield pa.RecordBatch.from_arrays([pa.array(qid[part][got[0]]), pa.array(got[1]), pa.array(got[2])], ["query_id", "vec_id", "score"])

    return run


def exact_top_k(table: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k highest integer inner products of each query with all other rows, ties to the smaller vec_id.

    table: vec_id long, embedding array; others are not read. Components x become floor(256 * x). Queries are the rows whose vec_id is divisible by
    ``every``; candidates every row but the query's own id. Vectors that are null, empty, or have null or non-finite components, or no vec_id, take no part; those of
    another length than the query are no candidates. Zero vectors take part. Queries with fewer candidates get all of them; rows that repeat a vec_id are one candidate each,
    and a repeated query id with one vector is one query. Products beyond 64 bits are worked out exactly and given as the largest or least long (-(2^63-1)).

    Equal vectors are one candidate that carries its k + 1 least ids: no more of them can rank. Candidates lie in blocks by descending length, met in waves: the longest block, then
    the next 3, 12, 48... After each wave a query's k-th score is its floor, and groups of queries meet another block only if one query's length times the block's largest reaches
    its floor. The rotation comes from the second moments of all rows (an SVD of d x d numbers at the driver)."""
    spark = table.sparkSession
    own = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    base = materialise(own.mapInArrow(_quantised, "vec_id long, v array<double>, norm double"), "quantised")
    turns = {}
    summed = base.select("v").mapInArrow(_gram, "d long, i long, g array<double>").groupBy("d", "i").agg(F.collect_list("g").alias("g")).select("d", "i", F.expr("aggregate(slice(g, 2, size(g)), g[0], (a, b) -> zip_with(a, b, (x, y) -> x + y))").alias("g"))
    moments: dict[int, dict[int, list[float]]] = {}
    for r in summed.collect():
        moments.setdefault(r.d, {})[r.i] = r.g
    for d, g in moments.items():
        turns[d] = np.ascontiguousarray(np.linalg.eigh(np.array([g[i] for i in range(d)]))[1][:, ::-1])
    # equal vectors: k + 1 least ids, gathered by task first so that no task sees more than the tasks' shares
    least = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    some = base.withColumn("task", F.spark_partition_id()).groupBy("v", "norm", "task", F.expr("int(pmod(xxhash64(vec_id), 16))").alias("salt")).agg(least(F.collect_list("vec_id")).alias("ids"))
    distinct = materialise(some.groupBy("v", "norm").agg(least(F.flatten(F.collect_list("ids"))).alias("ids")), "distinct")
    total = distinct.count()
    queries = base.where(f"vec_id % {int(every)} = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("norm").alias("qn")).dropDuplicates(["query_id", "q"])
    queries = materialise(queries.withColumn("d", F.size("q")), "queries")
    discard(base)
    n_queries = queries.count()
    if not total or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # blocks by length: quantiles of all rows' lengths, so that a block has about BLOCK rows; ties share one and are split by hash
    n_blocks = -(-total // BLOCK)
    cuts = distinct.select(F.percentile_approx("norm", [i / n_blocks for i in range(1, n_blocks)] or [0.5], 10_000)).first()[0]
    place = F.expr(f"size(filter(array({','.join(f'{c!r}D' for c in sorted(set(cuts)))}), c -> c > norm))") if n_blocks > 1 else F.lit(0)
    placed = distinct.select(F.size("v").alias("d"), "v", "norm", "ids", place.alias("level"))
    size = placed.groupBy("d", "level").agg(F.expr(f"int(ceil(count(*) / {2 * BLOCK}))").alias("parts"))
    blocks = placed.join(size, ["d", "level"]).withColumn("part", F.expr("int(pmod(xxhash64(v), parts))")).groupBy("d", "level", "part").agg(F.collect_list(F.struct("norm", "v", "ids")).alias("x"), F.max("norm").alias("most"))
    blocks = materialise(blocks, "blocks")
    discard(distinct)
    group = F.expr(f"int(pmod(xxhash64(query_id), {-(-n_queries // QUERIES)}))").alias("g")
    keys = blocks.select("d", "level", "part", "most").withColumn("step", F.dense_rank().over(Window.partitionBy("d").orderBy("level")) - 1)
    keys = materialise(keys, "keys")
    steps = keys.agg(F.max("step")).first()[0] + 1
    reached, lo, hi = None, 0, 1
    while lo < steps:
        q = queries.withColumn("floor", F.lit(float("-inf")))
        if reached is not None:
            floors = reached.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select("query_id", F.expr(f"double(try_element_at(s, {k}))").alias("floor"))
            q = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        # the length that a block needs for this query
        need = F.when(F.col("floor") <= 1, F.lit(float("-inf"))).when(F.col("qn") == 0, F.lit(float("inf"))).otherwise((F.col("floor") - 1) / (F.col("qn") * (1 + 1e-9)))
        groups = q.groupBy("d", group).agg(F.collect_list(F.struct("query_id", "q", "floor")).alias("m"), F.min(need).alias("need"))
        groups = materialise(groups, "groups")
        pairs = groups.select("d", "g", "need").join(keys.where((F.col("step") >= lo) & (F.col("step") < hi)), "d").where("most >= need").select("d", "g", "level", "part")
        both = pairs.repartition(partitions(spark)).join(groups.select("d", "g", "m"), ["d", "g"]).join(blocks.select("d", "level", "part", "x"), ["d", "level", "part"]).select("m", "x")
        found = materialise(both.mapInArrow(_search(turns, k), "query_id long, vec_id long, score long"), "wave")
        discard(groups)
        # the k best so far of each query: nothing else can rank
        all_ = found if reached is None else reached.drop("pos").unionByName(found)
        top = all_.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("top"))
        last, reached = reached, materialise(top.select("query_id", F.posexplode("top").alias("pos", "t")).select("query_id", F.col("t.vec_id").alias("vec_id"), (-F.col("t.minus")).alias("score"), "pos"), "best")
        for table_ in (found, last):
            discard(table_)
        lo, hi = hi, 4 * hi
    for table_ in (queries, blocks, keys):
        discard(table_)
    return reached.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "vec_id", "score")
