"""Distributed union-find: connected components by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.llm.session import discard, materialise, partitions


#: Up to so many distinct edges (some MB) one task finds the components; more of them take the distributed rounds.
ONE_TASK_EDGES = 200_000


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of edges a-b, sorted, and the least node that each reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        was = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == was).all():
            return nodes, nodes[label]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if got:
        nodes, root = least_labels(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root)], ["node", "root"])


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the graph of edges (a long, b long).

    Returns (node, root), root being the smallest node reachable, for every node of
    an edge between two different nodes. Edges with a null end and loops count for nothing; repeats
    do no harm. Each round moves every larger neighbour, then every smaller one, to the least
    neighbour, so a path shrinks geometrically. Only the least neighbour of a node is ever gathered
    (partial aggregation), and the joins have one row for each node on one side, so a hub's
    edges can be split over tasks."""
    e = (
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    e = materialise(e, "cc")
    if e.count() <= ONE_TASK_EDGES:
        return e.coalesce(1).mapInArrow(_in_one_task, "node long, root long")
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour of u goes to u's least neighbour
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every smaller neighbour of u, and u itself, goes to the least of them
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialise(small.union(floor.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = new
        if tuple(now) == state:
            break
        state = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def least_by_root(rooted: DataFrame, value: str, name: str) -> DataFrame:
    """rooted (root, value and others; a materialised table) with the least value of each root as name.

    Roots with more rows than half a partition's share are few (twice the partitions at most), so these are broadcast: no task gets all rows of one."""
    spark = rooted.sparkSession
    hot = max(1, rooted.count() // (2 * partitions(spark)))
    least = materialise(rooted.groupBy("root").agg(F.min(value).alias(name), F.count("*").alias("__n")), "least")
    few, many = least.where(F.col("__n") > hot).drop("__n"), least.where(F.col("__n") <= hot).drop("__n")
    a = rooted.join(F.broadcast(few), "root")
    b = rooted.join(F.broadcast(few.select("root")), "root", "left_anti").join(many, "root")
    return a.unionByName(b)
