"""Large groups of near copies, which meet in many large buckets."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from reachspark.llm import neardup
from reachspark.llm.minhash_dedup import near_duplicates
from tests.llm.test_dedup import linked, roots, word_sets


def _pairs(members):
    """Pairs of different components that share a bucket."""
    by = {}
    for r in members:
        by.setdefault(r.bkey, []).append((r.sid, r.comp))
    return {(a[0], b[0]) for m in by.values() for a, b in combinations(sorted(m), 2) if a[1] != b[1]}


def _members(spark, buckets):
    return spark.createDataFrame([(k, s, s if s % 5 else 0, len(m)) for k, m in buckets.items() for s in m], "bkey long, sid long, comp long, n long")


def test_merged_buckets_lose_no_pair(spark):
    r = random.Random(2)
    buckets = {k: r.sample(range(120), 70) for k in range(1, 13)}  # much the same members
    buckets |= {50: list(range(200, 240)), 51: [*range(240, 280), 119], 52: [3, 4, 201, 260], 53: [5, 6, 7]}  # others, and small ones
    was = _members(spark, buckets)
    now = neardup.merged_buckets(was, tile=16).collect()
    assert _pairs(was.collect()) <= _pairs(now)
    large = [x for x in now if x.n > 16]
    assert sum(x.sid < 119 for x in large) == len({x.sid for x in large if x.sid < 119}) == 119  # once each, not once for each bucket
    sizes = {}
    for x in now:
        sizes.setdefault(x.bkey, []).append(x)
    assert all(len(m) == m[0].n for m in sizes.values())
    assert {50, 51, 52, 53} <= set(sizes)  # weakly tied or small: as they were


def test_chains_of_buckets_stay_apart_where_a_union_makes_more_pairs(spark):
    chain = {k: list(range(30 * k, 30 * k + 50)) for k in range(1, 20)}  # a fifth of each is in the next one
    was = _members(spark, chain)
    now = neardup.merged_buckets(was, tile=16).collect()
    assert _pairs(was.collect()) <= _pairs(now)
    sizes = {x.bkey: x.n for x in now}
    assert sum(n * n for n in sizes.values()) <= sum(len(m) ** 2 for m in chain.values())


@pytest.mark.parametrize("copies", [700])
def test_copies_of_a_large_group_meet_once(spark, monkeypatch, copies):
    """Near copies just below the threshold: right components, and of all large buckets a text is in one only."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base, texts = [r.choice(words) for _ in range(100)], []
    for _ in range(copies):
        t = list(base)
        for at in r.sample(range(100), 4):
            t[at] = r.choice(words)
        texts.append(" ".join(t))
    seen, real = [], neardup.tile_pairs

    def spy(members, *more):
        large = members.where(F.col("n") > 256)
        placed, pairs = real(members, *more)
        seen.append((large.count(), large.select("sid").distinct().count(), pairs.where("x <> y").count()))
        return placed, pairs

    monkeypatch.setattr(neardup, "tile_pairs", spy)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in near_duplicates(df, words=2).collect()}
    assert [got[i] for i in range(copies)] == roots(copies, linked(word_sets(texts, 2)))
    print("rows and texts in large buckets, pairs of tiles that meet:", seen)
    assert seen and all(n == texts_ > 256 and met <= 10 for n, texts_, met in seen)
