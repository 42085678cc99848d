"""Overtaking split: routes cut into blocks give the chains of the plain sequence of choices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachspark.operators import chains, patterns


def plain(trips):
    """trips: {uid: times}: the rule as one loop."""
    out, last = {}, []
    for uid in sorted(trips, key=lambda u: (trips[u][0], u)):
        fits = [c for c, t in enumerate(last) if all(a <= b for a, b in zip(t, trips[uid]))]
        c = max(fits, key=lambda c: (last[c][0], -c)) if fits else len(last)
        last[c:c + 1] = [trips[uid]]
        out[uid] = c
    return out


def dealt(spark, routes, part):
    rows = [(u, r, p, f"s{p}", t, t, 0, 0) for r, trips in routes.items() for u, ts in trips.items() for p, t in enumerate(ts)]
    c = spark.createDataFrame(rows, "uid string, route_id string, pos int, stop_id string, arr long, dep long, pickup int, drop_off int")
    got = patterns.trip_chains(c.repartition(5, F.rand(3)), part).collect()
    assert len(got) == sum(map(len, routes.values()))
    return {r.uid: r.chain for r in got}


@pytest.mark.parametrize("part", [1, 4, 16, 10_000])
def test_cut_routes_equal_the_plain_rule(spark, part):
    rnd, routes = random.Random(part), {}
    for r in range(24):
        step, spread, ties = rnd.choice([2, 20, 60]), rnd.choice([0, 5, 40, 400]), rnd.choice([1, 10])
        trips = {}
        for i in range(rnd.choice([1, 3, 60, 150])):
            t = [(i * step + rnd.randrange(step)) // ties * ties]
            for _ in range(3):
                t.append(t[-1] + 10 + rnd.randrange(spread + 1))
            trips[f"r{r}-{i:04d}"] = t
        routes[f"R{r}"] = trips
    got = dealt(spark, routes, part)
    for trips in routes.values():
        assert {u: got[u] for u in trips} == plain(trips)


def test_choice_by_age_is_made_again(spark):
    """t2 overtakes t1, so the chain of t2 is the younger one but left later: u1 goes on with it. v follows u1 and u2, which left together: the older chain is u2's, though u1's is the block's first."""
    trips = {"t1": [0, 50], "t2": [10, 40], "u1": [100, 205], "u2": [100, 202], "u3": [100, 300], "v": [150, 290]}
    want = plain(trips)
    assert dealt(spark, {"R": trips}, 2) == want
    # the case needs it: alone, the block takes another chain for v
    block = [trips[u] for u in ("u1", "u2", "u3", "v")]
    alone, _, over = chains.greedy(np.array([t[0] for t in block]), np.array(block))
    assert over and [want["u1"], want["u2"]][int(alone[3])] != want["v"]


def test_one_route_of_many_trips(spark):
    """A route with most rows is dealt out in many blocks."""
    trips = spark.range(40_000).select(
        F.concat(F.lit("x"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("uid"), F.lit("R").alias("route_id"), F.array(F.lit("a"), F.lit("b")).alias("stop_ids"),
        F.expr("array(named_struct('arr', id * 5, 'dep', id * 5), named_struct('arr', id * 5 + 100 + id % 7 * 3, 'dep', id * 5 + 100 + id % 7 * 3))").alias("times"),
    )
    got = {r.uid: r.chain for r in chains.trip_chains(trips, 1000).collect()}
    assert got == plain({f"x{i:06d}": [5 * i, 5 * i + 100 + i % 7 * 3] for i in range(40_000)})


def test_no_trips(spark):
    c = spark.createDataFrame([], "uid string, route_id string, pos int, stop_id string, arr long, dep long, pickup int, drop_off int")
    assert patterns.trip_chains(c).collect() == []
