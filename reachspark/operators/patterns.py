"""Route patterns: trips of a route with one stop sequence that never overtake each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.operators import chains


def grouped(concrete: DataFrame) -> DataFrame:
    """(uid, route_id, stop_ids, times): one row for each trip, positions in order."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "stop_id", "arr", "dep", "pickup", "drop_off")))
    t = concrete.groupBy("uid", "route_id").agg(rows.alias("times"))
    return t.withColumn("stop_ids", F.transform("times", lambda x: x["stop_id"]))


def base_patterns(concrete: DataFrame) -> DataFrame:
    """(route_id, stop_ids, n_trips): trips by route and exact stop sequence."""
    t = concrete.groupBy("uid", "route_id").agg(F.array_sort(F.collect_list(F.struct("pos", "stop_id"))).alias("at"))
    return t.groupBy("route_id", F.transform("at", lambda x: x["stop_id"]).alias("stop_ids")).agg(F.count("*").alias("n_trips"))


def trip_chains(concrete: DataFrame, part: int = chains.PART) -> DataFrame:
    """(uid, chain) within each route and stop sequence, see chains."""
    return chains.trip_chains(grouped(concrete), part)


def dense_stops(concrete: DataFrame) -> DataFrame:
    """(stop_id, stop_idx) of the stops in use: rank by id from 0."""
    return concrete.select("stop_id").distinct().withColumn("stop_idx", F.row_number().over(Window.orderBy("stop_id")) - 1)


def patterns(concrete: DataFrame, dealt: DataFrame | None = None) -> dict[str, DataFrame]:
    """stops (stop_id, stop_idx), trips (uid, pattern_id, trip_idx, route_id), pattern_stop and pattern_time tables.

    Patterns are numbered by route, stop sequence and chain; trips in a pattern by (first departure, uid). Without (uid, chain) in dealt each base pattern is one chain
    (for timetables known never to overtake)."""
    stops = dense_stops(concrete)
    g = grouped(concrete).withColumn("first_dep", F.element_at("times", 1)["dep"])
    g = g.join(dealt, "uid") if dealt is not None else g.withColumn("chain", F.lit(0))
    names = g.select("route_id", "stop_ids", "chain").distinct()
    names = names.withColumn("pattern_id", F.row_number().over(Window.orderBy("route_id", "stop_ids", "chain")) - 1)
    in_order = Window.partitionBy("pattern_id").orderBy("first_dep", "uid")
    named = g.join(names, ["route_id", "stop_ids", "chain"]).withColumn("trip_idx", F.row_number().over(in_order) - 1)
    stop = names.select("pattern_id", F.posexplode("stop_ids").alias("pos", "stop_id")).join(stops, "stop_id").select("pattern_id", "pos", "stop_idx")
    time = named.select("pattern_id", "trip_idx", F.explode("times").alias("t")).select("pattern_id", "trip_idx", "t.pos", "t.arr", "t.dep", "t.pickup", "t.drop_off")
    return {"stops": stops, "trips": named.select("uid", "pattern_id", "trip_idx", "route_id"), "pattern_stop": stop, "pattern_time": time}
