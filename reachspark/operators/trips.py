"""Trips of the service date: retention, grouping, frequency expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.config import Scenario

#: Marks the trips that a frequency makes, between the trip's id and (window, departure).
MARK = "\x00frequency:"


def rail_routes(routes: DataFrame) -> DataFrame:
    """(route_id, is_rail) by route type."""
    # Route types that are rail.
    rail = [2, 100, 101, 102, 103, 105, 106, 107, 108, 109, 111, 113, 114, 116, 117]
    return routes.select("route_id", F.col("route_type").cast("int").isin(rail).alias("is_rail"))


def retained_trips(stop_times: DataFrame, windows: DataFrame, scenario: Scenario) -> DataFrame:
    """trip_ids that can be boarded from the window's start on. With frequencies: some window ends after it and some stop allows boarding;
    else some stop does with a departure at or after it. There is no upper bound."""
    start = scenario.window_start
    board = F.col("pickup") != 1
    trips = stop_times.groupBy("trip_id").agg(F.bool_or(board).alias("boardable"), F.bool_or(board & (F.col("dep") >= start)).alias("later"))
    freq = windows.groupBy("trip_id").agg(F.bool_or(F.col("end") > start).alias("open"))
    keep = F.when(F.col("open").isNotNull(), F.col("open") & F.col("boardable")).otherwise(F.col("later"))
    return trips.join(freq, "trip_id", "left").where(keep).select("trip_id", F.col("open").isNotNull().alias("is_frequency"))


def routing_trips(stop_times: DataFrame, trips: DataFrame, windows: DataFrame) -> DataFrame:
    """One row for each trip: stop times in order and frequency windows (an empty array without)."""
    times = stop_times.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("pos", "stop_id", "arr", "dep", "pickup", "drop_off"))).alias("stop_times"))
    freq = windows.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "headway"))).alias("frequency_windows"))
    none = F.array().cast("array<struct<start:long,end:long,headway:long>>")
    return trips.select("trip_id", "route_id").join(times, "trip_id").join(freq, "trip_id", "left").withColumn("frequency_windows", F.coalesce("frequency_windows", none))


def manifest_counts(stop_times: DataFrame, retained: DataFrame, windows: DataFrame) -> DataFrame:
    """One row: trips, scheduled and frequency ones, stop times, windows."""
    a = retained.agg(F.count("*").alias("trips"), F.count_if(~F.col("is_frequency")).alias("scheduled_trips"), F.count_if("is_frequency").alias("frequency_trips"))
    b = stop_times.join(retained, "trip_id", "left_semi").agg(F.count("*").alias("stop_times"))
    c = windows.join(retained, "trip_id", "left_semi").agg(F.count("*").alias("frequency_windows"))
    return a.join(b).join(c)


def concrete_trips(stop_times: DataFrame, trips: DataFrame, windows: DataFrame, scenario: Scenario) -> DataFrame:
    """(uid, route_id, pos, stop_id, arr, dep, pickup, drop_off) of scheduled trips, and of one trip for each
    departure start + k * headway before a window's end, its times shifted. Those that can't be boarded from the window's start on are dropped,
    by the last departure with boarding of the trip that they come from, before any stop time is copied."""
    own = stop_times.join(trips.select("trip_id", "route_id"), "trip_id")
    each = own.groupBy("trip_id").agg(F.min(F.when(F.col("pos") == 0, F.col("dep"))).alias("first_dep"), F.max(F.when(F.col("pickup") != 1, F.col("dep"))).alias("last_dep"))
    by_start = Window.partitionBy("trip_id").orderBy("start", "end", "headway")
    starts = windows.withColumn("idx", F.row_number().over(by_start) - 1).select("trip_id", "idx", F.explode(F.sequence("start", F.col("end") - 1, "headway")).alias("departure"))
    made = starts.join(each, "trip_id").select("trip_id", F.concat(F.lit(MARK), "idx", F.lit(":"), "departure").alias("suffix"), (F.col("departure") - F.col("first_dep")).alias("shift"), "last_dep")
    plain = each.join(windows.select("trip_id").distinct(), "trip_id", "left_anti").select("trip_id", F.lit("").alias("suffix"), F.lit(0).cast("long").alias("shift"), "last_dep")
    kept = made.unionByName(plain).where(F.col("last_dep") + F.col("shift") >= scenario.window_start).drop("last_dep")
    return own.join(kept, "trip_id").select(F.concat("trip_id", "suffix").alias("uid"), "route_id", "pos", "stop_id", (F.col("arr") + F.col("shift")).alias("arr"), (F.col("dep") + F.col("shift")).alias("dep"), "pickup", "drop_off")
