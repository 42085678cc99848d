"""Lookups over a stream of requests. The engine's inputs are bounded files; this joins a stream with a compiled matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.plans.runtime import TravelTimes


def answered(requests: DataFrame, times: TravelTimes, mode: str) -> DataFrame:
    """requests (streaming: request_id, origin, destination, ts) with minutes: a stream-static join without state."""
    ids = times.localities.select("locality_id", "idx")
    known = requests.join(ids.select(F.col("locality_id").alias("origin"), F.col("idx").alias("origin_idx")), "origin").join(ids.select(F.col("locality_id").alias("destination"), F.col("idx").alias("dest_idx")), "destination")
    from reachspark.operators.matrix import cell

    return known.join(times.matrices[mode], "origin_idx").select("request_id", "ts", "origin", "destination", cell(F.col("row"), F.col("dest_idx")).alias("minutes"))


def demand(requests: DataFrame, delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Requests for each origin in event-time windows; later ones than the watermark are dropped."""
    return requests.withWatermark("ts", delay).groupBy(F.window("ts", window), "origin").agg(F.count("*").alias("n"))
