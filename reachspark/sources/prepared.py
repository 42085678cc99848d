"""Everything that a transit build reads, from prepared artefacts and the raw feed, checked against each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.config import Scenario
from reachspark.sources import artifacts
from reachspark.sources.feed import Feed
from reachspark.sources.localities import read_directory


@dataclass
class Prepared:
    stop_times: DataFrame
    trips: DataFrame
    frequencies: DataFrame
    stops: DataFrame
    transfers: DataFrame
    rail: DataFrame
    localities: DataFrame
    manifest: dict


def load(spark: SparkSession, routing_folder: str, stops_path: str, feed_folder: str, localities_folder: str, localities: str, scenario: Scenario) -> Prepared:
    """Prepared trips must be of this scenario and of this feed's version; rail flags and transfer rules come from the feed itself."""
    manifest = artifacts.read_trips_manifest(routing_folder)
    if manifest["service_date"] != scenario.service_date.isoformat() or manifest["window"] != [scenario.window_start, scenario.window_end]:
        raise ValueError("trips were prepared for another scenario")
    feed = Feed(spark, feed_folder, scenario)
    if manifest.get("feed_version") != feed.version:
        raise ValueError(f"trips were prepared from feed version {manifest.get('feed_version')!r}, this is {feed.version!r}")
    trips = artifacts.read_trips(spark, routing_folder, scenario)
    times = trips.select("trip_id", F.posexplode("stop_times").alias("pos", "t")).select("trip_id", "pos", "t.stop_id", "t.arr", "t.dep", "t.pickup", "t.drop_off")
    windows = trips.select("trip_id", F.explode("frequency_windows").alias("w")).select("trip_id", "w.start", "w.end", "w.headway")
    return Prepared(times, trips.select("trip_id", "route_id"), windows, artifacts.read_stops(spark, stops_path), feed.transfers, feed.rail, read_directory(spark, localities_folder, localities), manifest)
