"""Prepared artefacts: trips as JSON lines, stops and manifests as JSON, matrices as bytes."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.checks import duplicates, enforce, union, violation
from reachspark.config import Scenario
from reachspark.operators.matrix import write_atomic
from reachspark.operators.stops import stop_violations
from reachspark.schemas import ROUTING_TRIPS, STOPS
from reachspark.sources import bytefiles
from reachspark.sources.bytefiles import read_matrix  # noqa: F401


def write_trips(routing_trips: DataFrame, folder: str, scenario: Scenario, order: str = "trip_id", feed_version: str | None = None) -> dict:
    """trips.ndjson in the given order (a column whose values are all different) and its manifest (counts and SHA-256), the manifest last: tasks write ranges of trips, see bytefiles.publish."""
    n, w = F.size("stop_times"), F.size("frequency_windows")
    counts = routing_trips.agg(F.count("*").alias("trips"), F.count_if(w == 0).alias("scheduled"), F.count_if(w > 0).alias("frequency"), F.coalesce(F.sum(n), F.lit(0)).alias("stop_times"), F.coalesce(F.sum(w), F.lit(0)).alias("windows")).first().asDict()
    line = F.concat(F.to_json(F.struct("trip_id", "route_id", "stop_times", "frequency_windows")), F.lit("\n")).cast("binary")
    manifest = {"service_date": scenario.service_date.isoformat(), "window": [scenario.window_start, scenario.window_end], "feed_version": feed_version, **counts}
    digest = bytefiles.publish(routing_trips.select(F.col(order).alias("key"), line.alias("data")), f"{folder}/trips.ndjson", f"{folder}/manifest.json", manifest, counts["trips"])
    return {**manifest, "sha256": digest}


# Fields of a trips manifest.
TRIPS_MANIFEST = {"service_date", "window", "sha256", "feed_version", "trips", "scheduled", "frequency", "stop_times", "windows"}


def read_trips_manifest(folder: str) -> dict:
    """The manifest of trips, with exactly its fields, counts from 0 and a window in order."""
    out = read_manifest(f"{folder}/manifest.json", TRIPS_MANIFEST)
    count = lambda v: isinstance(v, int) and not isinstance(v, bool) and v >= 0
    bad = [k for k in ("trips", "scheduled", "frequency", "stop_times", "windows") if not count(out[k])]
    if bad or len(out["window"]) != 2 or not all(map(count, out["window"])) or out["window"][0] >= out["window"][1] or out["scheduled"] + out["frequency"] != out["trips"] or len(out["sha256"]) != 64:
        raise ValueError(f"trips manifest: bad {', '.join(bad) or 'window, digest or counts'}")
    return out


def read_trips(spark: SparkSession, folder: str, scenario: Scenario | None = None) -> DataFrame:
    """Trips whose digest and counts are the manifest's; a blank line, a broken one or a repeated trip is an error."""
    manifest = read_trips_manifest(folder)
    if scenario and manifest["service_date"] != scenario.service_date.isoformat():
        raise ValueError("prepared for another service date")
    digest = hashlib.sha256()
    with open(f"{folder}/trips.ndjson", "rb") as f:
        for line in f:
            if not line.strip():
                raise ValueError("blank line in trips")
            digest.update(line)
    if digest.hexdigest() != manifest["sha256"]:
        raise ValueError("trips differ from their manifest")
    df = spark.read.schema(ROUTING_TRIPS.replace("`", "")).json(f"{folder}/trips.ndjson", mode="FAILFAST")
    enforce(union(duplicates(df, ["trip_id"], "SRC-13.repeated"), violation(df, "SRC-13.id", "trip_id", "blank trip or route", F.coalesce(F.col("trip_id"), F.lit("")).eqNullSafe("") | F.coalesce(F.col("route_id"), F.lit("")).eqNullSafe(""))), "trips")
    got = df.agg(F.count("*").alias("trips"), F.count_if(F.size("frequency_windows") == 0).alias("scheduled"), F.count_if(F.size("frequency_windows") > 0).alias("frequency"), F.sum(F.size("stop_times")).alias("stop_times"), F.sum(F.size("frequency_windows")).alias("windows")).first().asDict()
    if any((got[k] or 0) != manifest[k] for k in got):
        raise ValueError("counts differ from the manifest")
    return df


def write_stops(stops: DataFrame, path: str) -> None:
    rows = [json.loads(r[0]) for r in stops.orderBy("stop_id").select(F.to_json(F.struct(*stops.columns))).toLocalIterator()]
    write_atomic(path, json.dumps(rows))


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    """Stops of a JSON array; ids, kinds and coordinates are checked as those of a feed are."""
    df = spark.read.schema(STOPS).json(path, multiLine=True, mode="FAILFAST")
    enforce(stop_violations(df), "stops")
    return df


def read_manifest(path: str, keys: set[str]) -> dict:
    """A manifest with exactly these keys."""
    with open(path) as f:
        out = json.load(f)
    if set(out) != keys:
        raise ValueError(f"manifest keys differ: {sorted(set(out) ^ keys)}")
    return out


def package(localities: DataFrame, station_names: list[str | None], matrices: dict[str, str], folder: str) -> None:
    """Localities in order of id with station names by position, and the matrices beside them."""
    rows = localities.select("locality_id", "postal_code", "city", "latitude", "longitude").orderBy("locality_id").collect()
    if len(rows) != len(station_names):
        raise ValueError("a station name for each locality is needed")
    os.makedirs(folder, exist_ok=True)
    out = []
    for r, name in zip(rows, station_names):
        item = {"localityId": r.locality_id, "postalCode": r.postal_code, "city": r.city, "latitude": r.latitude, "longitude": r.longitude}
        out.append(item | ({"publicTransportStationName": name} if name else {}))
    for mode, path in matrices.items():
        with open(path, "rb") as f:
            data = f.read()
        if len(data) != len(rows) ** 2:
            raise ValueError(f"{mode}: matrix and localities differ")
        write_atomic(f"{folder}/{mode}.bin", data)
    write_atomic(f"{folder}/localities.json", json.dumps(out, ensure_ascii=False))


def inspect_network(folder: str, name: str, required: tuple[str, ...] = ("hsgr", "edges", "geometry", "properties")) -> dict:
    """Files name.* of a prepared road network: how many and how large; none empty, required ones there."""
    files = {f: os.path.getsize(f"{folder}/{f}") for f in sorted(os.listdir(folder)) if f == name or f.startswith(name + ".")}
    empty = [f for f, n in files.items() if n == 0]
    lacking = [r for r in required if f"{name}.{r}" not in files]
    if empty or lacking:
        raise ValueError(f"road network: empty {empty}, missing {lacking}")
    return {"files": len(files), "bytes": sum(files.values())}
