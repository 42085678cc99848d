"""Reachability as hexagons and GeoJSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.config import HEX_DIAMETER_M
from reachspark.functions import geo


def hex_minutes(reachable: DataFrame, diameter_m: float = HEX_DIAMETER_M) -> DataFrame:
    """(q, r, minutes): least travel time in each cell. reachable: (latitude, longitude, minutes)."""
    cell = geo.hex_cell(F.col("latitude"), F.col("longitude"), diameter_m)
    return reachable.select(cell.alias("c"), "minutes").groupBy("c.q", "c.r").agg(F.min("minutes").alias("minutes"))


def hex_features(hexes: DataFrame, diameter_m: float = HEX_DIAMETER_M, scale: float = 1.0) -> DataFrame:
    """(id, q, r, minutes, ring): closed rings of seven [lon, lat] points, drawn smaller by scale; cells themselves don't change."""
    corners = geo.shrink(geo.hex_corners(F.col("q"), F.col("r"), diameter_m), scale)
    return hexes.select(geo.hex_id(F.col("q"), F.col("r")).alias("id"), "q", "r", "minutes", geo.ring(corners).alias("ring"))


def feature_json(features: DataFrame) -> DataFrame:
    """(q, r, feature): one GeoJSON feature a cell, as text."""
    return features.select("q", "r", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("id"), F.struct(F.col("minutes").alias("travelMinutes")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates")).alias("geometry"))).alias("feature"))


def bounds(features: DataFrame, origin_lon: float | None = None, origin_lat: float | None = None) -> DataFrame:
    """One row: least and largest longitude and latitude over all points and the origin."""
    p = features.select(F.explode("ring").alias("p"))
    out = p.agg(F.min(F.col("p")[0]).alias("min_lon"), F.min(F.col("p")[1]).alias("min_lat"), F.max(F.col("p")[0]).alias("max_lon"), F.max(F.col("p")[1]).alias("max_lat"))
    if origin_lon is None:
        return out
    return out.select(F.least("min_lon", F.lit(origin_lon)).alias("min_lon"), F.least("min_lat", F.lit(origin_lat)).alias("min_lat"), F.greatest("max_lon", F.lit(origin_lon)).alias("max_lon"), F.greatest("max_lat", F.lit(origin_lat)).alias("max_lat"))


def feature_collection(features: DataFrame) -> str:
    """GeoJSON of one origin's cells in order of (q, r): at most as many as a country has cells."""
    own = [json.loads(r["feature"]) for r in feature_json(features).orderBy("q", "r").toLocalIterator()]
    return json.dumps({"type": "FeatureCollection", "features": own}, separators=(",", ":"))


def visible(hexes: DataFrame, max_minutes: int) -> int:
    return hexes.where(F.col("minutes") <= max_minutes).count()
