"""Locality directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachspark.checks import coordinate, duplicates, enforce, union, violation
from reachspark.functions import text
from reachspark.operators.lookup import dedup
from reachspark.schemas import LOCALITIES, LOCALITY_COLUMNS
from reachspark.sources.feed import read_table


def read_directory(spark: SparkSession, folder: str, name: str, suffix: str = ".csv") -> DataFrame:
    """A semicolon-separated directory: (row_no, postal_code, city, share, latitude, longitude), one row for each locality."""
    raw = read_table(spark, folder, name, ordinal=True, sep=";", required=LOCALITY_COLUMNS, suffix=suffix)
    typed = raw.select(F.col("ordinal").alias("row_no"), F.col("PLZ4").alias("postal_code"), F.trim("Ortschaftsname").alias("city"), text.address_share(F.col("Adressenanteil")).alias("share"), coordinate(F.col("N"), 90).alias("latitude"), coordinate(F.col("E"), 180).alias("longitude"))
    enforce(
        union(
            violation(typed, "SRC-12.postal", "row_no", "postal code is not four digits", text.postal_key(F.col("postal_code")).isNull()),
            violation(typed, "SRC-12.city", "row_no", "blank city", F.col("city") == ""),
            violation(typed, "STR-08.coordinates", "row_no", "bad coordinates", F.col("latitude").isNull() | F.col("longitude").isNull()),
        ),
        "localities",
    )
    return dedup(typed).orderBy("locality_id")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A packaged directory: a non-empty JSON array of locality objects."""
    df = spark.read.schema("localityId string, postalCode string, city string, latitude double, longitude double, publicTransportStationName string").json(path, multiLine=True, mode="FAILFAST")
    df = df.select(F.col("localityId").alias("locality_id"), F.col("postalCode").alias("postal_code"), "city", "latitude", "longitude", F.col("publicTransportStationName").alias("station_name"))
    if df.isEmpty():
        raise ValueError("no localities")
    canonical = F.col("locality_id") == text.locality_id(text.postal_key(F.col("postal_code")), text.city_key(F.col("city")))
    enforce(union(duplicates(df, ["locality_id"], "VAL-10.repeated"), violation(df, "VAL-10.id", "locality_id", "id is not canonical", ~F.coalesce(canonical, F.lit(False)))), "localities")
    return df


SCHEMA = LOCALITIES
