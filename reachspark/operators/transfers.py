"""Foot transfers: explicit rules and generated ones between platforms of a station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.checks import found, violation
from reachspark.schemas import MAX_TIME


def typed_rules(raw: DataFrame) -> DataFrame:
    """Raw text rules with a type of 0 to 5 and seconds; blank constraints are null."""
    kind, time = F.trim(F.coalesce("transfer_type", F.lit(""))), F.trim(F.coalesce("min_transfer_time", F.lit("")))
    blank = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.col(c)).alias(c)
    optional = [c for c in ("from_route_id", "to_route_id", "from_trip_id", "to_trip_id", "service_id")]
    return raw.select(
        blank("from_stop_id"), blank("to_stop_id"), F.when(kind == "", 0).when(kind.rlike("^[0-5]$"), kind.try_cast("int")).alias("transfer_type"),
        F.when(time.rlike(r"^\d{1,10}$"), time.try_cast("long")).alias("seconds"), (time != "").alias("has_time"),
        *[blank(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in optional],
    )


def rule_violations(rules: DataFrame) -> DataFrame:
    at = F.concat_ws("->", "from_stop_id", "to_stop_id")
    return found(
        rules,
        ("VAL-06.type", at, "unknown transfer type", F.col("transfer_type").isNull()),
        ("VAL-06.time", at, "bad transfer time", F.col("has_time") & (F.col("seconds").isNull() | (F.col("seconds") > MAX_TIME))),
    )


def generic_rules(rules: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """Rules of types 0 to 3 that hold between two stops in general: of active services, without trip or route."""
    for c in ("from_route_id", "to_route_id", "from_trip_id", "to_trip_id"):
        if c in rules.columns:
            rules = rules.where(F.col(c).isNull())
    if "service_id" in rules.columns:
        bound = rules.where("service_id is not null")
        rules = rules.where("service_id is null").unionByName(bound.join(services, "service_id", "left_semi").select(rules.columns) if services is not None else bound)
    return rules.where("transfer_type between 0 and 3 and from_stop_id is not null and to_stop_id is not null")


def untimed_violations(rules: DataFrame) -> DataFrame:
    """Type 2 needs a time, whether its stops are in use or not."""
    return violation(rules, "XF-01.time", F.concat_ws("->", "from_stop_id", "to_stop_id"), "a timed transfer has no time", (F.col("transfer_type") == 2) & F.col("seconds").isNull())


def explicit_edges(rules: DataFrame, stops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(allowed, forbidden) pairs of stops in use. Of rules for a pair a time wins over the default (null), the longest of several; one timed rule makes the pair
    fit for access."""
    a, b = stops.select(F.col("stop_id").alias("from_stop_id"), F.col("stop_idx").alias("from_idx")), stops.select(F.col("stop_id").alias("to_stop_id"), F.col("stop_idx").alias("to_idx"))
    pairs = rules.join(a, "from_stop_id").join(b, "to_stop_id")
    allowed = pairs.where("transfer_type <> 3").groupBy("from_idx", "to_idx").agg(F.max("seconds").alias("seconds"), F.bool_or(F.col("transfer_type") == 2).alias("access_eligible"))
    return allowed, pairs.where("transfer_type = 3").select("from_idx", "to_idx").distinct()


def contradictions(allowed: DataFrame, forbidden: DataFrame) -> DataFrame:
    return violation(allowed.join(forbidden, ["from_idx", "to_idx"]), "VAL-07.contradiction", F.concat_ws("->", "from_idx", "to_idx"), "both allowed and forbidden")


def sibling_edges(all_stops: DataFrame, stops: DataFrame) -> DataFrame:
    """Both directions between platforms in use of one station, at the default time."""
    own = all_stops.where("kind = 'STOP_OR_PLATFORM' and parent_station_id is not null").join(stops, "stop_id").select("parent_station_id", "stop_idx")
    a, b = own.withColumnRenamed("stop_idx", "from_idx"), own.withColumnRenamed("stop_idx", "to_idx")
    return a.join(b, "parent_station_id").where("from_idx <> to_idx").select("from_idx", "to_idx")


def transfer_edges(rules: DataFrame, all_stops: DataFrame, stops: DataFrame) -> DataFrame:
    """(from_idx, to_idx, seconds or null for the default, access_eligible): explicit edges, and generated ones for pairs that no rule names."""
    allowed, forbidden = explicit_edges(rules, stops)
    made = sibling_edges(all_stops, stops).join(allowed, ["from_idx", "to_idx"], "left_anti").join(forbidden, ["from_idx", "to_idx"], "left_anti")
    made = made.select("from_idx", "to_idx", F.lit(None).cast("long").alias("seconds"), F.lit(True).alias("access_eligible"))
    return allowed.unionByName(made)


def adjacency(edges: DataFrame) -> DataFrame:
    """(from_idx, walks): the edges of each stop in order of (to, seconds), the default time last."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("to_idx", F.coalesce("seconds", F.lit(MAX_TIME)).alias("at"), "access_eligible"))), lambda e: F.struct(e["to_idx"].alias("to_idx"), F.when(e["at"] != MAX_TIME, e["at"]).alias("seconds"), e["access_eligible"].alias("access_eligible")))
    return edges.groupBy("from_idx").agg(order.alias("walks"))
