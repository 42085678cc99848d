"""Which services run on the service date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.checks import duplicates, found, union, violation
from reachspark.config import Scenario
from reachspark.functions.timefn import valid_date


def weekly_services(calendar: DataFrame, scenario: Scenario) -> DataFrame:
    """Services whose period holds the date and whose weekday flag is 1; dates compare as text."""
    d = scenario.gtfs_date
    return calendar.where((F.col("start_date") <= d) & (F.col("end_date") >= d) & (F.col(scenario.weekday) == 1)).select("service_id")


def active_services(calendar: DataFrame, exceptions: DataFrame, scenario: Scenario) -> DataFrame:
    """Weekly services and added ones, without removed ones. An added service needn't be in the calendar."""
    today = exceptions.where(F.col("date") == scenario.gtfs_date)
    added = today.where("exception_type = 1").select("service_id")
    removed = today.where("exception_type = 2").select("service_id")
    return weekly_services(calendar, scenario).unionByName(added).distinct().join(removed, "service_id", "left_anti")


def calendar_violations(calendar: DataFrame, exceptions: DataFrame, start: str, end: str) -> DataFrame:
    """Dates that are none, periods reversed, exceptions outside the feed's period or repeated, over the whole feed."""
    at = F.concat_ws("/", "service_id", "date")
    return union(
        duplicates(calendar, ["service_id"], "SRC-04.repeated"),
        violation(calendar, "SRC-04.date", "service_id", "period is not two dates in order", ~valid_date(F.col("start_date")) | ~valid_date(F.col("end_date")) | (F.col("start_date") > F.col("end_date"))),
        found(
            exceptions,
            ("SRC-05.date", at, "not a date", ~valid_date(F.col("date"))),
            ("SRC-05.range", at, "outside the feed's period", ~F.col("date").between(start, end)),
            ("SRC-05.type", at, "exception type is not 1 or 2", ~F.coalesce(F.col("exception_type").isin(1, 2), F.lit(False))),
        ),
        duplicates(exceptions, ["service_id", "date"], "SRC-05.repeated"),
    )


def feed_range_ok(start: str, end: str, scenario: Scenario) -> bool:
    return start <= end and start <= scenario.gtfs_date <= end


def active_trips(trips: DataFrame, services: DataFrame) -> DataFrame:
    return trips.join(services, "service_id", "left_semi")
