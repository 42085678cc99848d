"""Timetable feed files as DataFrames, and the checks of a whole feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachspark.checks import duplicates, enforce, integer, union, violation
from reachspark.config import Scenario
from reachspark.functions.timefn import seconds, valid_date
from reachspark.operators import calendar, stops, transfers, trips
from reachspark.plans.cut import cut
from reachspark.schemas import FEED, FEED_OPTIONAL, WEEKDAYS
from reachspark.sources.records import HeaderError, read_records  # noqa: F401


def read_table(spark: SparkSession, folder: str, name: str, ordinal: bool = False, sep: str = ",", required: list[str] | None = None, suffix: str = ".txt") -> DataFrame:
    """A file's required columns and the optional ones that it has, as text; further ones are ignored. ordinal: adds the record's number in the file, gapless, the header being 1."""
    df = read_records(spark, f"{folder}/{name}{suffix}", FEED[name] if required is None else required, FEED_OPTIONAL.get(name, []), sep)
    return df.withColumnRenamed("row", "ordinal") if ordinal else df.drop("row")


def present(name: str):
    """An identifier that isn't blank; identifiers are never trimmed or parsed."""
    return F.when(F.trim(name) != "", F.col(name))


def contiguity_violations(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips (trip_id) whose rows in stop_times (ordinal, trip_id; all trips of the file) are not together.

    Records are numbered without gaps, so a trip's rows are together exactly if its numbers span as many records as it has: one partial aggregation, no order over the file."""
    return span_violations(spans(stop_times), trips)


def spans(stop_times: DataFrame) -> DataFrame:
    """(trip_id, first, last, n): of each trip its first and last place in the file, and its rows."""
    return stop_times.groupBy("trip_id").agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.count("*").alias("n"))


def span_violations(spans_: DataFrame, trips: DataFrame) -> DataFrame:
    return violation(spans_.where("last - first + 1 <> n").join(trips.select("trip_id"), "trip_id", "left_semi"), "SRC-09.contiguity", "trip_id", "its rows are not together")


class Feed:
    """A feed folder for one scenario. Properties are lazy DataFrames; check() raises with the first faults of the whole feed."""

    def __init__(self, spark: SparkSession, folder: str, scenario: Scenario):
        self.spark, self.folder, self.scenario = spark, folder, scenario
        self._read: dict[str, DataFrame] = {}
        self._kept: set[str] = set()
        info = read_table(spark, folder, "feed_info").take(2)
        if len(info) != 1:
            raise ValueError("feed_info must have one row")
        row = info[0].asDict()
        self.start, self.end, self.version = row["feed_start_date"], row["feed_end_date"], (row.get("feed_version") if (row.get("feed_version") or "").strip() else None)
        if not calendar.feed_range_ok(self.start, self.end, scenario):
            raise ValueError(f"{scenario.gtfs_date} is outside the feed's period {self.start} to {self.end}")

    def _raw(self, name: str, ordinal: bool = False) -> DataFrame:
        """A file as text. Its header and the quotes of its splits are looked at once, and plans that read it twice can share its shuffles."""
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.folder, name, ordinal=True)
        return self._read[name] if ordinal else self._read[name].drop("ordinal")

    @property
    def calendar(self) -> DataFrame:
        return self._raw("calendar").select("service_id", *[F.when(F.col(d).isin("0", "1"), F.col(d).cast("int")).alias(d) for d in WEEKDAYS], "start_date", "end_date")

    @property
    def calendar_dates(self) -> DataFrame:
        return self._raw("calendar_dates").select("service_id", "date", F.when(F.col("exception_type").isin("1", "2"), F.col("exception_type").cast("int")).alias("exception_type"))

    @property
    def routes(self) -> DataFrame:
        return self._raw("routes").select("route_id", integer(F.col("route_type")).alias("route_type"))

    @property
    def trips(self) -> DataFrame:
        """Trips of active services."""
        return calendar.active_trips(self._raw("trips"), calendar.active_services(self.calendar, self.calendar_dates, self.scenario))

    @property
    def stops(self) -> DataFrame:
        return stops.typed_stops(self._raw("stops"))

    @property
    def raw_stop_times(self) -> DataFrame:
        """Stop times of active trips, typed, with their place in the file; blank pickup and drop-off types are 0."""
        kind = lambda c: F.when(F.col(c) == "", 0).when(F.col(c).isin("0", "1", "2", "3"), F.col(c).try_cast("int")).alias(c)
        st = self._raw("stop_times", ordinal=True).join(self.trips.select("trip_id"), "trip_id", "left_semi")
        return st.select("trip_id", "ordinal", "stop_id", integer(F.col("stop_sequence")).alias("stop_sequence"), seconds(F.col("arrival_time")).alias("arr"), seconds(F.col("departure_time")).alias("dep"), kind("pickup_type"), kind("drop_off_type"))

    @property
    def stop_times(self) -> DataFrame:
        """(trip_id, pos, stop_id, arr, dep, pickup, drop_off), positions from 0 in order of stop_sequence."""
        order = Window.partitionBy("trip_id").orderBy("stop_sequence")
        return self.raw_stop_times.select("trip_id", (F.row_number().over(order) - 1).alias("pos"), "stop_id", "arr", "dep", F.col("pickup_type").alias("pickup"), F.col("drop_off_type").alias("drop_off"))

    @property
    def frequencies(self) -> DataFrame:
        """(trip_id, start, end, headway) of active trips; exact_times doesn't change anything."""
        f = self._raw("frequencies").join(self.trips.select("trip_id"), "trip_id", "left_semi")
        return f.select("trip_id", seconds(F.col("start_time")).alias("start"), seconds(F.col("end_time")).alias("end"), integer(F.col("headway_secs")).alias("headway"))

    @property
    def transfers(self) -> DataFrame:
        """Rules that hold in general between two stops."""
        rules = transfers.typed_rules(self._raw("transfers"))
        return transfers.generic_rules(rules, calendar.active_services(self.calendar, self.calendar_dates, self.scenario))

    @property
    def rail(self) -> DataFrame:
        return trips.rail_routes(self.routes)

    def contiguity_violations(self) -> DataFrame:
        """Active trips whose rows come back after another trip's rows, whatever that trip's service."""
        return span_violations(self._spans, self.trips)

    @property
    def _spans(self) -> DataFrame:
        return spans(self._raw("stop_times", ordinal=True))

    def keep(self) -> Feed:
        """Parses every file once: its records lie as a table in the shared folder from then on, and whatever is asked next reads only the columns it needs."""
        for name in FEED:
            if name != "feed_info" and name not in self._kept:
                self._read[name] = cut(self._raw(name, ordinal=True))
                self._kept.add(name)
        return self

    def violations(self) -> DataFrame:
        from reachspark.checks import frequency_violations, missing, stop_time_violations

        self.keep()
        # of stop times one pass judges the rows and one counts them by trip; all that is asked of trips as such is asked of those counts
        raw_trips, st, cal, in_file = self._raw("trips"), self.raw_stop_times, self.calendar, self._spans
        flags = violation(cal, "SRC-04.flag", "service_id", "weekday flag is not 0 or 1", F.lit(False) if not WEEKDAYS else F.greatest(*[F.col(d).isNull().cast("int") for d in WEEKDAYS]) == 1)
        rules = transfers.typed_rules(self._raw("transfers"))
        return union(
            calendar.calendar_violations(cal, self.calendar_dates, self.start, self.end),
            flags,
            violation(self.routes, "SRC-07.type", "route_id", "route type is not a whole number", F.col("route_type").isNull()),
            duplicates(self.routes, ["route_id"], "SRC-07.repeated"),
            duplicates(raw_trips, ["trip_id"], "SRC-06.repeated"),
            stops.stop_violations(self.stops),
            stop_time_violations(st, self.stops.where("kind is not null")),
            missing(in_file, raw_trips, "trip_id", "VAL-04.stop_times"),
            missing(self._raw("frequencies"), raw_trips, "trip_id", "VAL-04.frequencies"),
            missing(self.trips, in_file, "trip_id", "VAL-04.no_stop_times"),
            frequency_violations(self.frequencies),
            span_violations(in_file, self.trips),
            transfers.rule_violations(rules),
            transfers.untimed_violations(self.transfers),
        )

    def check(self) -> None:
        enforce(self.violations(), "feed")


def date_faults(df: DataFrame, column: str) -> DataFrame:
    return df.where(~valid_date(F.col(column)))
