"""Queries over faulty feeds: what the checks find in them, directories read from files, walks, days and labels; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachspark.functions import text, timefn
from reachspark.operators import foot, matrix, patterns, stops, transfers, trips
from reachspark.plans.cut import cut
from reachspark.plans.products import _feed, _new, _write
from reachspark.plans.registry import _C, _EDGES, _PL, _ROAD, ORIGIN, _concrete, _feet
from reachspark.plans.testviews import Views
from reachspark.schemas import FEED, MAX_TIME
from reachspark.sources.localities import read_directory

#: Files of the faulty feed: the view that holds each, and the columns that its file takes from the view under another name or as a fixed text.
_FAULTY = {
    "calendar": ("bad_calendar", {d: "'0'" for d in ("tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")}),
    "calendar_dates": ("bad_exceptions", {}),
    "routes": ("bad_routes", {}),
    "trips": ("bad_trips", {}),
    "stops": ("bad_stops", {"stop_lat": "latitude", "stop_lon": "longitude"}),
    "stop_times": ("bad_stop_times", {}),
    "frequencies": ("bad_frequencies", {}),
    "transfers": ("bad_transfers", {}),
}


def val00_feed_violations(v: Views) -> DataFrame:
    """Every violation that the checks of a whole feed find, in a feed written as files with faults in each of them: calendar and exceptions (SRC-04, SRC-05), trips and routes (SRC-06, SRC-07), stops and
    parents (SRC-08, FLT-05, STR-08, VAL-03, JOIN-05), stop times (VAL-01, VAL-02, JOIN-04), references (VAL-04), frequency windows (VAL-05), transfer rules (SRC-11, VAL-06, XF-01)."""
    files = {name: (",".join(FEED[name]), v.view(f"v_{view}").select("key", F.concat_ws(",", *[F.expr(other.get(c, c)) for c in FEED[name]]).alias("line"))) for name, (view, other) in _FAULTY.items()}
    return _feed(v, files).violations().select("rule", "key")


def val07_contradictions(v: Views) -> DataFrame:
    """Pairs of stops that some rule allows and another forbids, where every third rule is also there as a prohibition."""
    k = F.substring("from_stop_id", 2, 8).cast("long")
    rules = v.transfers.unionByName(v.transfers.where(k % 3 == 0).withColumn("transfer_type", F.lit(3)))
    return transfers.contradictions(*transfers.explicit_edges(transfers.generic_rules(rules), patterns.dense_stops(_concrete(v)))).select("rule", "key")


def val08_shared_stops(v: Views) -> DataFrame:
    """Stops of two places, where each station is there again with its first two stops."""
    own = stops.places(v.stops)
    again = own.where(F.size("stop_ids") > 1).withColumn("place_id", F.concat(F.lit("X"), "place_id")).withColumn("stop_ids", F.slice("stop_ids", 1, 2))
    return stops.place_violations(own.unionByName(again)).select("rule", "key")


def src12_directory(v: Views) -> DataFrame:
    """A directory of localities written as a file with semicolons and read back: shares with and without a percent sign, blank or no numbers; codes and cities with spaces around them."""
    share = F.col("share").cast("string")
    n = F.col("row_no") % 5
    shown = F.when(n == 1, "").when(n == 2, "n/a").when(n == 3, F.concat(share, F.lit("%"))).when(n == 4, F.concat(F.lit(" "), share, F.lit(" % "))).otherwise(share)
    spaced = lambda c: F.when(F.col("row_no") % 4 == 1, F.concat(F.lit("  "), c, F.lit(" "))).otherwise(F.col(c))
    lines = v.localities.select(F.lpad(F.col("row_no").cast("string"), 12, "0").alias("key"), F.concat_ws(";", spaced("city"), spaced("postal_code"), F.col("longitude").cast("string"), F.col("latitude").cast("string"), shown).alias("line"))
    at = _new(v, "directory")
    _write(v, at, "localities", "Ortschaftsname;PLZ4;E;N;Adressenanteil", lines)
    return read_directory(v._spark, at, "localities", ".txt").select("locality_id", "row_no", "share", "latitude", "longitude")


def agg03_trip_windows(v: Views) -> DataFrame:
    """Frequency windows of each trip in order, where every third trip has a second window before its first one."""
    early = v.frequencies.where((F.substring("trip_id", 2, 8).cast("long") / 50).cast("long") % 3 == 0).withColumn("end", F.col("start") - 60).withColumn("start", F.col("start") - 3600)
    t = trips.routing_trips(v.stop_times_a.drop("route_id"), v.trips, v.frequencies.unionByName(early))
    shown = F.transform("frequency_windows", lambda w: F.concat_ws("-", w["start"].cast("string"), w["end"].cast("string"), w["headway"].cast("string")))
    return t.select("trip_id", F.array_join(shown, " ").alias("windows"))


def srt05_walks(v: Views) -> DataFrame:
    """The walks of each stop in order of (stop, seconds), default times last."""
    shown = F.transform("walks", lambda w: F.concat_ws(":", w["to_idx"].cast("string"), F.coalesce(w["seconds"].cast("string"), F.lit("-")), w["access_eligible"].cast("string")))
    return foot.adjacency(_feet(v, cut(patterns.dense_stops(_concrete(v))))).select("from_idx", F.array_join(shown, " ").alias("walks"))


def dat03_days(v: Views) -> DataFrame:
    """Dates of orders in the feed's notation with their weekdays (0 is Sunday), and how many of the texts of year, month and any number from 00 to 32 name a day."""
    day = F.to_date("o_orderdate")
    loose = F.concat(F.date_format(day, "yyyyMM"), F.lpad((F.col("o_orderkey") % 33).cast("string"), 2, "0"))
    return v.view("orders").select(timefn.gtfs_date(day).alias("date"), timefn.weekday_index(day).alias("weekday"), timefn.valid_date(loose).alias("ok")).groupBy("date", "weekday").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_valid"))


def str06_labels(v: Views) -> DataFrame:
    """What one origin reaches by road within the horizon, as labels of places and durations."""
    row = matrix.road_matrix(v.road_seconds).where((F.col("origin") == ORIGIN) & F.col("minutes").isNotNull())
    return row.join(v.localities, row.destination == v.localities.row_no).select("destination", text.locality_label(F.col("postal_code"), F.col("city")).alias("label"), text.duration_label(F.col("minutes")).alias("duration"))


_DAY = "20260907"
_SPAN = "NOT {c} BETWEEN '20251214' AND '20261212'"


def _is_day(c: str) -> str:
    return f"(regexp_full_match({c}, '[0-9]{{8}}') AND try_strptime({c}, '%Y%m%d') IS NOT NULL)"


def _secs(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+:[0-5][0-9]:[0-5][0-9]') THEN CAST(split_part({c}, ':', 1) AS BIGINT) * 3600 + CAST(split_part({c}, ':', 2) AS BIGINT) * 60 + CAST(split_part({c}, ':', 3) AS BIGINT) END"


def _whole(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,18}}') THEN CAST({c} AS BIGINT) END"


_FAULTS = f"""WITH act AS (SELECT service_id FROM v_bad_calendar WHERE monday = '1' AND start_date <= '{_DAY}' AND end_date >= '{_DAY}' UNION SELECT service_id FROM v_bad_exceptions WHERE date = '{_DAY}' AND exception_type = '1'),
 atrip AS MATERIALIZED (SELECT DISTINCT trip_id FROM v_bad_trips WHERE service_id IN (SELECT service_id FROM act) AND service_id NOT IN (SELECT service_id FROM v_bad_exceptions WHERE date = '{_DAY}' AND exception_type = '2')),
 st AS MATERIALIZED (SELECT trip_id, pos, stop_id, {_whole("stop_sequence")} AS seq, {_secs("arrival_time")} AS arr, {_secs("departure_time")} AS dep, pickup_type, drop_off_type FROM v_bad_stop_times WHERE trip_id IN (SELECT trip_id FROM atrip)),
 seen AS (SELECT *, concat_ws('/', trip_id, CAST(seq AS STRING)) AS k, lag(seq) OVER (PARTITION BY trip_id ORDER BY pos) AS prev_seq, lag(dep) OVER (PARTITION BY trip_id ORDER BY seq NULLS FIRST, pos) AS prev_dep, lag(seq) OVER (PARTITION BY trip_id ORDER BY seq NULLS FIRST, pos) AS same_seq FROM st),
 stp AS MATERIALIZED (SELECT stop_id, CASE location_type WHEN '' THEN 'P' WHEN '0' THEN 'P' WHEN '1' THEN 'S' END AS kind, nullif(parent_station, '') AS parent, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon FROM v_bad_stops WHERE location_type NOT IN ('2', '3', '4')),
 par AS (SELECT s.stop_id, p.kind AS pkind FROM stp s LEFT JOIN stp p ON p.stop_id = s.parent WHERE s.parent IS NOT NULL),
 fq AS (SELECT *, concat_ws('/', trip_id, CAST(s AS STRING)) AS k, lag(e) OVER (PARTITION BY trip_id ORDER BY s NULLS FIRST, e NULLS FIRST, h NULLS FIRST) AS prev_end FROM (SELECT trip_id, {_secs("start_time")} AS s, {_secs("end_time")} AS e, {_whole("headway_secs")} AS h FROM v_bad_frequencies WHERE trip_id IN (SELECT trip_id FROM atrip)) z),
 tf AS (SELECT concat_ws('->', nullif(from_stop_id, ''), to_stop_id) AS k, from_stop_id, CASE WHEN transfer_type = '' THEN 0 WHEN regexp_full_match(transfer_type, '[0-5]') THEN CAST(transfer_type AS INT) END AS t, CASE WHEN regexp_full_match(min_transfer_time, '[0-9]{{1,10}}') THEN CAST(min_transfer_time AS BIGINT) END AS s, min_transfer_time FROM v_bad_transfers)
 SELECT 'SRC-04.repeated' AS rule, service_id AS key FROM v_bad_calendar GROUP BY service_id HAVING count(*) > 1
 UNION ALL SELECT 'SRC-04.date', service_id FROM v_bad_calendar WHERE NOT {_is_day("start_date")} OR NOT {_is_day("end_date")} OR start_date > end_date
 UNION ALL SELECT 'SRC-04.flag', service_id FROM v_bad_calendar WHERE monday NOT IN ('0', '1')
 UNION ALL SELECT 'SRC-05.date', service_id || '/' || date FROM v_bad_exceptions WHERE NOT {_is_day("date")}
 UNION ALL SELECT 'SRC-05.range', service_id || '/' || date FROM v_bad_exceptions WHERE {_SPAN.format(c="date")}
 UNION ALL SELECT 'SRC-05.type', service_id || '/' || date FROM v_bad_exceptions WHERE exception_type NOT IN ('1', '2')
 UNION ALL SELECT 'SRC-05.repeated', service_id || '/' || date FROM v_bad_exceptions GROUP BY service_id, date HAVING count(*) > 1
 UNION ALL SELECT 'SRC-07.type', route_id FROM v_bad_routes WHERE NOT regexp_full_match(route_type, '[0-9]+')
 UNION ALL SELECT 'SRC-07.repeated', route_id FROM v_bad_routes GROUP BY route_id HAVING count(*) > 1
 UNION ALL SELECT 'SRC-06.repeated', trip_id FROM v_bad_trips GROUP BY trip_id HAVING count(*) > 1
 UNION ALL SELECT 'SRC-08.repeated', stop_id FROM stp GROUP BY stop_id HAVING count(*) > 1
 UNION ALL SELECT 'SRC-08.id', stop_id FROM stp WHERE stop_id = ''
 UNION ALL SELECT 'FLT-05.kind', stop_id FROM stp WHERE kind IS NULL
 UNION ALL SELECT 'STR-08.coordinates', stop_id FROM stp WHERE NOT coalesce(abs(lat) <= 90 AND abs(lon) <= 180, false)
 UNION ALL SELECT 'VAL-03.station', stop_id FROM stp WHERE kind = 'S' AND parent IS NOT NULL
 UNION ALL SELECT 'VAL-03.missing', stop_id FROM par WHERE pkind IS NULL
 UNION ALL SELECT 'VAL-03.kind', stop_id FROM par WHERE pkind <> 'S'
 UNION ALL SELECT 'VAL-02.rows', trip_id FROM st GROUP BY trip_id HAVING count(*) < 2
 UNION ALL SELECT 'VAL-02.stop', k FROM seen WHERE stop_id = ''
 UNION ALL SELECT 'VAL-02.unknown', k FROM seen WHERE stop_id <> '' AND stop_id NOT IN (SELECT stop_id FROM stp WHERE kind IS NOT NULL)
 UNION ALL SELECT 'VAL-02.sequence', trip_id FROM seen WHERE seq IS NULL
 UNION ALL SELECT 'VAL-02.repeated', k FROM seen WHERE seq = same_seq
 UNION ALL SELECT 'VAL-02.falling', k FROM seen WHERE seq < prev_seq
 UNION ALL SELECT 'VAL-02.blank', k FROM seen WHERE arr IS NULL OR dep IS NULL
 UNION ALL SELECT 'VAL-02.dwell', k FROM seen WHERE arr > dep
 UNION ALL SELECT 'VAL-02.backwards', k FROM seen WHERE arr < prev_dep
 UNION ALL SELECT 'VAL-02.kind', trip_id FROM st WHERE pickup_type NOT IN ('', '0', '1', '2', '3') OR drop_off_type NOT IN ('', '0', '1', '2', '3')
 UNION ALL SELECT DISTINCT 'VAL-04.stop_times', trip_id FROM v_bad_stop_times WHERE trip_id NOT IN (SELECT trip_id FROM v_bad_trips)
 UNION ALL SELECT DISTINCT 'VAL-04.frequencies', trip_id FROM v_bad_frequencies WHERE trip_id NOT IN (SELECT trip_id FROM v_bad_trips)
 UNION ALL SELECT 'VAL-04.no_stop_times', trip_id FROM atrip WHERE trip_id NOT IN (SELECT trip_id FROM st)
 UNION ALL SELECT 'VAL-05.range', k FROM fq WHERE coalesce(s >= e, true)
 UNION ALL SELECT 'VAL-05.headway', k FROM fq WHERE coalesce(h < 1, true)
 UNION ALL SELECT 'VAL-05.overlap', k FROM fq WHERE prev_end > s
 UNION ALL SELECT 'VAL-06.type', k FROM tf WHERE t IS NULL
 UNION ALL SELECT 'VAL-06.time', k FROM tf WHERE min_transfer_time <> '' AND (s IS NULL OR s > {MAX_TIME})
 UNION ALL SELECT 'XF-01.time', k FROM tf WHERE t = 2 AND s IS NULL AND from_stop_id <> ''"""

SQL = {
    "val00_feed_violations": _FAULTS,
    "val07_contradictions": f"WITH {_C}, tr AS (SELECT *, CAST(substr(from_stop_id, 2, 8) AS BIGINT) AS k FROM v_transfers), al AS (SELECT from_stop_id, to_stop_id, transfer_type FROM tr UNION ALL SELECT from_stop_id, to_stop_id, 3 FROM tr WHERE k % 3 = 0), pr AS (SELECT a.stop_idx AS f, b.stop_idx AS t, transfer_type FROM al JOIN dense a ON a.stop_id = from_stop_id JOIN dense b ON b.stop_id = to_stop_id) SELECT 'VAL-07.contradiction' AS rule, f || '->' || t AS key FROM pr GROUP BY f, t HAVING bool_or(transfer_type = 3) AND bool_or(transfer_type <> 3)",
    "val08_shared_stops": f"WITH {_PL} SELECT 'VAL-08.shared' AS rule, unnest(string_split(stop_list, ',')[1:2]) AS key FROM pl WHERE contains(stop_list, ',')",
    "src12_directory": """WITH f AS (SELECT row_no, postal_code || ':' || lower(city) AS locality_id, CASE WHEN row_no % 5 NOT IN (1, 2) THEN share END AS share, latitude, longitude, 1 + row_number() OVER (ORDER BY row_no) AS record FROM v_localities)
     SELECT locality_id, record AS row_no, share, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY locality_id ORDER BY share DESC NULLS LAST, record) AS rn FROM f) WHERE rn = 1""",
    "agg03_trip_windows": """WITH w AS (SELECT trip_id, start AS s, "end" AS e, headway FROM v_frequencies UNION ALL SELECT trip_id, start - 3600, start - 60, headway FROM v_frequencies WHERE CAST(floor(CAST(substr(trip_id, 2, 8) AS BIGINT) / 50) AS BIGINT) % 3 = 0)
     SELECT trip_id, coalesce(string_agg(s || '-' || e || '-' || headway, ' ' ORDER BY s, e, headway), '') AS windows FROM v_trips LEFT JOIN w USING (trip_id) GROUP BY 1""",
    "srt05_walks": f"WITH {_C}, {_EDGES} SELECT from_idx, string_agg(to_idx || ':' || coalesce(CAST(seconds AS STRING), '-') || ':' || access_eligible, ' ' ORDER BY to_idx, coalesce(seconds, {MAX_TIME})) AS walks FROM edges GROUP BY 1",
    "dat03_days": "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders) SELECT strftime(d, '%Y%m%d') AS date, CAST(dayofweek(d) AS INT) AS weekday, count(*) AS n, count(*) FILTER (WHERE try_strptime(strftime(d, '%Y%m') || lpad(CAST(o_orderkey % 33 AS STRING), 2, '0'), '%Y%m%d') IS NOT NULL) AS n_valid FROM o GROUP BY 1, 2",
    "str06_labels": f"WITH {_ROAD} SELECT destination, postal_code || ' ' || city AS label, CASE WHEN minutes < 60 THEN minutes || ' min' ELSE (minutes // 60) || ' h ' || lpad(CAST(minutes % 60 AS STRING), 2, '0') || ' min' END AS duration FROM road JOIN v_localities ON row_no = destination WHERE origin = {ORIGIN} AND minutes IS NOT NULL",
}

OVER_VIEWS = [val00_feed_violations, val07_contradictions, val08_shared_stops, src12_directory, agg03_trip_windows, srt05_walks, dat03_days, str06_labels]
