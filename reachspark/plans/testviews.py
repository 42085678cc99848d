"""Timetable inputs derived from the driver's tables by whole-number arithmetic, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "supplier", "nation", "orders")
LAT = "46 + CAST(({k} * 7919) % 20000 AS DOUBLE) / 10000"
LON = "6 + CAST(({k} * 104729) % 40000 AS DOUBLE) / 10000"
NS = "(SELECT count(*) FROM supplier)"
NR = "(SELECT CAST(floor(count(*) / 2) AS BIGINT) FROM supplier)"
SERVICE_DATE = "20260907"


def _coords(k: str) -> str:
    return f"{LAT.format(k=k)} AS latitude, {LON.format(k=k)} AS longitude"


def _stop_times(leg: str, dwell: str) -> str:
    base = f"""SELECT o_orderkey AS k, o_orderkey % {NR} AS r, pos, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders CROSS JOIN eight"""
    timed = f"SELECT k, r, pos, (r * 13 + pos * (1 + r % 3)) % {NS} AS stop, 18000 + (k * 263) % 28800 AS t0, {leg} AS leg, {dwell} AS dwell FROM ({base}) x"
    return f"""SELECT concat('T', lpad(CAST(k AS STRING), 8, '0')) AS trip_id, concat('R', lpad(CAST(r AS STRING), 6, '0')) AS route_id, CAST(pos AS INT) AS pos,
      concat('S', lpad(CAST(stop AS STRING), 6, '0')) AS stop_id, CAST(t0 + pos * (leg + dwell) AS BIGINT) AS arr, CAST(t0 + pos * (leg + dwell) + dwell AS BIGINT) AS dep,
      CASE WHEN pos = 7 OR (k + pos) % 11 = 0 THEN 1 WHEN (k + pos) % 13 = 0 THEN 2 ELSE 0 END AS pickup,
      CASE WHEN pos = 0 OR (k + pos) % 17 = 0 THEN 1 ELSE 0 END AS drop_off FROM ({timed}) y"""


#: In order: later ones read earlier ones.
VIEWS = {
    "v_stops": f"""SELECT concat('S', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS stop_id, s_name AS stop_name, {_coords("s_suppkey")}, 'STOP_OR_PLATFORM' AS kind,
      CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE concat('N', lpad(CAST(s_nationkey AS STRING), 2, '0')) END AS parent_station_id FROM supplier
      UNION ALL SELECT concat('N', lpad(CAST(n_nationkey AS STRING), 2, '0')), n_name, {_coords("CAST(n_nationkey AS BIGINT)")}, 'STATION', NULL FROM nation""",
    "v_localities": f"""SELECT c_custkey AS row_no, CAST(1000 + c_custkey % 997 AS STRING) AS postal_code, c_mktsegment AS city, c_acctbal AS share, {_coords("c_custkey")} FROM customer""",
    "v_routes": f"""SELECT concat('R', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS route_id,
      CASE s_suppkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 109 WHEN 2 THEN 700 WHEN 3 THEN 900 ELSE 3 END AS route_type FROM supplier WHERE s_suppkey < {NR}""",
    "v_calendar": """SELECT DISTINCT o_orderpriority AS service_id, '20251214' AS start_date, '20261212' AS end_date,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') THEN 1 ELSE 0 END AS monday FROM orders""",
    "v_calendar_dates": f"""SELECT service_id, '{SERVICE_DATE}' AS date, CASE WHEN service_id = '3-MEDIUM' THEN 1 ELSE 2 END AS exception_type FROM v_calendar WHERE service_id IN ('3-MEDIUM', '4-NOT SPECIFIED')""",
    "v_trips": f"""SELECT concat('T', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS trip_id, concat('R', lpad(CAST(o_orderkey % {NR} AS STRING), 6, '0')) AS route_id, o_orderpriority AS service_id FROM orders""",
    "v_stop_times_a": _stop_times("210 + 30 * (price % 5)", "30 * (k % 2)"),
    "v_stop_times_b": _stop_times("210 + 30 * (r % 5)", "30 * (r % 2)"),
    "v_frequencies": """SELECT concat('T', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS trip_id, CAST(25200 AS BIGINT) AS start, CAST(32400 AS BIGINT) AS "end", CAST(CASE WHEN o_orderkey % 100 = 0 THEN 600 ELSE 900 END AS BIGINT) AS headway FROM orders WHERE o_orderkey % 50 = 0""",
    "v_transfers": f"""SELECT concat('S', lpad(CAST(s_suppkey AS STRING), 6, '0')) AS from_stop_id, concat('S', lpad(CAST((s_suppkey + 1) % {NS} AS STRING), 6, '0')) AS to_stop_id,
      CAST(s_suppkey % 4 AS INT) AS transfer_type, CASE WHEN s_suppkey % 4 = 2 THEN CAST(60 + (s_suppkey % 7) * 30 AS BIGINT) END AS seconds FROM supplier""",
}


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"CASE WHEN {lat1} = {lat2} AND {lon1} = {lon2} THEN 0.0 ELSE 2 * 6371008.8 * atan2(sqrt(least(1.0, {a})), sqrt(1 - least(1.0, {a}))) END"


def _clock(t: str) -> str:
    part = lambda e: f"lpad(CAST({e} AS STRING), 2, '0')"
    return f"concat_ws(':', {part(f'CAST(floor(({t}) / 3600) AS BIGINT)')}, {part(f'CAST(floor(({t}) / 60) AS BIGINT) % 60')}, {part(f'({t}) % 60')})"


def _numbered(table: str, column: str) -> str:
    return f"(SELECT *, CAST(substr({column}, 2, 8) AS BIGINT) AS k FROM {table}) x"


def _again(cols: str, source: str, some: str) -> str:
    """cols of source under a key of its rows, and rows where ``some`` holds once more."""
    return f"SELECT key, {cols} FROM {source} UNION ALL SELECT concat(key, 'r'), {cols} FROM {source} WHERE {some}"


_LATE = "CASE WHEN k % 83 = 4 AND pos = 4 THEN 1000 ELSE 0 END"
_SERVICE = "concat('V', lpad(CAST({k} AS STRING), 6, '0'))"
_BY_CUSTOMER = f"(SELECT c_custkey AS k, {_SERVICE.format(k='c_custkey')} AS service_id, lpad(CAST(c_custkey AS STRING), 9, '0') AS key FROM customer) x"

#: A feed with faults of every kind, as the text of its files; key orders the rows of a file.
VIEWS |= {
    "v_bad_calendar": _again("service_id, CASE WHEN k % 10 = 1 THEN '2' WHEN k % 10 = 2 THEN '' WHEN k % 10 = 3 THEN '0' ELSE '1' END AS monday, CASE WHEN k % 11 = 3 THEN '20260231' ELSE '20251214' END AS start_date, CASE WHEN k % 13 = 5 THEN '20250101' ELSE '20261212' END AS end_date", _BY_CUSTOMER, "k % 17 = 4"),
    "v_bad_exceptions": _again("service_id, CASE k % 7 WHEN 2 THEN '20271301' WHEN 3 THEN '20270101' WHEN 4 THEN '20260230' ELSE '20260907' END AS date, CASE WHEN k % 15 = 0 THEN '' WHEN k % 9 = 3 THEN '3' WHEN k % 9 = 6 THEN '2' ELSE '1' END AS exception_type", _BY_CUSTOMER.replace("FROM customer", "FROM customer WHERE c_custkey % 3 = 0"), "k % 57 = 6"),
    "v_bad_routes": _again("route_id, CASE k % 6 WHEN 1 THEN 'x' WHEN 2 THEN '-1' ELSE CAST(route_type AS STRING) END AS route_type", f"(SELECT *, route_id AS key FROM {_numbered('v_routes', 'route_id')}) y", "k % 23 = 7"),
    "v_bad_trips": _again(f"trip_id, route_id, {_SERVICE.format(k='k % (SELECT count(*) FROM customer)')} AS service_id", f"(SELECT *, trip_id AS key FROM {_numbered('v_trips', 'trip_id')}) y", "k % 101 = 9"),
    "v_bad_stops": _again(f"""CASE WHEN kind <> 'STATION' AND k % 31 = 9 THEN '' ELSE stop_id END AS stop_id, stop_name, CASE WHEN kind = 'STATION' THEN CAST(latitude AS STRING) WHEN k % 12 = 1 THEN '91.5' WHEN k % 12 = 2 THEN 'north' WHEN k % 12 = 3 THEN '' ELSE CAST(latitude AS STRING) END AS latitude, CAST(longitude AS STRING) AS longitude,
      CASE WHEN kind = 'STATION' THEN '1' WHEN k % 15 = 4 THEN '7' WHEN k % 15 = 5 THEN '3' ELSE '' END AS location_type, CASE WHEN kind = 'STATION' AND k % 5 = 1 THEN 'N00' WHEN kind = 'STATION' OR parent_station_id IS NULL THEN '' WHEN k % 14 = 6 THEN 'N99' WHEN k % 14 IN (8, 9) THEN concat('S', lpad(CAST((k + 1) % {NS} AS STRING), 6, '0')) ELSE parent_station_id END AS parent_station""",
      f"(SELECT *, stop_id AS key FROM {_numbered('v_stops', 'stop_id')}) y", "k % 29 = 8"),
    "v_bad_stop_times": f"""SELECT concat(lpad(CAST(k AS STRING), 9, '0'), CAST(pos AS STRING)) AS key, pos, CASE WHEN k % 47 = 12 THEN concat('X', substr(trip_id, 2, 8)) ELSE trip_id END AS trip_id,
      CASE WHEN (k + pos) % 97 = 1 THEN '25:61:00' WHEN k % 89 = 3 AND pos = 3 THEN {_clock('dep + 60')} ELSE {_clock(f'arr - {_LATE}')} END AS arrival_time, CASE WHEN (k + pos) % 97 = 2 THEN '' ELSE {_clock(f'dep - {_LATE}')} END AS departure_time,
      CASE WHEN k % 61 = 9 AND pos = 1 THEN '' WHEN k % 59 = 10 AND pos = 1 THEN 'S999999' ELSE stop_id END AS stop_id, CASE WHEN k % 79 = 5 AND pos = 5 THEN '40' WHEN k % 73 = 6 AND pos = 2 THEN 'x' WHEN k % 71 = 7 AND pos = 6 THEN '5' ELSE CAST(pos * 10 AS STRING) END AS stop_sequence,
      CASE WHEN (k + pos) % 53 = 11 THEN '4' ELSE CAST(pickup AS STRING) END AS pickup_type, CASE WHEN drop_off = 0 THEN '' ELSE CAST(drop_off AS STRING) END AS drop_off_type FROM {_numbered("v_stop_times_a", "trip_id")} WHERE NOT (k % 67 = 8 AND pos > 0)""",
    "v_bad_frequencies": f"""SELECT concat(trip_id, CAST(w AS STRING)) AS key, CASE WHEN j % 8 = 1 THEN concat('Y', substr(trip_id, 2, 8)) ELSE trip_id END AS trip_id, CASE WHEN j % 8 = 5 THEN '7h' WHEN w = 1 THEN '08:59:00' ELSE {_clock('start')} END AS start_time,
      CASE WHEN j % 8 = 4 THEN '06:00:00' WHEN w = 1 THEN '10:00:00' ELSE {_clock('"end"')} END AS end_time, CASE WHEN j % 8 = 2 THEN '0' WHEN j % 8 = 3 THEN 'x' ELSE CAST(headway AS STRING) END AS headway_secs
      FROM (SELECT *, CAST(floor(CAST(substr(trip_id, 2, 8) AS BIGINT) / 50) AS BIGINT) AS j FROM v_frequencies) x CROSS JOIN (SELECT pos AS w FROM eight) t WHERE w = 0 OR (w = 1 AND j % 8 = 6)""",
    "v_bad_transfers": f"""SELECT from_stop_id AS key, CASE WHEN k % 37 = 5 THEN '' ELSE from_stop_id END AS from_stop_id, to_stop_id, CASE k % 9 WHEN 1 THEN '7' WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE CAST(transfer_type AS STRING) END AS transfer_type,
      CASE WHEN k % 11 = 3 THEN '12a' WHEN k % 11 = 4 THEN '4294967295' WHEN k % 11 = 5 THEN '99999999999' WHEN k % 11 < 9 AND seconds IS NOT NULL THEN CAST(seconds AS STRING) ELSE '' END AS min_transfer_time FROM {_numbered("v_transfers", "from_stop_id")}""",
}


# The hint deals the one small file of localities to many tasks; DuckDB takes it for a comment.
VIEWS["v_road_seconds"] = f"""SELECT a.row_no AS origin, b.row_no AS destination, CAST(floor(({haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")}) / 15) AS BIGINT) AS seconds
  FROM (SELECT /*+ REPARTITION(32) */ * FROM v_localities) a CROSS JOIN v_localities b"""


def uses(sql: str) -> list[str]:
    """Views that sql needs, in order."""
    names: set[str] = set()
    todo = set(re.findall(r"\bv_\w+|\beight\b", sql))
    while todo:
        n = todo.pop()
        if n not in names:
            names.add(n)
            todo |= set(re.findall(r"\bv_\w+|\beight\b", VIEWS.get(n, "")))
    return [n for n in ("eight", *VIEWS) if n in names]


def with_views(sql: str) -> str:
    """DuckDB text: a WITH clause of the views that sql needs, then sql. Names of its own WITH clause follow them."""
    defs = {"eight": "SELECT range AS pos FROM range(8)", **VIEWS}
    head = ", ".join(f"{n} AS ({defs[n]})" for n in uses(sql))
    if not head:
        return sql
    body = sql.strip()
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"


class Views:
    """The views over one folder of tables, as DataFrames: views.stops is v_stops."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._made: dict[str, DataFrame] = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
        self._made["eight"] = spark.range(8).withColumnRenamed("id", "pos")

    def view(self, name: str) -> DataFrame:
        if name not in self._made:
            sql = VIEWS[name].replace('"end"', "`end`")
            names = sorted(set(re.findall(r"\b(?:v_\w+|eight|customer|supplier|nation|orders)\b", sql)) & {*TABLES, *VIEWS, "eight"})
            for n in names:
                sql = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", sql)
            # pass only what is named, and only as a table
            self._made[name] = self._spark.sql(sql, **{n: self.view(n) for n in names if f"{{{n}}}" in sql})
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.view(f"v_{name}")
