"""Feed preparation, matrices, runtime, geometry, sources."""

import json
import math

import pytest
from pyspark.sql import functions as F

from reachspark.checks import ViolationError, number
from reachspark.config import Scenario
from reachspark.functions import geo, text, timefn
from reachspark.operators import access, hexes, matrix, stops, transfers, trips
from reachspark.plans import compile as build
from reachspark.plans.runtime import RequestError, TravelTimes, parse_request
from reachspark.sources import artifacts, router
from reachspark.sources.feed import Feed, HeaderError, read_table
from reachspark.sources.localities import read_directory

DAYS = "monday,tuesday,wednesday,thursday,friday,saturday,sunday"


@pytest.fixture
def folder(tmp_path):
    files = {
        "feed_info": "feed_start_date,feed_end_date,feed_version\n20251214,20261212,v1\n",
        "calendar": f"service_id,{DAYS},start_date,end_date\non,1,0,0,0,0,0,0,20251214,20261212\noff,0,1,0,0,0,0,0,20251214,20261212\n",
        "calendar_dates": "service_id,date,exception_type\n",
        "routes": "route_id,route_type\nr1,700\nr2,109\n",
        "trips": "route_id,service_id,trip_id\nr1,on,t1\nr2,on,t2\nr1,off,t3\nr2,on,f1\n",
        "stops": "﻿stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\nN1, North ,46.0,7.0,1,\np1,North 1,46.0,7.0,,N1\np2,North 2,46.001,7.0,0,N1\n000123,Alone,46.1,7.1,0,\nx,Door,bad,7,2,\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence,pickup_type,drop_off_type\nt1,08:00:00,08:00:00,p1,1,,\nt1,08:30:00,08:30:00,000123,5,,\nt2,09:00:00,09:00:00,000123,1,0,0\nt2,25:03:30,25:03:30,p2,2,0,0\nt3,,,p1,1,0,0\nt3,,,p2,2,0,0\nf1,07:00:00,07:00:00,p2,1,0,0\nf1,07:20:00,07:20:00,000123,2,0,0\n",
        "frequencies": "trip_id,start_time,end_time,headway_secs,exact_times\nf1,07:30:00,08:00:00,600,1\n",
        "transfers": "from_stop_id,to_stop_id,transfer_type,min_transfer_time\np1,p2,2,60\n",
    }
    for name, body in files.items():
        (tmp_path / f"{name}.txt").write_text(body)
    (tmp_path / "localities.csv").write_text("Ortschaftsname;PLZ4;E;N;Adressenanteil\nNah;8001;7.0;46.0;10%\nNah;8001;7.0;46.0;90%\nWeit;8002;7.1;46.1;\n")
    return str(tmp_path)


def test_feed(spark, folder):
    feed = Feed(spark, folder, Scenario())
    feed.check()
    assert {r.trip_id for r in feed.trips.collect()} == {"t1", "t2", "f1"}
    assert feed.stop_times.where("trip_id = 't2' and pos = 1").first().arr == 90210
    assert {r.stop_id for r in feed.stops.collect()} == {"N1", "p1", "p2", "000123"}
    kept = trips.retained_trips(feed.stop_times, feed.frequencies, Scenario())
    assert trips.manifest_counts(feed.stop_times, kept, feed.frequencies).first().asDict() == {"trips": 3, "scheduled_trips": 2, "frequency_trips": 1, "stop_times": 6, "frequency_windows": 1}


def test_feed_faults(spark, folder):
    with open(f"{folder}/stop_times.txt", "a") as f:
        f.write("t1,08:40:00,08:39:00,nowhere,6,0,0\n")
    with pytest.raises(ViolationError) as e:
        Feed(spark, folder, Scenario()).check()
    rules = {r.rule for r in e.value.rows}
    assert {"VAL-02.dwell", "VAL-02.unknown", "SRC-09.contiguity"} <= rules
    with pytest.raises(HeaderError):
        read_table(spark, folder, "routes", required=["no_such"])


def test_compile(spark, folder, tmp_path):
    feed = Feed(spark, folder, Scenario())
    localities = read_directory(spark, folder, "localities")
    assert [(r.locality_id, r.share) for r in localities.collect()] == [("8001:nah", 90.0), ("8002:weit", None)]
    net = build.network_from_feed(feed, localities)
    assert {(r.locality_id, r.station_name) for r in net.locality_stops.collect()} == {("8001:nah", "North"), ("8002:weit", "Alone")}
    rows = build.transit_rows(net, str(tmp_path / "transit"))
    build.recheck_transit(net, rows)
    cells = {(r.origin_idx, r.dest_idx): r.minutes for r in matrix.long_form(rows, 2).collect()}
    assert cells == {(0, 0): 0, (0, 1): 20, (1, 0): None, (1, 1): 0}
    assert build.transit_rows(net, str(tmp_path / "transit")).count() == 2  # nothing to do again
    road = build.road_rows(localities, router.SyntheticRouter(), str(tmp_path / "road"))
    build.recheck_road(localities, road, router.SyntheticRouter(), seed=7)
    for mode, r in (("public_transport", rows), ("road", road)):
        matrix.publish(r, 2, str(tmp_path / "out"), mode, {"mode": mode})
    artifacts.package(localities, ["North", None], {m: str(tmp_path / f"out/{m}.bin") for m in ("public_transport", "road")}, str(tmp_path / "pack"))
    times = TravelTimes.load(spark, str(tmp_path / "pack"))
    assert times.travel_time("8001:nah", "8002:weit", "public_transport") == 20
    assert times.resolve_one(" 8001 ", "NÄH") == "8001:nah" and times.resolve_one("1", "x") is None
    assert [(r.locality_id, r.minutes) for r in times.reachable("8001:nah", 240, "public_transport").collect()] == [("8001:nah", 0), ("8002:weit", 20)]
    got = times.reachability({"originLocalityId": "8001:nah", "mode": "road", "maxTravelMinutes": 60})
    assert got["hexes"]["type"] == "FeatureCollection" and all(len(f["geometry"]["coordinates"][0]) == 7 for f in got["hexes"]["features"])
    with pytest.raises(RequestError):
        times.reachability({"originLocalityId": "9999:none", "mode": "road", "maxTravelMinutes": 60})
    with pytest.raises(KeyError):
        times.travel_time("9999:none", "8001:nah", "road")


def test_ndjson_round_trip(spark, folder, tmp_path):
    feed = Feed(spark, folder, Scenario())
    t = trips.routing_trips(feed.stop_times, feed.trips, feed.frequencies)
    out = str(tmp_path / "prepared")
    manifest = artifacts.write_trips(t, out, Scenario())
    assert manifest["trips"] == 3 and artifacts.read_trips(spark, out, Scenario()).count() == 3
    with open(f"{out}/trips.ndjson", "a") as f:
        f.write("\n")
    with pytest.raises(ValueError):
        artifacts.read_trips(spark, out)


@pytest.mark.parametrize("bad,code", [({}, "INVALID_REQUEST"), ({"originLocalityId": 1, "mode": "road", "maxTravelMinutes": 1}, "INVALID_ORIGIN_LOCALITY_ID"), ({"originLocalityId": "1:a", "mode": "air", "maxTravelMinutes": 1}, "INVALID_MODE"), ({"originLocalityId": "1:a", "mode": "road", "maxTravelMinutes": 241}, "INVALID_MAX_TRAVEL_MINUTES")])
def test_requests(bad, code):
    with pytest.raises(RequestError) as e:
        parse_request(bad)
    assert e.value.code == code


def test_numbers_and_times(spark):
    df = spark.createDataFrame([(v,) for v in ("1.5", " .5e1 ", "0x10", "1d", "NaN", "")], "v string")
    assert [r[0] for r in df.select(number(F.col("v"))).collect()] == [1.5, 5.0, None, None, None, None]
    df = spark.createDataFrame([(v,) for v in ("25:03:30", "7:00:00", "07:60:00", "x")], "v string")
    assert [r[0] for r in df.select(timefn.seconds(F.col("v"))).collect()] == [90210, 25200, None, None]
    df = spark.createDataFrame([(v,) for v in ("20240229", "20230229", "00000101", "2024-1-1")], "v string")
    assert [r[0] for r in df.select(timefn.valid_date(F.col("v"))).collect()] == [True, False, False, False]
    assert text.normalize_city("  Zürich   HB ") == "zurich hb" and Scenario().weekday_index == 1


def test_transfer_rules(spark):
    used = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "stop_id string, stop_idx int")
    every = spark.createDataFrame([(s, "STOP_OR_PLATFORM", "P") for s in "abc"], "stop_id string, kind string, parent_station_id string")
    rules = spark.createDataFrame([("a", "b", 0, None), ("a", "b", 1, 30), ("a", "b", 2, 90), ("b", "a", 3, None), ("a", "c", 1, None)], "from_stop_id string, to_stop_id string, transfer_type int, seconds long")
    got = {(r.from_idx, r.to_idx): (r.seconds, r.access_eligible) for r in transfers.transfer_edges(rules, every, used).collect()}
    # the longest time wins, a timed rule gives access, a plain one takes it away, a forbidden pair stays away
    assert got == {(0, 1): (90, True), (0, 2): (None, False), (1, 2): (None, True), (2, 0): (None, True), (2, 1): (None, True)}
    allowed, forbidden = transfers.explicit_edges(rules.union(rules.where("transfer_type = 3").withColumn("transfer_type", F.lit(0))), used)
    assert transfers.contradictions(allowed, forbidden).count() == 1


def test_places_and_hexes(spark):
    s = spark.createDataFrame([("S", "Hub", 46.0, 7.0, "STATION", None), ("e", "Empty", 46.0, 7.0, "STATION", None), ("p", "1", 46.0, 7.0, "STOP_OR_PLATFORM", "S"), ("q", "Solo", 46.5, 7.0, "STOP_OR_PLATFORM", None)], "stop_id string, stop_name string, latitude double, longitude double, kind string, parent_station_id string")
    assert {(r.place_id, tuple(r.stop_ids)) for r in stops.places(s).collect()} == {("S", ("p",)), ("q", ("q",))}
    one = spark.createDataFrame([(0, 0, 5)], "q long, r long, minutes int")
    f = hexes.hex_features(one, 4000.0).first()
    assert len(f.ring) == 7 and f.ring[0] == f.ring[6] and f.id == "0,0"
    centre = spark.createDataFrame([(0.0, 0.0)], "lat double, lon double").select(geo.hex_cell(F.col("lat"), F.col("lon"), 4000.0).alias("c")).first().c
    assert (centre.q, centre.r) == (0, 0)
    d = spark.range(1).select(geo.haversine_m(F.lit(46.0), F.lit(7.0), F.lit(46.0), F.lit(8.0))).first()[0]
    assert math.isclose(d, router.SyntheticRouter.metres((7.0, 46.0), (8.0, 46.0)), rel_tol=1e-12)
    with pytest.raises(ValueError):
        geo.shrink(F.col("x"), 0)


def test_matrix_checks(spark, tmp_path):
    cells = spark.createDataFrame([(0, 0, 0), (0, 1, 10), (1, 0, 10), (1, 0, 11), (1, 1, 3)], "origin_idx int, dest_idx int, minutes int")
    assert {r.rule for r in matrix.block_violations(cells, 2).collect()} == {"RD-03.twice", "RD-03.diagonal"}
    a = matrix.Build(spark, str(tmp_path / "b"), {"v": 1})
    with pytest.raises(ValueError):
        matrix.Build(spark, str(tmp_path / "b"), {"v": 2})
    assert a.rows().count() == 0 and len(set(matrix.sample_pairs(5, 8, 3))) == 8 and matrix.sample_indexes(100, 3) == [0, 49, 99]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise router.TransportError("x")
        return 5

    assert router.retried(flaky, 3, 0) == 5
    json.dumps(calls)


def test_no_active_place(spark):
    loc = spark.createDataFrame([("l", 46.0, 7.0)], "locality_id string, latitude double, longitude double")
    pl = spark.createDataFrame([], "place_id string, place_name string, latitude double, longitude double, stop_ids array<string>")
    act = spark.createDataFrame([], "place_id string, departures long, rail_departures long")
    from reachspark.config import TransitPolicy

    got = access.station_choice(loc, pl, act, TransitPolicy()).first()
    assert got.place_id is None


def test_stream_of_lookups(spark, tmp_path):
    from reachspark.streaming.lookups import answered, demand

    loc = spark.createDataFrame([("1000:a", 46.0, 7.0), ("1001:b", 46.1, 7.1)], "locality_id string, latitude double, longitude double")
    rows = spark.createDataFrame([(0, bytes([0, 20])), (1, bytes([255, 0]))], "origin_idx int, row binary")
    times = TravelTimes(loc, {"road": rows})
    src = str(tmp_path / "in")
    spark.sql("select 1L request_id, '1000:a' origin, '1001:b' destination, timestamp'2026-09-07 08:00:00' ts").write.parquet(src)
    stream = spark.readStream.schema("request_id long, origin string, destination string, ts timestamp").parquet(src)
    q = answered(stream, times, "road").writeStream.format("memory").queryName("answers").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select minutes from answers").first()[0] == 20
    assert demand(spark.readStream.schema("ts timestamp, origin string").parquet(src)).isStreaming
