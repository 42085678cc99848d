"""Prepared data, road networks, identities of builds, answers and requests."""

import dataclasses
import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from reachspark.checks import ViolationError
from reachspark.config import RoadPolicy, Scenario, TransitPolicy
from reachspark.functions.flags import flag_at, pack_flags
from reachspark.operators import access, matrix, transfers, trips
from reachspark.plans import compile as build
from reachspark.plans import validate
from reachspark.plans.runtime import TravelTimes
from reachspark.sources import artifacts, prepared, roadnet, router
from reachspark.sources.feed import Feed
from tests.test_engine import folder  # noqa: F401 - a fixture


def test_identity_of_a_transit_build(spark):
    t = {
        "stops": spark.createDataFrame([("a", 0), ("b", 1)], "stop_id string, stop_idx int"),
        "pattern_stop": spark.createDataFrame([(0, 0, 0), (0, 1, 1)], "pattern_id int, pos int, stop_idx int"),
        "pattern_time": spark.createDataFrame([(0, 0, 0, 5, 5, 0, 1), (0, 0, 1, 9, 9, 1, 0)], "pattern_id int, trip_idx int, pos int, arr long, dep long, pickup int, drop_off int"),
    }
    edges = spark.createDataFrame([(0, 1, 60, True)], "from_idx int, to_idx int, seconds long, access_eligible boolean")
    places = spark.createDataFrame([("x", "A", [0]), ("y", "B", [1])], "locality_id string, station_name string, stop_idxs array<int>")
    ids = spark.createDataFrame([("x", 0), ("y", 1)], "locality_id string, idx int")
    net = build.TransitNetwork(t, edges, places, Scenario(), TransitPolicy())
    first = build.transit_identity(net, ids)
    assert first == build.transit_identity(dataclasses.replace(net, tables={k: v.repartition(3) for k, v in t.items()}), ids)
    changed = {
        "pattern_stop_sha256": dataclasses.replace(net, tables=t | {"pattern_stop": t["pattern_stop"].withColumn("stop_idx", F.lit(0))}),
        "stops_sha256": dataclasses.replace(net, tables=t | {"stops": t["stops"].withColumn("stop_id", F.concat("stop_id", F.lit("2")))}),
        "localities_sha256": dataclasses.replace(net, locality_stops=places.withColumn("stop_idxs", F.array(F.lit(1)))),
        "service_date": dataclasses.replace(net, scenario=Scenario(service_date=Scenario().service_date.replace(day=8))),
        "transfers_sha256": dataclasses.replace(net, edges=edges.withColumn("seconds", F.lit(61).cast("long"))),
        "policy_sha256": dataclasses.replace(net, policy=TransitPolicy(max_transfers=4)),
    }
    for key, other in changed.items():
        new = build.transit_identity(other, ids)
        assert {k for k in new if new[k] != first[k]} == {key}


def test_a_folder_of_another_build_is_refused(spark, tmp_path):
    path = f"file://{tmp_path}/b"
    matrix.Build(spark, path, {"localities": 2, "x_sha256": "a" * 64})
    matrix.Build(spark, path, {"localities": 2, "x_sha256": "a" * 64})
    with pytest.raises(ValueError, match="x_sha256"):
        matrix.Build(spark, path, {"localities": 2, "x_sha256": "b" * 64})
    for bad in ({"localities": 0}, {"x_sha256": "A" * 64}, {"max_minutes": True}):
        with pytest.raises(ValueError):
            matrix.Build(spark, f"file://{tmp_path}/c", bad)


def test_rows_that_no_matrix_may_have(spark):
    ids = spark.createDataFrame([("a", 0), ("b", 1)], "locality_id string, idx int")
    cells = spark.createDataFrame([("a", "b", 5), ("a", "b", 6), ("b", "zz", 1), ("b", "a", 241), ("a", "a", None)], "origin string, locality_id string, minutes int")
    assert {r.rule for r in matrix.row_violations(cells, ids).collect()} == {"MX-01.unknown", "MX-01.twice", "MX-01.range"}


def test_publication_is_whole_or_not_at_all(spark, tmp_path):
    rows = spark.createDataFrame([(0, bytes([0, 1])), (1, bytes([1, 0]))], "origin_idx int, row binary")
    matrix.publish(rows, 2, str(tmp_path), "m", {"v": 1})
    with pytest.raises(Exception, match="1 rows, not 2"):
        matrix.publish(rows.limit(1), 2, str(tmp_path), "m", {"v": 2})
    assert sorted(os.listdir(tmp_path)) == ["m.bin", "m.json"] and json.load(open(tmp_path / "m.json"))["v"] == 1


def make(extract, target):
    for part in ("hsgr", "edges", "geometry", "properties"):
        with open(f"{target}.{part}", "w") as f:
            f.write(part)


def test_road_network(spark, folder, tmp_path):  # noqa: F811
    extract, out = str(tmp_path / "x.pbf"), str(tmp_path / "road/net")
    os.makedirs(tmp_path / "road")
    with open(extract, "wb") as f:
        f.write(b"roads")
    assert roadnet.prepare(extract, out, "ch", "5.27.1", make)["files"] == 4
    own, graph = roadnet.load(spark, extract, out, "ch", "5.27.1", folder, "localities")
    assert own.count() == 2 and graph["algorithm"] == "ch"
    with pytest.raises(ValueError, match="osrmVersion"):
        roadnet.load(spark, extract, out, "ch", "5.28.0", folder, "localities")
    roadnet.prepare(extract, out, "ch", "5.28.0", make)  # in the old one's place
    roadnet.load(spark, extract, out, "ch", "5.28.0", folder, "localities")
    with pytest.raises(ValueError, match="changed"):
        roadnet.prepare(extract, out, "ch", "5.28.0", lambda e, t: (make(e, t), open(e, "ab").write(b"!")))
    with pytest.raises(ValueError, match="sourcePbfSha256"):
        roadnet.load(spark, extract, out, "ch", "5.28.0", folder, "localities")
    assert sorted(os.listdir(tmp_path / "road")) == ["net"]
    for bad in ("{}", json.dumps({"roadGraph": graph | {"profile": "foot.lua"}}), json.dumps({"roadGraph": graph, "x": 1})):
        with pytest.raises(ValueError):
            roadnet.parse_graph(bad)


def test_prepared_data(spark, folder, tmp_path):  # noqa: F811
    feed, out = Feed(spark, folder, Scenario()), str(tmp_path / "prepared")
    artifacts.write_trips(trips.routing_trips(feed.stop_times, feed.trips, feed.frequencies), out, Scenario(), feed_version=feed.version)
    artifacts.write_stops(feed.stops, f"{out}/stops.json")
    p = prepared.load(spark, out, f"{out}/stops.json", folder, folder, "localities", Scenario())
    net = build.build_network(p.stop_times, p.trips, p.frequencies, p.stops, p.transfers, p.rail, p.localities)
    assert {r.station_name for r in net.locality_stops.collect()} == {"North", "Alone"}
    with pytest.raises(ValueError, match="scenario"):
        prepared.load(spark, out, f"{out}/stops.json", folder, folder, "localities", Scenario(window_end=40000))
    info = open(f"{folder}/feed_info.txt").read()
    with open(f"{folder}/feed_info.txt", "w") as f:
        f.write(info.replace("v1", "v2"))
    with pytest.raises(ValueError, match="version"):
        prepared.load(spark, out, f"{out}/stops.json", folder, folder, "localities", Scenario())


class Fails:
    def nearest(self, p):
        if p[0] < 2:
            raise ValueError(f"nothing near {p[0]:g}")
        return (float("nan"), 0.0, 0.0) if p[0] < 3 else (*p, 1.0)


def test_all_failed_snaps_are_reported(spark):
    df = spark.createDataFrame([("c", 1.0, 0.0), ("a", 0.0, 0.0), ("b", 2.0, 0.0), ("d", 3.0, 0.0)], "locality_id string, longitude double, latitude double")
    with pytest.raises(ValueError) as e:
        router.anchors(df, Fails(), RoadPolicy(attempts=1))
    lines = str(e.value).splitlines()
    assert lines[0].startswith("3 of 4") and [x[0] for x in lines[1:]] == ["a", "b", "c"]
    assert router.anchors(df.where("locality_id = 'd'"), Fails()).first().snap_m == 1.0
    with pytest.raises(ViolationError):
        router.anchors(df.union(df), Fails())


def test_http_router():
    seen = []

    class Answers(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.path)
            service, busy = self.path.split("/")[1], len(seen) == 1
            body = {
                "nearest": {"code": "Ok", "waypoints": [{"location": [7.5, 46.5], "distance": 12.5}]}, "route": {"code": "NoRoute"} if "1.000000" in self.path else {"code": "Ok", "routes": [{"duration": 61.5}]},
                "table": {"code": "Ok", "durations": [[0, 60.5], [61, None]]},
            }[service]
            self.send_response(503 if busy else 400 if body["code"] == "NoRoute" else 200)
            self.end_headers()
            self.wfile.write(b"busy" if busy else json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    r = router.HttpRouter(f"http://127.0.0.1:{server.server_port}")
    assert router.retried(lambda: r.nearest((7.0, 46.0)), 3, 0) == (7.5, 46.5, 12.5) and len(seen) == 2
    assert r.route((7.0, 46.0), (8.0, 46.0)) == 61.5 and r.route((1.0, 46.0), (8.0, 46.0)) is None
    assert r.table([(7.0, 46.0), (8.0, 46.0)], [(7.0, 46.0), (8.0, 46.0)]) == [[0, 60.5], [61, None]] and "sources=0;1&destinations=2;3" in seen[-1]
    with pytest.raises(router.AnswerError):
        r.table([(7.0, 46.0)], [(8.0, 46.0)])
    server.shutdown()
    with pytest.raises(router.TransportError):
        router.HttpRouter("http://127.0.0.1:9", timeout_s=2).nearest((7.0, 46.0))


def test_road_builds_go_on_where_they_stopped(spark, tmp_path):
    df = spark.createDataFrame([(f"{1000 + i}:x", 7 + i / 100, 46.0) for i in range(5)], "locality_id string, longitude double, latitude double")
    policy = RoadPolicy(block=2)
    whole = {(r.origin_idx, bytes(r.row)) for r in build.road_rows(df, router.SyntheticRouter(), str(tmp_path / "r"), policy).collect()}
    assert len(whole) == 5

    class Silent(router.SyntheticRouter):
        def table(self, sources, destinations):
            raise AssertionError("asked again")

    assert {(r.origin_idx, bytes(r.row)) for r in build.road_rows(df, Silent(), str(tmp_path / "r"), policy).collect()} == whole
    with pytest.raises(ValueError, match="anchors_sha256"):
        build.road_rows(df.withColumn("latitude", F.lit(46.5)), router.SyntheticRouter(), str(tmp_path / "r"), policy)


def test_query_checks(spark):
    stops = spark.createDataFrame([(0,), (2,), (2,)], "stop_idx int")
    validate.check_query(stops, 3, Scenario(), TransitPolicy())
    with pytest.raises(ViolationError):
        validate.check_query(stops, 2, Scenario(), TransitPolicy())
    for scenario, policy in ((Scenario(window_start=5, window_end=5), TransitPolicy()), (Scenario(window_end=2**32), TransitPolicy()), (Scenario(), TransitPolicy(max_transfers=-1)), (Scenario(), TransitPolicy(max_minutes=2**31)), (Scenario(), TransitPolicy(min_transfer_seconds=1.5))):
        with pytest.raises(ValueError):
            validate.check_query(stops, 3, scenario, policy)


def test_requests_and_answers(spark):
    loc = spark.createDataFrame([("1000:a", "1000", "A", 46.0, 7.0), ("1001:b", "1001", "B", 46.1, 7.1)], "locality_id string, postal_code string, city string, latitude double, longitude double")
    rows = spark.createDataFrame([(0, bytes([0, 20])), (1, bytes([255, 0]))], "origin_idx int, row binary")
    times = TravelTimes(loc, {"road": rows})
    answer = times.reachability({"originLocalityId": "1000:a", "mode": "road", "maxTravelMinutes": 60})
    validate.check_answer(answer)
    with pytest.raises(ValueError):
        validate.check_answer(answer | {"bounds": [8, 46, 7, 47]})
    with pytest.raises(ValueError):
        validate.check_answer({"bounds": answer["bounds"], "hexes": {"type": "FeatureCollection", "features": [answer["hexes"]["features"][0] | {"properties": {"travelMinutes": 241}}]}})
    assert {r.minutes for r in times.travel_times(spark.createDataFrame([("1000:a", "1001:b"), ("1001:b", "1000:a")], "origin string, destination string"), "road").collect()} == {20, None}
    body, etag = validate.locality_list(loc)
    assert json.loads(body)["localities"][1]["localityId"] == "1001:b" and validate.locality_list(loc.repartition(2)) == (body, etag)
    assert validate.etag_matches(f'"x", W/{etag}', etag) and validate.etag_matches("*", etag) and not validate.etag_matches('"x"', etag) and not validate.etag_matches(None, etag)
    assert validate.health(2, {"road": 2})["status"] == "ok" and validate.health(2, {"road": 1})["status"] == "incomplete"
    assert [validate.preflight(False, w, p) for w, p in (("absent", "absent"), ("absent", "complete"), ("complete", "complete"), ("incomplete", "complete"), ("absent", "incomplete"))] == ["build", "skip", "resume", "incomplete-work", "incomplete-publication"]
    assert validate.preflight(True, "complete", "complete") == "build"


def test_packed_flags(spark):
    rows = [([0, 1, 2, 3, 0], [3, 2, 1, 0, 1]), ([], []), ([1], [2]), ([4], [0])]
    df = spark.createDataFrame(rows, "p array<int>, d array<int>").select("p", "d", pack_flags(F.col("p"), F.col("d")).alias("b"))
    got = df.collect()
    assert [r.b and bytes(r.b) for r in got] == [bytes([3 | 6 << 4, 9 | 12 << 4, 1]), b"", bytes([6]), None]
    back = df.where("b is not null").select("p", "d", F.posexplode("p").alias("i", "x"), "b").select("x", F.get("d", F.col("i")).alias("y"), flag_at(F.col("b"), F.col("i")).alias("f")).collect()
    assert len(back) == 6 and all((r.x, r.y) == (r.f.pickup, r.f.drop_off) for r in back)


def test_adjacency_is_in_order(spark):
    e = spark.createDataFrame([(0, 2, None, True), (0, 1, 60, True), (0, 2, 30, False)], "from_idx int, to_idx int, seconds long, access_eligible boolean")
    assert [(w.to_idx, w.seconds) for w in transfers.adjacency(e).first().walks] == [(1, 60), (2, 30), (2, None)]


def test_station_choice_against_all_pairs(spark):
    import random

    from reachspark.sources.router import SyntheticRouter

    r = random.Random(4)
    loc = [(f"l{i:03d}", 46 + r.random() / 20, 7 + r.random() / 20) for i in range(60)] + [("far", -33.9, 151.2), ("pole", 89.999, 10.0), ("line", 46.0, -179.99)]
    pl = [(f"p{i:02d}", f"P{i}", 46 + r.random() / 20, 7 + r.random() / 20, ["s"]) for i in range(40)] + [("q1", "Q", 46.0, 179.99, ["s"]), ("none", "N", 46.02, 7.02, ["s"])]
    act = [(p[0], r.randrange(1, 9), r.randrange(3)) for p in pl if p[0] != "none"]
    got = {x.locality_id: x for x in access.station_choice(spark.createDataFrame(loc, "locality_id string, latitude double, longitude double"), spark.createDataFrame(pl, "place_id string, place_name string, latitude double, longitude double, stop_ids array<string>"), spark.createDataFrame(act, "place_id string, departures long, rail_departures long"), TransitPolicy()).collect()}
    score = {p: d + 0.25 * x for p, d, x in act}
    for i, lat, lon in loc:
        d = {p[0]: SyntheticRouter.metres((lon, lat), (p[3], p[2])) for p in pl if p[0] in score}
        near = [p for p in d if d[p] <= 500]
        want = min(near, key=lambda p: (-score[p], d[p], p)) if near else min(d, key=lambda p: (d[p], p))
        assert got[i].place_id == want, (i, got[i], want)
