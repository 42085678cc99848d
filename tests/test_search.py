"""Searches by the index of runs of characters equal the scan, query by query."""

from reachspark.functions.text import normalize_city
from reachspark.operators import lookup

PLACES = [("8001", "Zürich"), ("8002", "Zürich"), ("1200", "Genève"), ("1003", "Lausanne"), ("3000", "Bern"), ("3001", "Bern 8001"), ("9000", "St. Gallen"), ("1", "É"), (None, "Nowhere"), ("4000", None)]


def rule(query, limit):
    """The ranks as plain Python."""
    q, found = normalize_city(query) if query else "", []
    for i, (postal, city) in enumerate(PLACES):
        if not q or postal is None or city is None:
            continue
        city = normalize_city(city)
        label = f"{postal} {city}"
        tests = (label == q, postal == q, city == q, label.startswith(q), postal.startswith(q), city.startswith(q), q in label)
        if any(tests):
            found.append((tests.index(True), f"L{i:02d}"))
    return sorted(found)[:limit]


def test_every_piece_of_every_label(spark):
    places = spark.createDataFrame([(f"L{i:02d}", p, c, 1) for i, (p, c) in enumerate(PLACES)], "locality_id string, postal_code string, city string, gram int")
    queries = sorted({f"{p} {c}"[a:b] for p, c in PLACES for a in range(14) for b in range(a + 1, 15)}) + ["ZURICH", "  bern ", "xyz", "8001 zurich x", "", "   ", None, "bern", "bern"]
    requests = spark.createDataFrame(list(enumerate(queries)), "request_id int, query string").selectExpr("*", "'clash' as q", "1 as rank")
    for limit in (2, 20):
        got: dict = {}
        for r in lookup.search_many(requests, lookup.search_index(places), limit).orderBy("request_id", "place").collect():
            assert r.place == len(got.setdefault(r.request_id, [])) + 1
            got[r.request_id].append((r.rank, r.locality_id))
        for i, q in enumerate(queries):
            assert got.get(i, []) == rule(q, limit), q
    for q in ("bern", "800", "e", "zürich"):
        assert [(r.rank, r.locality_id) for r in lookup.search(places, q).collect()] == rule(q, 20)


def test_runtime(spark):
    from reachspark.plans.runtime import TravelTimes

    named = spark.createDataFrame([(f"{p}:{normalize_city(c)}", p, c, 47.0, 8.0) for p, c in PLACES[:7]], "locality_id string, postal_code string, city string, latitude double, longitude double")
    times = TravelTimes(named, {})
    requests = spark.createDataFrame([(1, "Bern"), (2, "800")], "request_id int, query string")
    for _ in range(2):
        got = times.search_many(requests).orderBy("request_id", "place").collect()
        assert [r.locality_id for r in got if r.request_id == 1] == [r.locality_id for r in times.search("Bern").collect()]
        assert [r.locality_id for r in got if r.request_id == 2] == [r.locality_id for r in times.search("800").collect()]


def test_empty(spark):
    places = spark.createDataFrame([], "locality_id string, postal_code string, city string")
    requests = spark.createDataFrame([(1, "a")], "request_id int, query string")
    assert lookup.search_many(requests, lookup.search_index(places)).collect() == []
    assert lookup.search_many(requests.limit(0), lookup.search_index(places)).collect() == []
