"""Records of a file read by many tasks against one whole parse; rows of trips that are not together."""

import csv
import io
import random

import pytest
from pyspark.errors import PythonException

from reachspark.sources.feed import contiguity_violations, read_table
from reachspark.sources.records import HeaderError, RecordError, _states, read_records


def whole(text):
    rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r]
    return [(n + 2, *r) for n, r in enumerate(rows[1:])]


def quoted_file(seed, n=400, end="\n"):
    r = random.Random(seed)
    out = ["﻿a,\"b \"\"x\"\"\",c"]
    for k in range(n):
        field = lambda: r.choice(["", "x", "é" * r.randrange(5), '"a, b"', '"say ""hi"""', '""', '"line' + end + 'feed"', '"' + (end * r.randrange(1, 40)) + '"', '"' + "long " * r.randrange(300) + '"', '"""' + end + '"""'])
        out.append(",".join([f"k{k}", field(), field()]))
        if r.random() < 0.1:
            out.append("")
    return end.join(out) + (end if seed % 2 else "")


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "32"}
    was = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\r\n")])
def test_splits_give_what_one_parse_gives(small_splits, tmp_path, seed, end):
    text = quoted_file(seed, end=end)
    (tmp_path / "f.txt").write_bytes(text.encode())
    states, n = _states(small_splits, str(tmp_path / "f.txt"))
    assert len(states) >= 20 and any(s.inside for s in states.values())  # splits begin inside quoted fields, too
    got = read_records(small_splits, str(tmp_path / "f.txt"), ["a", 'b "x"'], ["c", "d"]).collect()
    assert sorted(map(tuple, got)) == whole(text) and n == len(got) + 1


def test_one_field_over_many_splits(small_splits, tmp_path):
    text = 'a,b\n1,x\n2,"' + "one line\n" * 800 + '"\n3,y\n'
    (tmp_path / "f.txt").write_text(text)
    assert sorted(map(tuple, read_records(small_splits, str(tmp_path / "f.txt"), ["b", "a"]).collect())) == [(n, b, a) for n, a, b in whole(text)]


def test_errors_name_file_and_row(small_splits, tmp_path):
    body = "a,b\n" + "".join(f"{k},x\n" for k in range(300))
    cases = {"open": (body + '7,"never shut\n', 302), "wide": (body + "1,2,3\n" + body[4:], 302), "bad": (body + '1,"x"y\n', 302)}
    for name, (text, row) in cases.items():
        (tmp_path / f"{name}.txt").write_text(text)
        with pytest.raises((RecordError, PythonException), match=rf"{name}.txt: row {row}: "):
            read_records(small_splits, str(tmp_path / f"{name}.txt"), ["a"]).collect()
    (tmp_path / "none.txt").write_text("\n\n")
    for name, need in (("none", ["a"]), ("open", ["z"])):
        with pytest.raises(HeaderError):
            read_records(small_splits, str(tmp_path / f"{name}.txt"), need)


def test_quoted_stop_names(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station\nA,"Two\nlines",47.0,8.0,0,\n')
    assert [tuple(r)[:4] for r in read_table(spark, str(tmp_path), "stops").collect()] == [("A", "Two\nlines", "47.0", "8.0")]


def test_rows_of_a_trip_are_together(small_splits, tmp_path):
    """t1 comes back after t2, whose service is not active; t3 comes back, but isn't active itself."""
    rows = ["t1", "t2", "t2", "t1", "t3", "t4", "t3", *[f"u{k // 3}" for k in range(300)], "t5"]
    lines = "".join(f"{t},08:00:00,08:00:00,s,{k},0,0\n\n" for k, t in enumerate(rows))
    (tmp_path / "stop_times.txt").write_text("trip_id,arrival_time,departure_time,stop_id,stop_sequence,pickup_type,drop_off_type\n" + lines)
    active = small_splits.createDataFrame([("t1",), ("t4",), ("t5",), *[(f"u{k}",) for k in range(100)]], "trip_id string")
    st = read_table(small_splits, str(tmp_path), "stop_times", ordinal=True)
    assert sorted(r.ordinal for r in st.collect()) == list(range(2, len(rows) + 2))
    assert [(r.rule, r.key) for r in contiguity_violations(st, active).collect()] == [("SRC-09.contiguity", "t1")]
