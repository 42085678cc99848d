"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import pandas as pd
import pytest

from reachspark.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def rows(frame):
    clean = lambda v: None if pd.isna(v) else round(float(v), 6) if not isinstance(v, str) else v
    return sorted(repr([clean(v) for v in r]) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours, theirs = registry.queries()[name](spark, DIR).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert registry.entry(spark, DIR).count() > 0


def test_city_keys(spark):
    keys = registry.str01_normalise(spark, DIR).toPandas()
    from reachspark.functions.text import normalize_city

    text = spark.read.parquet(f"{DIR}/documents.parquet").toPandas().set_index("doc_id").text
    assert all(normalize_city(text[i]) == k for i, k in zip(keys.doc_id, keys.key))
