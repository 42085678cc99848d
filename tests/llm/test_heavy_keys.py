"""Joins where one key holds most rows."""

import pytest
from pyspark.sql import functions as F

from reachspark.llm import session
from reachspark.llm.embedding_forest import link_embeddings
from reachspark.llm.line_dedup import dedup_lines
from reachspark.llm.minhash_dedup import keep_first, near_duplicates


def _case(spark, rows=40000):
    left = spark.range(0, rows, 1, 8).select(F.col("id").alias("v"), F.when(F.col("id") % 3 > 0, F.lit(-1)).when(F.col("id") % 30 == 0, None).otherwise(F.col("id") % 997).cast("long").alias("sid"))
    named = left.where("sid is not null").groupBy("sid").agg(F.count("*").alias("n"), F.min("v").alias("least"))
    return left, session.materialise(named, "t")


@pytest.mark.parametrize("width", [0, 24])
def test_same_rows_as_a_plain_join(spark, width):
    left, named = _case(spark)
    got = session.join_skewed(left, named, "sid", width=width)
    assert sorted(got.columns) == ["least", "sid", "v"]
    assert sorted(map(tuple, got.select("v", "sid", "least").collect())) == sorted(map(tuple, left.join(named, "sid").select("v", "sid", "least").collect()))


def test_no_task_has_the_heavy_key(spark):
    left, named = _case(spark)
    per_task = [r["count"] for r in session.join_skewed(left, named, "sid").groupBy(F.spark_partition_id()).count().collect()]
    share = max(per_task) / sum(per_task)
    print(f"largest task: {share:.2f} of all rows, the heavy key has 0.68")
    assert share < 0.2


def test_empty_and_no_heavy_key(spark):
    left, named = _case(spark)
    assert session.join_skewed(left.where("false"), named.where("false"), "sid").count() == 0
    light = left.where("sid >= 0")
    assert session.join_skewed(light, named.where("sid >= 0"), "sid").count() == light.count()


def test_operators_where_a_set_is_heavy(spark, monkeypatch):
    """Near-duplicates, lines and vectors give what they give without heavy keys."""
    texts = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("one two three four five six\nthe same line in many documents")).otherwise(F.concat(F.lit("words of number "), (F.col("id") % 90).cast("string"), F.lit(" and some more that follow them\nthe same line in many documents"))).alias("text"))
    vectors = spark.range(90).select(F.col("id").alias("vec_id"), F.lit("a").alias("label"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.cos(F.col("id") * 0.07), F.sin(F.col("id") * 0.07))).alias("embedding"))
    runs = {"near": lambda: near_duplicates(texts, 2), "first": lambda: keep_first(texts, 2), "lines": lambda: dedup_lines(texts).select("row.doc_id", "clean", "n_kept"), "vectors": lambda: link_embeddings(vectors)}
    plain = {k: sorted(map(str, f().collect())) for k, f in runs.items()}
    real = session.join_skewed
    for module in ("minhash_dedup", "embedding_forest", "line_dedup"):
        monkeypatch.setattr(f"reachspark.llm.{module}.join_skewed", lambda rows, named, key, **_: real(rows, named, key, least=5))
    assert {k: sorted(map(str, f().collect())) for k, f in runs.items()} == plain
