"""Places of rows in their groups without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.llm.session import discard, materialise, partitions, small


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with ``idx`` (place in its group by ``order``, from 0) and ``size`` (rows of its group), both long.

    Rows are dealt out by ranges of (group, order, a number of the row), so a group of a third of all rows is cut over tasks,
    and so are its ties; places follow from how many rows of the group each earlier range has. Equal rows are numbered in any order.
    df should be a written table, as ranges are found by a first scan; group columns must not be null (order columns may: nulls first)."""
    keys, spark = [*group, *order], df.sparkSession
    # the rows of one task are numbered by monotonically_increasing_id: the task in the upper bits, the place in it in the lower 33
    dealt = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *keys, "__tie").sortWithinPartitions(*keys, "__tie")
    dealt = materialise(dealt.drop("__tie").withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__at", 33)), "ranked")
    # one row for each group and range that has some of it: as many as ranges and groups together at most
    runs = dealt.groupBy(*group, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = materialise(runs.select(*group, "__part", (before - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("size")), "runs")
    out = dealt.join(small(runs, width=100), [*group, "__part"]).withColumn("idx", F.col("__at") + F.col("__shift"))
    out = materialise(out.drop("__at", "__part", "__shift"), "placed")
    discard(dealt)
    discard(runs)
    return out
