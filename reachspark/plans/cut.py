"""Cuts a plan: the rows go to a table in the shared folder, so rounds don't repeat each other's work and a lost executor costs nothing."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; only where that is unset, as in tests, a new local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    key = spark.sparkContext.applicationId
    if key not in _local:
        _local[key] = tempfile.mkdtemp(prefix="reachspark-")
        atexit.register(shutil.rmtree, _local[key], True)
    return "file://" + _local[key]


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of ended jobs, which it does when the driver's JVM collects garbage: by itself that can take half an hour."""
    gc.collect()
    spark._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    path = f"{folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
