"""Materialised intermediates in the shared folder, and checks of size before a broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its rows are counted and found to be at most this many (of a few longs each).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 24_000_000
#: Bytes of a batch between Spark and a Python worker; a task holds a few of them outside the heap, and the worker some copies.
BATCH = 8_000_000

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only where that is unset (tests), a new local one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    key = spark.sparkContext.applicationId
    if key not in _local:
        _local[key] = tempfile.mkdtemp(prefix="reachspark-")
        atexit.register(shutil.rmtree, _local[key], True)
    return "file://" + _local[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Sees to it that batches are bounded by bytes, not by rows alone: texts can be very long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not str(now).isdigit() or not 0 < int(now) <= BATCH:
        spark.conf.set(key, str(BATCH))


def release() -> None:
    """Gives memory that a worker has freed back to the system: idle workers stay, and keep what they don't return."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()  # modules stay: later collections need not look through them
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def thrifty(run):
    """A batch function that releases its worker's memory when a task's rows are done."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    bounded_batches(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._reachspark_path = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame | None) -> None:
    """Delete what materialise() wrote for df, once nothing reads it any more."""
    path = getattr(df, "_reachspark_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int | None = None, width: int = 16) -> DataFrame:
    """df with a broadcast hint if it is known to be small, else df as it is (a shuffled join follows).

    Small: at most BROADCAST_ROWS rows and BROADCAST_BYTES bytes, of rows of about ``width`` bytes. Counted here unless rows are given; df should be materialised."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS and n * width <= BROADCAST_BYTES else df


#: A key that holds more than one of HEAVY rows is a heavy one: fewer than HEAVY keys can be, whatever the data, so what is known of them may always be broadcast.
HEAVY = 4096


def join_skewed(rows: DataFrame, named: DataFrame, key: str, n: str = "n", least: int = 1000, width: int = 0) -> DataFrame:
    """rows joined with named on key. named: one row for each key, written already, with the number of its rows in ``n``, which the result lacks.

    Rows of heavy keys (more than ``least`` of them, too) stay where they are and meet a broadcast of fewer than HEAVY rows of named; only the others are shuffled, so
    no task gets more than one of HEAVY rows by one key. With a width (bytes of a row of named), a table that ``small`` lets by is broadcast whole instead. Null keys join with nothing."""
    if width:
        count = named.count()
        if count <= BROADCAST_ROWS and count * width <= BROADCAST_BYTES:
            return rows.join(F.broadcast(named.drop(n)), key)
    total = named.agg(F.sum(n)).first()[0] or 0
    limit = max(least, total // HEAVY)
    heavy, rest = named.where(F.col(n) > limit).drop(n), named.where(F.col(n) <= limit).drop(n)
    if heavy.isEmpty():
        return rows.join(rest, key)
    return rows.join(F.broadcast(heavy), key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(rest, key))


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that no plan refers to any more: it notices when the driver's JVM collects garbage, which can take half an hour by itself."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


#: Bytes of a Bloom filter's block, and the largest filter's bits as a power of two (16 MB).
BLOOM_BLOCK, BLOOM_BITS = 1 << 14, 27


class Bloom:
    """A Bloom filter of 64-bit ids: about 16 bits an id, 16 MB at most, so it may always be broadcast. Beyond 8 million ids more strangers pass; nothing is lost."""

    def __init__(self, ids: DataFrame, column: str):
        """Tasks fill filters and send the blocks that aren't empty; each block is united in one place."""
        import numpy as np
        import pyarrow as pa

        from reachspark.llm.textkernel import bloom

        spark, n = ids.sparkSession, ids.count()
        bits = min(BLOOM_BITS, max(BLOOM_BLOCK.bit_length() + 2, int(16 * n).bit_length()))
        blocks = (1 << bits) // 8 // BLOOM_BLOCK

        def fill(batches):
            out = np.zeros((1 << bits) // 8, np.uint8)
            for b in batches:
                for at in bloom(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                    np.bitwise_or.at(out, at >> 3, (1 << (7 - (at & 7))).astype(np.uint8))
            rows = out.reshape(blocks, BLOOM_BLOCK)
            some = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([rows[i].tobytes() for i in some], pa.binary())], ["block", "bits"])

        def unite(batches):
            have: dict[int, np.ndarray] = {}
            for b in batches:
                for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    have[k] = have[k] | np.frombuffer(v, np.uint8) if k in have else np.frombuffer(v, np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int32()), pa.array([v.tobytes() for v in have.values()], pa.binary())], ["block", "bits"])

        got = ids.select(column).where(f"{column} is not null").mapInArrow(fill, "block int, bits binary").repartition(min(blocks, partitions(spark)), "block").mapInArrow(unite, "block int, bits binary").collect()
        total = np.zeros((blocks, BLOOM_BLOCK), np.uint8)
        for k, v in got:
            total[k] = np.frombuffer(v, np.uint8)
        self.bits, self.shared = bits, spark.sparkContext.broadcast(total.tobytes())

    def has(self, ids):
        """Which of an array of uint64 ids may be in it."""
        import numpy as np

        from reachspark.llm.textkernel import bloom

        table = np.frombuffer(self.shared.value, np.uint8)
        ok = np.ones(len(ids), bool)
        for at in bloom(ids, self.bits):
            ok &= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return ok

    def column(self, ids: Column) -> Column:
        """The same as a column; only ids travel to Python, the rest of a row stays in Spark."""
        import numpy as np

        @F.pandas_udf("boolean")
        def may(h: pd.Series) -> pd.Series:
            return pd.Series(self.has(h.to_numpy(np.int64).view(np.uint64)))

        return may(ids)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
