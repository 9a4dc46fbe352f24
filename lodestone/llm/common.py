"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session, or the context's checkpoint folder.

    Where neither is set, a local master, which has one machine, gets a temporary checkpoint folder; a cluster gets an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lodestone_"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def lean_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Smaller Arrow batches than Spark's default of 10,000 rows, as texts are long. A setting of one's own stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def given_back(run):
    """run, a function for mapInArrow, that returns freed memory to the system when a task ends, as workers live on."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, which cuts the lineage and survives lost executors.

    The files go with release(), or when the driver's JVM ends. rows: about how many narrow rows df has, where that is known:
    a small table then isn't written by more tasks than it needs.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, ceil_div(rows, 200_000)))
    lean_batches(spark)
    path = f"{shared_dir(spark)}/lodestone/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _filesystem(spark, path).deleteOnExit(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _filesystem(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release(*tables: DataFrame | None) -> None:
    """Delete the files of stored tables that nothing will read again. Other tables are left alone."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path:
            spark = table.sparkSession
            _filesystem(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def crc32_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


class WordCache(dict):
    """Values of words, computed once each by make(word); forgets everything beyond limit entries."""

    def __init__(self, make, limit: int = 100_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


def hash_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most n rows of df, those whose keys hash lowest; all rows if there are no more.

    A first cut by the hash leaves few rows more than n, so that no task sorts or sends n rows each. Where keys repeat, the
    cut can leave fewer than n rows; it is then widened until n are left.
    """
    order, total = F.pmod(F.shiftright(F.xxhash64(*keys), 20), F.lit(1 << 40)), df.count()
    share = 1.2 * n / max(total, 1) + 100 / max(total, 1)
    while total > n and share < 1:
        cut = df.filter(order < F.lit(int((1 << 40) * share)))
        if cut.count() >= n:
            df = cut
            break
        share *= 4
    return df.orderBy(order, F.xxhash64(*keys), *keys).limit(n)
