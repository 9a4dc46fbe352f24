"""Files through Hadoop's file systems, so any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def is_dir(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.getFileStatus(at).isDirectory()


def first_line(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path).head(1)
    return rows[0][0] if rows else ""


def checksum(spark: SparkSession, path: str) -> str | None:
    """SHA-256 of a file, computed on an executor."""
    rows = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).head(1)
    return rows[0][0] if rows else None


def write_text(spark: SparkSession, path: str, parts) -> None:
    """Write an iterator of texts to one file in UTF-8; missing folders are made."""
    at, fs = _at(spark, path)
    out = fs.create(at, True)
    try:
        for part in parts:
            out.write(bytearray(part.encode("utf-8")))
    finally:
        out.close()
