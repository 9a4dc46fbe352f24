"""Recruiter CSV source."""

from __future__ import annotations

import csv
import io
import logging
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone import schema
from lodestone.errors import CsvSourceError
from lodestone.session import planned
from lodestone.sources.files import checksum, exists, first_line, is_dir

LOG = logging.getLogger(__name__)
REQUIRED = ["name", "email", "phone", "company", "title", "skills", "location"]
_BAD, _MORE = "_whole_row", "_more_cells"
_CELL_BREAK = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def header_of(line: str) -> list[str]:
    """Trimmed column names; an error if a required one is missing."""
    names = [n.strip() for n in next(csv.reader(io.StringIO(line.lstrip("﻿"))), [])]
    if not any(names):
        raise CsvSourceError("the CSV has no header")
    if missing := sorted(set(REQUIRED) - set(names)):
        raise CsvSourceError(f"the CSV lacks required columns: {', '.join(missing)}")
    return names


def trimmed(cell: Column) -> Column:
    """The cell without white space around it; null if nothing is left."""
    return F.nullif(F.regexp_replace(cell, r"(?U)^\s+|\s+$", ""), F.lit(""))


def row_text(columns: list[str], value) -> Column:
    """"key: value" lines of the cells that have something. value: from a name, the cell's Column."""
    return F.concat_ws("\n", *(F.when(value(c).isNotNull() & (value(c) != ""), F.concat(F.lit(f"{c}: "), value(c))) for c in columns))


def not_blank(columns: list[str], value) -> Column:
    """Whether any cell has something."""
    return F.coalesce(*(F.nullif(F.trim(value(c)), F.lit("")) for c in columns)).isNotNull()


def record_id(*parts: Column) -> Column:
    """An id made from content, so that reruns agree."""
    return F.concat(F.lit("raw_"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 32))


def empty_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.RAW)


def read_recruiter_csv(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """One raw record per row. Short rows keep null cells, rows with surplus cells and blank rows go.

    A missing file gives no rows and a warning; a folder or a header without a required column is an error.
    Row numbers begin at 2 and count rows that go, as they stand in the file.
    """
    if not exists(spark, path):
        LOG.warning("recruiter CSV not found: %s", path)
        return empty_records(spark)
    if is_dir(spark, path):
        raise CsvSourceError(f"the recruiter CSV is a folder: {path}")
    names = header_of(first_line(spark, path))
    cells = [f"c{k}" for k in range(len(names))]
    # One cell more than the header has: a row fills it only if it is too long, and any other row is kept whole in _BAD.
    shape = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, _MORE, _BAD]])
    read = spark.read.schema(shape).options(header=True, enforceSchema=True, multiLine=True, escape='"', columnNameOfCorruptRecord=_BAD, encoding="UTF-8").csv(path)
    # A file read with multiLine is one partition, so this order is the file's.
    numbered = read.withColumn("row_number", (F.monotonically_increasing_id() % (1 << 33) + 2))
    whole = F.col(_BAD).isNotNull() & (F.size(F.split(F.col(_BAD), _CELL_BREAK, -1)) <= len(names))
    value = {n: trimmed(F.col(c)) for n, c in zip(names, cells)}
    kept = numbered.filter(whole)
    file_name = PurePosixPath(path).name
    text = row_text(names, value.__getitem__)
    payload = F.create_map(*(x for n in names for x in (F.lit(n), value[n])), F.lit("row_number"), F.col("row_number").cast("string"))
    records = kept.select(
        record_id(F.lit(file_name), F.col("row_number").cast("string"), text).alias("record_id"),
        F.col("row_number").alias("seq"),
        F.lit(file_name).alias("source_name"),
        F.lit("recruiter_csv").alias("source_type"),
        F.lit(file_name).alias("file_name"),
        F.lit(path).alias("file_path"),
        F.lit("text/csv").alias("mime_type"),
        F.lit(checksum(spark, path)).alias("checksum_sha256"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.array(*map(F.lit, names)).alias("fieldnames"),
        payload.alias("payload"),
        text.alias("raw_text"),
        F.array(F.lit("recruiter"), F.lit("csv")).alias("tags"),
    )
    return planned(records).filter("raw_text != ''")  # a row without any value has no text
