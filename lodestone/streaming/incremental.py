"""Golden records kept up to date over a stream of raw records.

Extraction and normalization are narrow, so they run on the stream itself. Identity needs all records: a micro-batch is
appended to the store of normalized records, and golden records are made anew from the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestone import schema
from lodestone.operators import mapping, normalize, validation
from lodestone.operators.extract_structured import extract_structured
from lodestone.plans import consolidate


def raw_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Raw records of a folder of Parquet files, as files arrive."""
    return spark.readStream.schema(schema.RAW).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def normalized_stream(raw: DataFrame) -> DataFrame:
    """Structured records, normalized."""
    return raw.transform(validation.drop_fatal).transform(extract_structured).transform(mapping.to_canonical).transform(normalize.normalize)


def keep_golden(raw: DataFrame, store: str, golden: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the stream. store and golden are folders of Parquet; a batch that comes again after a failure replaces its own part of the store."""

    def update(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")
        records = batch.sparkSession.read.parquet(store).drop("batch")
        consolidate.golden(records).write.mode("overwrite").parquet(golden)

    return normalized_stream(raw).writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
