"""Records from tables, in any format that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import planned
from lodestone.sources.recruiter_csv import REQUIRED, not_blank, record_id, row_text


def structured_records(rows: DataFrame, source_name: str = "table") -> DataFrame:
    """Raw records of rows (seq long, source_type string and the seven columns of a recruiter row)."""
    value = lambda c: F.col(c)
    text = row_text(REQUIRED, value)
    none = F.lit(None).cast("string")
    return planned(rows).filter(not_blank(REQUIRED, value)).select(
        record_id(F.lit(source_name), F.col("seq").cast("string"), text).alias("record_id"),
        F.col("seq").cast("long").alias("seq"),
        F.lit(source_name).alias("source_name"),
        "source_type",
        none.alias("file_name"),
        none.alias("file_path"),
        none.alias("mime_type"),
        none.alias("checksum_sha256"),
        none.alias("batch_id"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.array(*map(F.lit, REQUIRED)).alias("fieldnames"),
        F.create_map(*(x for c in REQUIRED for x in (F.lit(c), F.col(c)))).alias("payload"),
        text.alias("raw_text"),
        F.array(F.lit("recruiter"), F.lit("table")).alias("tags"),
    )


def union_sources(*sources: DataFrame) -> DataFrame:
    """All records, sources in the given order; seq then orders records within a source."""
    out, *rest = (s.withColumn("source_order", F.lit(k)) for k, s in enumerate(sources))
    for s in rest:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
