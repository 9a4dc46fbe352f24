from lodestone.plans import adapters, consolidate
from lodestone.streaming.incremental import keep_golden, normalized_stream, raw_stream
from pyspark.sql import functions as F


def test_stream_gives_what_a_batch_gives(spark, sf_dir, tmp_path):
    raw = adapters.structured(spark, sf_dir).filter("seq < 60").withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))
    for part in (0, 1):
        raw.filter(F.col("seq") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    keep_golden(raw_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "store"), str(tmp_path / "golden"), str(tmp_path / "check")).awaitTermination()
    ids = lambda df: {(r["master_candidate_id"], r["confidence"]["overall_score"]) for r in df.select("master_candidate_id", "confidence").collect()}
    assert ids(spark.read.parquet(str(tmp_path / "golden"))) == ids(consolidate.golden(normalized_stream(raw)))
