"""Corpus pipeline: toxicity, line dedup, near-duplicate removal, mixing and packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs. All but the last return the columns of docs, whatever
further columns it has, even of names that an operator uses.

Results for odd input: an empty table gives an empty one in every stage. A null text counts as empty, isn't toxic, has no lines,
is no near duplicate, has size 0 in the mix, and packs as the end token alone; null texts stay null until then. Rows with a null id go through toxicity, line dedup
(where they come first), mixing and packing like any other, and are never near duplicates. Rows that repeat an id with another
text are documents of their own in every stage; of rows that repeat both id and text line dedup keeps the same lines in each, and
the near-duplicate stage one row. Equal sizes are mixed in the order of a hash of the id. Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm import linededup, minhash, mixing, packing, toxicity
from lodestone.llm.common import materialize, release


def _renamed(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with its own columns of these names put aside, and where each column of docs is."""
    place = {c: f"__own_{c}" if c in names else c for c in docs.columns}
    return docs.withColumnsRenamed({c: at for c, at in place.items() if c != at}), place


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5. It learns from labelled rows of docs whose crc32(doc_id as text) mod 5 isn't 0."""
    own, place = _renamed(docs, "toxicity")
    model = toxicity.fit(own, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(own, model).filter("toxicity < 0.5").select(*(F.col(at).alias(c) for c, at in place.items()))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that an earlier line equals or nearly equals; n_chars follows the text. Documents go whose every line went."""
    own, place = _renamed(docs, "n_lines", "n_removed")
    done = linededup.dedup_lines(own).filter("n_lines = 0 or n_removed < n_lines")
    chars = lambda: F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*((chars() if c == "n_chars" else F.col(at)).alias(c) for c, at in place.items()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, and of those that repeat it the one with the smallest text. Of rows that repeat both id and text, one stays."""
    dealt = docs.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    keyed = materialize(dealt.withColumn("__row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "keyed")  # in the order of ids and texts
    found = minhash.near_duplicates(keyed.select(F.col("__row").alias("doc_id"), "text"))
    out = found.filter("not kept").select(F.col("doc_id").alias("__copy"))
    left = keyed.join(out, keyed["__row"] == out["__copy"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text"), "text").orderBy("__row"))
    with_id = left.filter(F.col("doc_id").isNotNull()).withColumn("__turn", turn).filter("__turn = 1").select(*docs.columns)
    return with_id.union(left.filter(F.col("doc_id").isNull()).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    keyed = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    taken = mixing.mix(keyed, carry=("__row",)).select(F.col("__row").alias("__taken"), F.col("copies").alias("__copies"))
    joined = keyed.join(taken, F.col("__row") == F.col("__taken"))
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, placed in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("near duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: SQL can't express the learned, hashed and packed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, over documents; each one's result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
