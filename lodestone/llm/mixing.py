"""Mixing sources to target weights by systematic sampling.

Within a source every document has an expected number of copies. Their prefix sum, in an order by size, gets one
random offset per source, and a document is emitted once per integer boundary that its share of the line crosses.
Ordering by size makes the words taken stay within about one document of the source's target.

The prefix sum is distributed: rows are dealt by range over (source, size, hash), each range is summed by itself, and
the ranges' totals give the offsets, so a source with a third of all rows is spread over many tasks. Sums are kept
modulo 2^32 in units of 2^-32 copies, which leaves every boundary crossing exact.

Results for odd input: a null text has size 0; a null source is a source of its own and comes last; null, repeated and
tied ids are ordered by a hash of the id, then the id, and repeated rows share the copies due to them in any order; a
source whose sizes are all 0 has target 0 and nothing is taken; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1 << 32


def n_words(text: Column) -> Column:
    """Number of maximal runs of characters that are not ASCII white space."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     "))
    return F.when(spaced == "", 0).otherwise(F.size(F.split(spaced, " +"))).cast("long")


def offset32(source: Column, seed: int) -> Column:
    """The random offset of a source, in units of 2^-32."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(source, F.lit("")))), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target for each row of sizes (source, source_size).

    Sources in code point order, null last, weigh weights, repeating. Together they get share times all sizes; targets
    stop at most times their source's size and the excess is reshared by weight until none is above: each round stops
    the sources that are above, so it ends after as many rounds as sources at most. Only totals reach the driver.
    """
    # One row per source; sources are few beside rows, and a global rank needs an order over them.
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    state = materialize(ranked.select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")), "sources")
    cap = F.col("source_size") * float(most)
    while True:
        free = ~F.col("full")
        t = state.agg(F.sum("source_size"), F.sum(F.when(F.col("full"), cap)), F.sum(F.when(free, F.col("weight")))).first()
        left, weigh = share * (t[0] or 0) - (t[1] or 0.0), t[2] or 1.0
        target = F.when(F.col("full"), cap).otherwise(F.lit(float(left)) / F.lit(float(weigh)) * F.col("weight"))
        now = state.withColumn("over", free & (target > cap))
        if not now.filter("over").limit(1).count():
            return state.select("source", "source_size", target.cast("double").alias("target"))
        state = materialize(now.select("source", "source_size", "weight", (F.col("full") | F.col("over")).alias("full")), "sources")


def systematic_copies(rows: DataFrame, order: list[str], seed: int = 0) -> DataFrame:
    """rows (source, expected long in units of 2^-32 copies, the columns of order, ...) with copies long.

    order must be columns of rows; ties are broken in any way.
    """
    dealt = materialize(rows.repartitionByRange("source", *order).sortWithinPartitions("source", *order).withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "dealt")
    sums = dealt.groupBy("source", "part").agg(F.sum("expected").alias("total"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", ((F.coalesce(F.sum(F.col("total") % UNIT).over(before), F.lit(0)) + offset32(F.col("source"), seed)) % UNIT).alias("start"))
    within = Window.partitionBy("source", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("upto", F.sum("expected").over(within)).withColumnRenamed("source", "_source").withColumnRenamed("part", "_part")
    joined = placed.join(starts, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_part") == F.col("part")))
    crossed = F.expr(f"(start + upto) div {UNIT} - (start + upto - expected) div {UNIT}")
    return joined.withColumn("copies", crossed).drop("_source", "_part", "part", "row", "upto", "start", "expected")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source and the columns of carry, of every document.

    Sizes are words. share: the mix's size as a part of all sizes. most: the copies no document exceeds.
    """
    sized = docs.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size"), *carry)
    sized = materialize(sized, "sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    rates = targets.select(F.col("source").alias("s"), "source_size", "target", F.least(rate, F.lit(int(most * UNIT))).alias("expected"))
    rows = sized.join(rates, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("hash", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    out = systematic_copies(rows, ["size", "hash", "doc_id"], seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("copies").cast("int").alias("copies"), "source", *carry)
