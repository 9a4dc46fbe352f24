"""Line dedup over a corpus, exact and within one word, in DataFrame operations only.

Lines are split at line feeds and compared without the white space around them. A line goes if an earlier line, by
(doc_id, position), equals it, or if both have at least near_words words and one insertion, deletion or replacement of
a word makes them equal.

Near lines are found by a deletion-neighbourhood join. A line's word sequence is hashed as the XOR of hashes of
(word, position), so all its variants with one word deleted cost one running XOR. Variants are keyed by (length,
position, hash) for replacements, which meet at the same position, and by (length, hash) for insertions, which meet the
shorter line itself. Lines with equal variants are verified word by word. Two lines within the bound also share the
first or the last half of the shorter one, so only lines that share such a half with another emit variants; this
leaves none out.

Exact copies are pre-aggregated to their first occurrence before anything else, and what a document keeps is the list
of its lines' first occurrences, so a line that every document has makes no hot task.

Results for odd input: a null text stays null and an empty one empty; blank lines always stay; a null doc_id sorts
first; rows that repeat both id and text count as one document, and all of them keep what it keeps; rows that repeat
an id with another text are documents of their own; an empty table gives no rows; other columns pass through, but n_lines and n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import materialize

_SPACE = " \t\r\x0b\f"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def _words(line: Column) -> Column:
    return F.split(line, r"[ \t\r\x0B\f]+")


def _half(words: Column, p: Column, end: bool) -> Column:
    """Hash of the first or last p words."""
    return F.xxhash64(F.lit(end), F.slice(words, F.size(words) - p + 1 if end else F.lit(1), p))


def _lines(docs: DataFrame) -> DataFrame:
    """d (id), h (hash of the text), pos, line of every line that isn't blank."""
    split = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return split.withColumn("line", _trim(F.col("line"))).filter("line != ''")


def first_lines(docs: DataFrame, near_words: int) -> DataFrame:
    """k1, k2 (128-bit key), first (d, h, pos of the earliest occurrence), n (words) and the hashes of four halves."""
    words = F.col("words")
    half, less = F.floor(F.col("n") / 2).cast("int"), F.floor((F.col("n") - 1) / 2).cast("int")
    long = F.col("n") >= near_words
    lines = _lines(docs).withColumn("words", _words(F.col("line"))).withColumn("n", F.size("words"))
    halves = {"a1": _half(words, half, False), "a2": _half(words, half, True), "a3": _half(words, less, False), "a4": _half(words, less, True)}
    keyed = lines.select(F.xxhash64(F.lit(1), "line").alias("k1"), F.xxhash64(F.lit(2), "line", F.lit(3)).alias("k2"), F.struct("d", "pos", "h").alias("at"), "n", *(F.when(long, c).alias(k) for k, c in halves.items()))
    return keyed.groupBy("k1", "k2").agg(F.min("at").alias("first"), F.min("n").alias("n"), *(F.min(k).alias(k) for k in halves))


def near_lines(docs: DataFrame, firsts: DataFrame, near_words: int) -> DataFrame:
    """first (d, pos, h) of the distinct lines that have an earlier line within one word."""
    anchored = firsts.filter(F.col("n") >= near_words).select("first", F.explode(F.array_distinct(F.array("a1", "a2", "a3", "a4"))).alias("anchor"))
    shared = anchored.groupBy("anchor").agg(F.min("first").alias("low"), F.max("first").alias("high")).filter("low != high").select("anchor")
    able = anchored.join(shared, "anchor", "left_semi").select("first.d", "first.h", "first.pos").distinct()
    wanted = able.groupBy("d", "h").agg(F.collect_set("pos").alias("at"))
    keyed = docs.select(F.col("doc_id").alias("d_"), F.xxhash64("text").alias("h_"), "text")
    found = keyed.join(wanted, F.col("d_").eqNullSafe(F.col("d")) & (F.col("h_") == F.col("h")))
    picked = found.select("d", "h", F.explode("at").alias("pos"), F.split("text", "\n").alias("lines"))
    lines = materialize(picked.select(F.struct("d", "pos", "h").alias("first"), _words(_trim(F.element_at("lines", F.col("pos") + 1))).alias("words")).withColumn("n", F.size("words")), "near")
    each = lines.select("first", "n", F.posexplode("words").alias("i", "word"))
    each = each.select("first", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved"))
    line = Window.partitionBy("first")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select("first", "n", "i", "here", F.bit_xor("here").over(line).alias("whole"), F.bit_xor("here").over(upto).bitwiseXOR(F.col("here")).alias("before"), F.bit_xor("moved").over(line).bitwiseXOR(F.bit_xor("moved").over(upto)).alias("after"))
    variants = materialize(
        each.select(
            "first", "i", F.xxhash64("n", "i", F.col("whole").bitwiseXOR(F.col("here"))).alias("replaced"), F.xxhash64(F.col("n") - 1, F.col("before").bitwiseXOR(F.col("after"))).alias("deleted"), F.when(F.col("i") == 0, F.xxhash64("n", "whole")).alias("itself")
        ),
        "variants",
    )
    hubs = variants.groupBy("replaced").agg(F.min("first").alias("hub"), F.max("first").alias("last")).filter("hub != last")
    replaced = variants.join(hubs, "replaced").filter("first != hub").select(F.col("hub").alias("early"), F.col("first").alias("late"), F.lit(-1).alias("i"))
    shorter = variants.filter("itself is not null").select(F.col("itself").alias("deleted"), F.col("first").alias("short"))
    deleted = variants.select("deleted", "first", "i").join(shorter, "deleted").select(F.least("short", "first").alias("early"), F.greatest("short", "first").alias("late"), "i")
    pairs = replaced.union(deleted).groupBy("early", "late").agg(F.max("i").alias("i"))
    one, two = (lines.select(F.col("first").alias(k), F.col("words").alias(f"{k}_words")) for k in ("early", "late"))
    both = pairs.join(one, "early").join(two, "late")
    a, b = F.col("early_words"), F.col("late_words")
    longer, short = (F.when(F.size(a) > F.size(b), x).otherwise(y) for x, y in ((a, b), (b, a)))
    mismatches = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: ~F.coalesce(same, F.lit(False))))
    without = F.concat(F.slice(longer, F.lit(1), F.col("i")), F.slice(longer, F.col("i") + 2, F.size(longer)))
    verified = F.when(F.size(a) == F.size(b), mismatches <= 1).otherwise((F.col("i") >= 0) & (without == short))
    return both.filter(verified).select(F.col("late").alias("first")).distinct()


def dedup_lines(docs: DataFrame, near_words: int = 10) -> DataFrame:
    """docs with the lines gone that have an earlier equal or near line, and n_lines (before) and n_removed.

    Blank lines are neither counted nor removed. near_words: lines of fewer words are compared exactly.
    """
    docs = docs.drop("n_lines", "n_removed")
    firsts = materialize(first_lines(docs, near_words), "lines")
    kept = firsts.select("first").join(near_lines(docs, firsts, near_words), "first", "left_anti")
    keep = kept.groupBy(F.col("first.d").alias("__line_doc"), F.col("first.h").alias("__line_hash")).agg(F.collect_set("first.pos").alias("__kept_lines"))
    joined = docs.join(keep, docs["doc_id"].eqNullSafe(keep["__line_doc"]) & (F.xxhash64(docs["text"]) == keep["__line_hash"]), "left")
    lines = F.split("text", "\n")
    some = F.coalesce("__kept_lines", F.array().cast("array<int>"))
    stays = F.filter(lines, lambda line, i: (_trim(line) == "") | F.array_contains(some, i))
    total = F.size(F.filter(lines, lambda line: _trim(line) != ""))
    counted = joined.select(*(docs[c] for c in docs.columns if c != "text"), F.array_join(stays, "\n").alias("text"), F.coalesce(total, F.lit(0)).alias("n_lines"), (F.coalesce(total, F.lit(0)) - F.size(some)).alias("n_removed"))
    return counted.select(*docs.columns, "n_lines", "n_removed")
