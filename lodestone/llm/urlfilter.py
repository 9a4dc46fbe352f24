"""URL filter by a temporal join with dated lists.

List entries (pattern, action, day) become validity intervals: an add opens one for its pattern and the pattern's
next remove closes it. An as-of join then evaluates every capture against the entries active at its fetch time: the keys of a
URL, which are its host, the host's parent domains and host and first path segment, and the intervals of the same
pattern are put in one order by time, the interval that began last is carried forward to each key, and it counts if it has not ended.

What a list says of a URL depends on its host, first path segment and day alone, so captures are first reduced to the
distinct ones of these; a host that a third of all captures have costs as many rows as there are days. The verdict goes
back to the captures by an equi-join, whose hot keys AQE can split, with one row a key on its other side.

Results for odd input: a null URL, or one without a host, is never listed; a null fetch time meets no interval; entries
with a null pattern, action or day are ignored; repeated adds keep one interval open, a remove without an add does
nothing, and of a remove and an add on one day the remove counts first; repeated captures each give a row; empty
captures give no rows and empty lists block nothing; other columns of captures pass through, but columns named blocked, pattern
or since are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^/?#]+)"


def host(url: Column) -> Column:
    """The URL's host in lower case, or null."""
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def first_path(url: Column) -> Column:
    """The URL's first path segment with its slash, or empty text."""
    return F.regexp_extract(url, _PATH, 1)


def host_keys(name: Column, path: Column) -> Column:
    """The patterns that list a URL of this host and first path segment: host and its parent domains of two labels or more, and host and segment."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    parents = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.array_join(F.slice(labels, k, n), "."))).otherwise(F.array(name))
    return F.array_distinct(F.when(path != "", F.array_append(parents, F.concat(name, path))).otherwise(parents))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, since, until (exclusive; null: still open) of entries (pattern, action "add" or "remove", day)."""
    adds = F.col("action") == "add"
    by = Window.partitionBy("pattern").orderBy("day", F.desc("action"))  # "remove" before "add"
    known = entries.filter("pattern is not null and day is not null and action in ('add', 'remove')").select("pattern", "action", "day")
    turns = known.withColumn("before", F.lag("action").over(by)).filter(F.coalesce(F.col("before"), F.lit("remove")) != F.col("action"))
    return turns.withColumn("until", F.lead("day").over(by)).filter(adds).select("pattern", F.col("day").alias("since"), "until")


def as_of(keys: DataFrame, active: DataFrame) -> DataFrame:
    """key, at, since of the distinct keys (key, at) whose pattern has an interval (pattern, since, until) that holds at."""
    none = F.lit(None)
    starts = active.select(F.col("pattern").alias("key"), F.col("since").alias("at"), F.lit(0).alias("is_key"), F.struct("since", "until").alias("span"))
    asked = keys.select("key", "at", F.lit(1), none.cast(starts.schema["span"].dataType))
    before = Window.partitionBy("key").orderBy("at", "is_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = starts.union(asked).withColumn("span", F.last("span", ignorenulls=True).over(before))
    held = latest.filter("is_key = 1 and span is not null and (span.until is null or at < span.until)")
    return held.select("key", "at", F.col("span.since").alias("since"))


def blocked_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """captures with blocked boolean, pattern (the longest that lists it, ties to the smaller) and since (when that began)."""
    captures = captures.drop("blocked", "pattern", "since")
    named = captures.select("*", host(F.col(url)).alias("__host"), first_path(F.col(url)).alias("__path"))
    places = named.filter(F.col("__host").isNotNull() & F.col(fetched).isNotNull()).select("__host", "__path", F.col(fetched).alias("at")).distinct()
    keys = places.select("__host", "__path", "at", F.explode(host_keys(F.col("__host"), F.col("__path"))).alias("key"))
    active = as_of(keys.select("key", "at").distinct(), intervals(entries))
    best = keys.join(active, ["key", "at"]).groupBy("__host", "__path", "at").agg(F.min(F.struct((-F.length("key")).alias("n"), "key", "since")).alias("hit"))
    hit = best.select(F.col("__host").alias("__h"), F.col("__path").alias("__p"), "at", F.col("hit.key").alias("pattern"), F.col("hit.since").alias("since"))
    joined = named.join(hit, (F.col("__host") == F.col("__h")) & (F.col("__path") == F.col("__p")) & (F.col(fetched) == F.col("at")), "left")
    return joined.select(*(named[c] for c in captures.columns), F.col("pattern").isNotNull().alias("blocked"), "pattern", "since")
