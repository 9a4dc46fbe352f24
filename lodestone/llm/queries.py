"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import html, linededup, maxent, minhash, mixing, packing, topk, toxicity, trie_dedup, urlfilter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op2_trie_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_dedup.exact_dedup(_read(spark, sf_dir, "documents"), keep="max")


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).drop("copies", "source")


def op4_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op5_maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(_read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))
    held_out = toxicity.crc32_mod(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch day from the URL's MD5, as the pages table has no fetch time."""
    day = F.conv(F.substring(F.md5("url"), 1, 6), 16, 10).cast("int") % 1461
    return pages.select("page_id", "url", day.alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the tables' own hosts, their parent domains and hosts with a first path segment: of every eight, by the pattern's MD5, three are added on some day, two of them are removed later and one is added once more."""
    name, path = urlfilter.host(F.col("url")), urlfilter.first_path(F.col("url"))
    parent = F.when(F.size(F.split(name, r"\.")) > 2, F.regexp_replace(name, r"^[^.]*\.", ""))
    hosts = pages.select(F.explode(F.array(name, parent, F.when(path != "", F.concat(name, path)))).alias("pattern")).filter("pattern is not null").distinct()
    number = lambda at: F.conv(F.substring(F.md5("pattern"), at, 6), 16, 10).cast("int")
    hosts = hosts.select("pattern", (number(1) % 8).alias("turn"), (number(7) % 1000).alias("first"), (number(13) % 300 + 1).alias("span"))
    entry = lambda action, day, when: hosts.filter(when).select("pattern", F.lit(action).alias("action"), day.alias("day"))
    first, span = F.col("first"), F.col("span")
    return entry("add", first, "turn < 3").union(entry("remove", first + span, "turn < 2")).union(entry("add", first + 2 * span, "turn < 1"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return urlfilter.blocked_captures(dated_captures(pages), dated_entries(pages))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    ops = (op1_pivot_topk, op2_trie_dedup, op3_systematic_mix, op4_best_fit_pack, op5_maxent_score, op6_line_dedup, op7_minhash, op8_toxicity, op9_url_filter, op10_html_text, pipeline)
    return {f.__name__: f for f in ops}


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP2_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""

OP3_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1)::INT % 3 + 1]::DOUBLE AS weight, 2.0 * source_size AS cap FROM s
), o AS (  -- sources in the order in which rising water reaches their caps
  SELECT *, sum(cap) OVER f AS caps, sum(weight) OVER f AS weights, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights
  FROM w WINDOW f AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), full_ AS (  -- a source is full if, with all before it full, its share would be above its cap
  SELECT *, (1.5 * total - (caps - cap)) / (all_weights - (weights - weight)) * weight > cap AS is_full FROM o
), t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
    ((1.5 * total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)) / (all_weights - coalesce(sum(CASE WHEN is_full THEN weight END) OVER (), 0)) * weight) END::DOUBLE AS target
  FROM full_
), e AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    least(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 4294967296) ELSE 0 END, 8589934592)::BIGINT AS expected,
    ('0x' || substr(md5('0/' || coalesce(d.source, '')), 1, 8))::BIGINT AS start
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, start + sum(expected) OVER (PARTITION BY source ORDER BY size, md5(coalesce(doc_id::VARCHAR, '')), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM e
)
SELECT doc_id, size, source_size, target, ((upto // 4294967296 - (upto - expected) // 4294967296) * size)::BIGINT AS taken FROM p
"""

OP9_SQL = """
WITH c AS (
  SELECT page_id, url, (('0x' || substr(md5(url), 1, 6))::INT % 1461)::INT AS fetched,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^/?#]+)', 1) AS path,
    row_number() OVER () AS row FROM pages
), h AS (
  SELECT host AS pattern FROM c WHERE host IS NOT NULL
  UNION SELECT regexp_replace(host, '^[^.]*\\.', '') FROM c WHERE len(string_split(host, '.')) > 2
  UNION SELECT host || path FROM c WHERE host IS NOT NULL AND path <> ''
), n AS (
  SELECT pattern, ('0x' || substr(md5(pattern), 1, 6))::INT % 8 AS turn, ('0x' || substr(md5(pattern), 7, 6))::INT % 1000 AS first_,
    ('0x' || substr(md5(pattern), 13, 6))::INT % 300 + 1 AS span FROM h
), i AS (  -- what the adds and removes of the list amount to
  SELECT pattern, first_ AS since, CASE WHEN turn < 2 THEN first_ + span END AS until FROM n WHERE turn < 3
  UNION ALL SELECT pattern, first_ + 2 * span, NULL FROM n WHERE turn < 1
), k AS (
  SELECT row, fetched, host AS key FROM c
  UNION SELECT row, fetched, host || path FROM c WHERE path <> ''
  UNION SELECT row, fetched, array_to_string(list_slice(string_split(host, '.'), g, len(string_split(host, '.'))), '.') FROM c, range(2, 20) r(g) WHERE g < len(string_split(host, '.'))
), m AS (
  SELECT k.row, i.pattern, i.since, row_number() OVER (PARTITION BY k.row ORDER BY length(i.pattern) DESC, i.pattern, i.since) AS place
  FROM k JOIN i ON k.key = i.pattern AND i.since <= k.fetched AND (i.until IS NULL OR k.fetched < i.until)
)
SELECT c.page_id, c.url, c.fetched, m.pattern IS NOT NULL AS blocked, m.pattern, m.since::INT AS since
FROM c LEFT JOIN m ON c.row = m.row AND m.place = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_pivot_topk": OP1_SQL, "op2_trie_dedup": OP2_SQL, "op3_systematic_mix": OP3_SQL, "op9_url_filter": OP9_SQL}
