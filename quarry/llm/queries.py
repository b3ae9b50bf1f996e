"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import alignment, decontaminate, language_id, line_dedup, lm_scoring, minhash_dedup, packing, pii, quality, spelling, suffix_dedup, topk_search, toxicity
from quarry.llm._scratch import Scratch


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _fold(column: str, folds: int = 5):
    return F.crc32(F.col(column).cast("string")) % folds


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_score(_read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    done = line_dedup.line_dedup(pages, line_dedup.url_host(F.col("url")), line_dedup.html_lines(F.col("html")))
    return done.select("page_id", "__line_dedup.host", "__line_dedup.n_lines", "__line_dedup.n_dropped", F.md5("__line_dedup.clean").alias("clean_md5"))


ORACLE_2 = r"""
WITH page AS (
  SELECT row_number() OVER () AS page, page_id, html IS NULL AS empty,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
           '(?is)<(script|style)\b.*?(</(script|style)\s*>|\z)|<!--.*?(-->|\z)', chr(10), 'g'),
           '(?i)</?(b|i|em|strong|a|span|u|code)\b[^<>]*>', '', 'g'),
           '<[^<>]*>', chr(10), 'g'), '\n\s*\n', chr(10), 'g') AS text
  FROM pages),
line AS (SELECT page, host, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM page),
counts AS (SELECT host, trim(line, ' ') AS line, count(DISTINCT page) AS n FROM line WHERE trim(line, ' ') <> '' GROUP BY ALL),
totals AS (SELECT host, count(*) AS total FROM page GROUP BY host),
bad AS (SELECT c.host, line FROM counts c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host WHERE n >= 3 AND n > total * 0.1::DOUBLE),
marked AS (SELECT l.page, l.pos, l.line, b.line IS NOT NULL AS gone FROM line l LEFT JOIN bad b ON l.host IS NOT DISTINCT FROM b.host AND trim(l.line, ' ') = b.line),
done AS (
  SELECT page, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS clean_md5
  FROM marked GROUP BY page)
SELECT page_id, host, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_dropped, 0) AS INTEGER) AS n_dropped,
       CASE WHEN NOT empty THEN clean_md5 END AS clean_md5
FROM page LEFT JOIN done USING (page)
"""


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLE_4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(_read(spark, sf_dir, "documents").select("doc_id", "text"), key="quarry")
    return done.select("doc_id", "__pii.n_entities", "__pii.kinds", F.col("__pii.text").alias("text"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(_read(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("__hits.item"))
    return found.select("doc_id", (F.size("__hits") > 0).alias("contaminated"), items.alias("item_ids"), F.size("__hits").alias("n_regions"), F.array_min("__hits.edits").alias("least_edits"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = packing.pack(_read(spark, sf_dir, "documents"))
    return done.select("doc_id", "piece", "n_tokens", "start", "end", F.md5("text").alias("text_md5"), "bucket", "batch", "padding")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    measured = Scratch(spark, "quality").keep(quality.measure(docs), "stats")
    scored = quality.score_measured(measured, quality.fit(measured, labels))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(_fold("id") == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", F.coalesce(_fold("doc_id") == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_read(spark, sf_dir, "documents")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.annotate(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = alignment.align(docs).select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "pairs", "times")
    done = alignment.weigh(aligned)
    long = lambda *names: (F.col(c).cast("long").alias(c) for c in names)
    return done.select("doc_id", *long("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm": op1_lm,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash": op3_minhash,
    "op4_topk": op4_topk,
    "op5_pii": op5_pii,
    "op6_suffix": op6_suffix,
    "op7_decontaminate": op7_decontaminate,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_language": op10_language,
    "op11_spelling": op11_spelling,
    "op12_toxicity": op12_toxicity,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {"op2_line_dedup": ORACLE_2, "op4_topk": ORACLE_4}
