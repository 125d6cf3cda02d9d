"""Reports over reviews and rating summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.operators import reviews
from ludoshelf.plans import workload
from ludoshelf.plans.workload import PAGE_RANGE, table
from ludoshelf.sources.staging import Staging


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = reviews.landed_reviews(workload.review_pages(spark, sf_dir))
    return reviews.review_pages(read.where(F.col("error").isNull()))


# Labelled documents as reviews, with the page they lie on and their place in it.
REVIEW_ROWS = f"""
SELECT *, CAST(substr(source, 4) AS BIGINT) AS app_id, CASE quality WHEN 1 THEN 'positive' ELSE 'negative' END AS review_type,
       doc_id // {PAGE_RANGE} AS page_no,
       CASE WHEN doc_id % 5 <> 0 THEN CAST('0.' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS DOUBLE) END AS score,
       CASE WHEN doc_id % 7 <> 0 THEN 1600000000 + doc_id * 60 END AS created
FROM documents LEFT JOIN labels USING (doc_id)
"""


def review_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviews.flatten(_pages(spark, sf_dir))
    return rows.select(
        "app_id", "review_type", "page_no", "recommendation_id", "positive", "source_url", "language",
        F.unix_seconds("created_at").alias("created"), "votes_up", "weighted_vote_score", "comment_count",
        F.length("text").alias("n_chars"), F.col("author.steam_id").alias("steam_id"),
        F.col("author.reviews_written").alias("reviews_written"),
    )


REVIEW_FLATTEN = f"""
SELECT app_id, review_type, CAST(page_no AS INTEGER) AS page_no, CAST(doc_id AS VARCHAR) AS recommendation_id, COALESCE(quality = 1, false) AS positive,
       CASE WHEN doc_id % 3 <> 0 THEN 'https://steamcommunity.com/profiles/' || (doc_id % 97) || '/recommended/' || app_id || '/'
            ELSE 'https://steamcommunity.com/app/' || app_id || '/reviews/' END AS source_url,
       lang AS language, created, n_chars % 10 AS votes_up, score AS weighted_vote_score, CAST(0 AS BIGINT) AS comment_count,
       CAST(length(text) AS INTEGER) AS n_chars, CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id % 97 AS VARCHAR) END AS steam_id,
       CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS reviews_written
FROM ({REVIEW_ROWS})
"""


def bounded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n_chars"))
    return reviews.bounded_pages(turns, ["conv_id"], 4, "turn", (F.col("role") == "assistant") & (F.col("n_chars") > 300))


BOUNDED_PAGES = """
WITH kept AS (SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS n_chars FROM conversations WHERE turn < 4),
stops AS (SELECT conv_id, MIN(turn) AS stop_at FROM kept WHERE role = 'assistant' AND n_chars > 300 GROUP BY conv_id)
SELECT k.* FROM kept k LEFT JOIN stops s ON k.conv_id = s.conv_id WHERE s.stop_at IS NULL OR k.turn <= s.stop_at
"""


def chain_reviews(spark: SparkSession, sf_dir: str, k: Column) -> DataFrame:
    """Reviews of every chain up to its stop, at most the best k of a page."""
    written = Staging(spark)(_pages(spark, sf_dir), "review_pages")  # read for the flags and for the reviews
    pages = reviews.bounded_pages(written, ["app_id", "review_type"], None, stop=reviews.chain_stop())
    return reviews.flatten(pages, k)


def review_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = reviews.most_detailed(chain_reviews(spark, sf_dir, F.lit(4)), 4)
    return best.select("app_id", "review_type", "rank", "recommendation_id", F.length("text").alias("n_chars"), "votes_up")


# A chain of every fifth app repeats its cursor on page 3, where it has that page, and ends there.
CHAIN_ROWS = f"""
SELECT * FROM (SELECT *, bool_or(page_no = 3) OVER (PARTITION BY app_id, review_type) AS has_third FROM ({REVIEW_ROWS}))
WHERE app_id % 5 <> 0 OR page_no <= 3 OR NOT has_third
"""
REVIEW_TOPK = f"""
SELECT app_id, review_type, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS VARCHAR) AS recommendation_id,
       CAST(length(text) AS INTEGER) AS n_chars, n_chars % 10 AS votes_up FROM (
  SELECT *, row_number() OVER (PARTITION BY app_id, review_type ORDER BY
    length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) DESC, COALESCE(score, 0) DESC, n_chars % 10 DESC, created DESC NULLS LAST, doc_id) AS rank
  FROM ({CHAIN_ROWS})) WHERE rank <= 4
"""


def review_topk_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a count per product: its id plus one."""
    wanted = (F.col("app_id") + 1).cast("int")
    best = reviews.most_detailed(chain_reviews(spark, sf_dir, wanted), wanted)
    return best.groupBy("app_id", "review_type").agg(
        F.count("*").alias("n"), F.max("rank").alias("last_rank"), F.sum(F.length("text")).alias("chars")
    )


REVIEW_TOPK_ASKED = f"""
SELECT app_id, review_type, COUNT(*) AS n, CAST(MAX(rank) AS INTEGER) AS last_rank, CAST(SUM(length(text)) AS BIGINT) AS chars FROM (
  SELECT *, row_number() OVER (PARTITION BY app_id, review_type ORDER BY
    length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) DESC, COALESCE(score, 0) DESC, n_chars % 10 DESC, created DESC NULLS LAST, doc_id) AS rank
  FROM ({CHAIN_ROWS})) WHERE rank <= app_id + 1 GROUP BY 1, 2
"""


def unique_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews landed twice count once when asked for."""
    rows = reviews.flatten(_pages(spark, sf_dir)).withColumn(
        "recommendation_id", (F.col("recommendation_id").cast("bigint") % 50).cast("string")
    )
    return reviews.unique_reviews(rows).select(
        "app_id", "review_type", "recommendation_id", "page_no", F.length("text").alias("n_chars")
    )


UNIQUE_REVIEWS = f"""
SELECT app_id, review_type, CAST(doc_id % 50 AS VARCHAR) AS recommendation_id, CAST(MIN(page_no) AS INTEGER) AS page_no,
       CAST(length(arg_min(text, doc_id)) AS INTEGER) AS n_chars
FROM ({REVIEW_ROWS}) GROUP BY app_id, review_type, doc_id % 50
"""


def landed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = reviews.landed_reviews(workload.review_summaries(spark, sf_dir))
    told = reviews.told_summaries(read.where(F.col("error").isNull()))
    return told.drop("store_country")


VOTES = "SELECT CAST(substr(source, 4) AS BIGINT) AS app_id, lang, COALESCE(quality, 0) AS quality FROM documents LEFT JOIN labels USING (doc_id)"
LANDED_SUMMARY = f"""
WITH counted AS (
  SELECT app_id, lang, SUM(quality)::BIGINT AS up, COUNT(*) - SUM(quality)::BIGINT AS down FROM ({VOTES}) GROUP BY GROUPING SETS ((app_id), (app_id, lang)))
SELECT app_id, lang AS locale, CASE lang WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' WHEN 'fr' THEN 'french' WHEN 'es' THEN 'spanish' ELSE 'all' END AS review_language, CAST(9 AS BIGINT) AS score, 'Fine' AS score_description,
       up AS total_positive, down AS total_negative,
       CASE app_id % 3 WHEN 0 THEN 0 WHEN 1 THEN up + down + 5 ELSE up + down END AS total_reviews,
       round_even(up * 100 / (up + down), 2) AS positive_percent
FROM counted
"""


def _half_up(up: Column, down: Column) -> Column:
    """Plain rounding, as SQL engines do it."""
    return F.round(up * F.lit(100) / (up + down), 2)


def rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = workload.labelled_documents(spark, sf_dir)
    return reviews.recomputed_summaries(votes, "source", "lang", F.coalesce(F.col("quality") == 1, F.lit(False)), rounding=_half_up)


RATING_SUMMARY = """
SELECT source, lang, GROUPING(lang) = 0 AS per_language, SUM(COALESCE(quality, 0))::BIGINT AS total_positive, COUNT(*) - SUM(COALESCE(quality, 0))::BIGINT AS total_negative,
       COUNT(*) AS total_reviews, round(SUM(COALESCE(quality, 0)) * 100::DOUBLE / COUNT(*), 2) AS positive_percent
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((source), (source, lang))
"""


def shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "documents").groupBy("source").agg((F.count("*") % 20).alias("extra"))
    asked = sources.select(
        "source", F.explode(F.array(F.lit(0), F.lit(1))).alias("quality"), (F.col("extra") + 10).alias("wanted")
    )
    got = workload.labelled_documents(spark, sf_dir).select("source", "quality")
    return reviews.shortfalls(asked, got, ["source", "quality"])


SHORTFALL = """
WITH asked AS (SELECT source, unnest([0, 1]) AS quality, COUNT(*) % 20 + 10 AS wanted FROM documents GROUP BY source),
got AS (SELECT source, quality, COUNT(*) AS found FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2)
SELECT a.source, a.quality, a.wanted, COALESCE(g.found, 0) AS found
FROM asked a LEFT JOIN got g ON a.source = g.source AND a.quality = g.quality WHERE COALESCE(g.found, 0) < a.wanted
"""


REPORTS = {
    "review_flatten": (review_flatten, REVIEW_FLATTEN),
    "bounded_pages": (bounded_pages, BOUNDED_PAGES),
    "review_topk": (review_topk, REVIEW_TOPK),
    "review_topk_asked": (review_topk_asked, REVIEW_TOPK_ASKED),
    "unique_reviews": (unique_reviews, UNIQUE_REVIEWS),
    "landed_summary": (landed_summary, LANDED_SUMMARY),
    "rating_summary": (rating_summary, RATING_SUMMARY),
    "shortfall": (shortfall, SHORTFALL),
}
