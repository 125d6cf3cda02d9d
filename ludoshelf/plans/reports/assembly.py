"""Reports over the assembled records and their diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.operators import assembly
from ludoshelf.plans import workload
from ludoshelf.plans.games import Collected, collect_games
from ludoshelf.plans.reports.pages import NAMED_ITEMS
from ludoshelf.plans.reports.reviews import REVIEW_ROWS, VOTES
from ludoshelf.plans.workload import table
from ludoshelf.sources.landing import read_landing, write_landing
from ludoshelf.sources.staging import Staging


def _collected(spark: SparkSession, sf_dir: str) -> Collected:
    stage = Staging(spark)
    landed = stage.path("landing")
    for part in workload.landing_parts(spark, sf_dir):  # only one kind's bodies are shuffled at a time
        write_landing(part, landed)
    _, results = workload.order_searches(spark, sf_dir)
    candidates = stage(results.withColumn("error", F.lit(None).cast("string")), "candidates")
    return collect_games(
        read_landing(spark, landed), workload.part_requests(spark, sf_dir), candidates, stage=stage
    )


def game_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _collected(spark, sf_dir).games
    english = F.col("localizations")["en-US"]
    return games.select(
        "app_id",
        english["name"].alias("name"),
        english["full_description"]["text"].alias("full_text"),
        F.size("localizations").alias("n_locales"),
        "type",
        "is_free",
        F.array_join("genres", " ").alias("genres"),
        F.array_join(F.transform("supported_languages", lambda x: x["name"]), ",").alias("languages"),
        F.size("tags").alias("n_tags"),
        F.size("achievements").alias("n_achievements"),
        F.col("steam_rating.total_positive").alias("rated_up"),
        F.size("ratings_by_locale").alias("n_ratings"),
        F.array_join(F.transform("reviews.positive", lambda r: r["recommendation_id"]), ",").alias("positive"),
        F.array_join(F.transform("reviews.negative", lambda r: r["recommendation_id"]), ",").alias("negative"),
        F.col("metacritic.critic_score").alias("critic_score"),
        F.col("how_long_to_beat.name").alias("hours_name"),
        F.array_join(F.transform("diagnostics", lambda d: d["code"]), ",").alias("codes"),
    )


# The record of every part, from the tables alone. ``picked`` are the reviews of whole chains within three pages.
GAMES = f"""
WITH apps AS (SELECT *, p_partkey AS k, p_partkey % 4 <> 3 AND p_partkey % 10 <> 9 AS scored FROM part WHERE p_size <> 50),
tags AS (SELECT page_id AS k, COUNT(*) AS n FROM ({NAMED_ITEMS}) WHERE name <> '' GROUP BY 1),
votes AS (SELECT app_id AS k, SUM(quality)::BIGINT AS up, bool_or(lang = 'de') AS german, bool_or(lang = 'en') AS english FROM ({VOTES}) GROUP BY 1),
window_rows AS (SELECT * FROM (SELECT *, MAX(page_no) OVER (PARTITION BY app_id, review_type) AS last FROM ({REVIEW_ROWS})) WHERE page_no < 3),
chains AS (SELECT app_id AS k, review_type FROM window_rows GROUP BY 1, 2
  HAVING COUNT(DISTINCT page_no) = MAX(page_no) + 1 AND (MAX(page_no) = 2 OR MAX(page_no) = MAX(last))),
ranked AS (SELECT w.app_id AS k, w.review_type, w.doc_id, row_number() OVER (PARTITION BY w.app_id, w.review_type ORDER BY
    length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) DESC, COALESCE(score, 0) DESC, n_chars % 10 DESC, created DESC NULLS LAST, doc_id) AS rank
  FROM window_rows w JOIN chains c ON w.app_id = c.k AND w.review_type = c.review_type),
picked AS (SELECT k, string_agg(CASE WHEN review_type = 'positive' AND rank <= 4 THEN doc_id END, ',' ORDER BY rank) AS positive,
    string_agg(CASE WHEN review_type = 'negative' AND rank <= 2 THEN doc_id END, ',' ORDER BY rank) AS negative,
    COUNT(CASE WHEN review_type = 'positive' AND rank <= 4 THEN 1 END) AS n_up, COUNT(CASE WHEN review_type = 'negative' AND rank <= 2 THEN 1 END) AS n_down
  FROM ranked GROUP BY k),
results AS (SELECT a.k, p.p_name AS game_name, CASE WHEN a.p_name = p.p_name THEN 1.0::DOUBLE
    ELSE 1 - levenshtein(a.p_name, p.p_name)::DOUBLE / greatest(length(a.p_name), length(p.p_name)) END AS similarity, l_linenumber, l_partkey, l_suppkey
  FROM apps a JOIN lineitem l ON l.l_orderkey = a.k AND l.l_linenumber > 1 JOIN part p ON l.l_partkey = p.p_partkey),
best AS (SELECT k, arg_min(game_name, (-similarity, l_linenumber, l_partkey, l_suppkey)) AS game_name, MAX(similarity) AS similarity FROM results GROUP BY k)
SELECT a.k AS app_id, a.p_name AS name, CASE WHEN p_size % 3 = 0 THEN 'About ' || a.p_name ELSE 'Made by ' || p_brand END AS full_text,
  CAST(CASE WHEN p_size % 7 = 0 THEN 1 ELSE 2 END AS INTEGER) AS n_locales, p_type AS type,
  CASE a.k % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS is_free, a.p_name AS genres,
  CASE WHEN pg.page_id IS NOT NULL AND a.k % 4 <> 0 THEN 'English,Page ' || a.k ELSE 'English,Klingon' END AS languages,
  CAST(COALESCE(t.n, 0) AS INTEGER) AS n_tags, CAST(COALESCE(t.n, 0) AS INTEGER) AS n_achievements, v.up AS rated_up,
  CAST(COALESCE(v.german, false)::INTEGER + COALESCE(v.english, false)::INTEGER AS INTEGER) AS n_ratings,
  COALESCE(r.positive, '') AS positive, COALESCE(r.negative, '') AS negative,
  CAST(COALESCE(CASE WHEN scored THEN CASE a.k % 5 WHEN 0 THEN p_size WHEN 2 THEN p_size WHEN 3 THEN CASE WHEN p_size + 60 <= 100 THEN p_size + 60 END END END,
       CASE WHEN a.k % 4 < 2 THEN p_size END) AS BIGINT) AS critic_score,
  CASE WHEN b.similarity >= 0.65 THEN b.game_name END AS hours_name,
  concat_ws(',', CASE WHEN p_size % 7 = 0 THEN 'localized_details_failed' END, CASE WHEN pg.page_id IS NULL THEN 'page_unavailable,page_unavailable' END,
    CASE WHEN v.k IS NULL THEN 'summary_unavailable' END, CASE WHEN v.german IS NOT TRUE THEN 'localized_summary_unavailable' END,
    CASE WHEN v.english IS NOT TRUE THEN 'localized_summary_unavailable' END,
    CASE WHEN up.k IS NULL THEN 'positive_reviews_unavailable' END, CASE WHEN down.k IS NULL THEN 'negative_reviews_unavailable' END,
    CASE WHEN COALESCE(r.n_up, 0) < 4 THEN 'insufficient_positive_reviews' END, CASE WHEN COALESCE(r.n_down, 0) < 2 THEN 'insufficient_negative_reviews' END,
    CASE WHEN b.k IS NULL THEN 'not_found' WHEN b.similarity < 0.65 THEN 'ambiguous_match' END, CASE WHEN NOT scored THEN 'request_failed' END) AS codes
FROM apps a LEFT JOIN pages pg ON pg.page_id = a.k LEFT JOIN tags t ON t.k = a.k LEFT JOIN votes v ON v.k = a.k LEFT JOIN picked r ON r.k = a.k
LEFT JOIN chains up ON up.k = a.k AND up.review_type = 'positive' LEFT JOIN chains down ON down.k = a.k AND down.review_type = 'negative'
LEFT JOIN best b ON b.k = a.k
"""


def diagnostics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _collected(spark, sf_dir).diagnostics
    return found.groupBy("code", "severity").agg(F.count("*").alias("n"), F.countDistinct("app_id").alias("apps"))


DIAGNOSTICS_UNION = f"""
SELECT code, 'warning' AS severity, COUNT(*) AS n, COUNT(DISTINCT app_id) AS apps
FROM (SELECT app_id, unnest(string_split(codes, ',')) AS code FROM ({GAMES})) WHERE code <> '' GROUP BY code
"""


def required_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    kept, failed = assembly.required(documents, table(spark, sf_dir, "labels"), "doc_id")
    both = kept.withColumn("outcome", F.lit("kept")).unionByName(failed.withColumn("outcome", F.lit("failed")))
    return both.groupBy("outcome", "lang").agg(F.count("*").alias("n"))


REQUIRED_SOURCE = """
SELECT CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'kept' END AS outcome, lang, COUNT(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2
"""


REPORTS = {
    "game_assembly": (game_assembly, GAMES),
    "diagnostics_union": (diagnostics_union, DIAGNOSTICS_UNION),
    "required_source": (required_source, REQUIRED_SOURCE),
}
