"""Reports over HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.functions.text import plain_text
from ludoshelf.operators import html_facts
from ludoshelf.plans import workload
from ludoshelf.plans.workload import table, wide


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wide(spark, sf_dir, "pages").select("page_id", plain_text("html").alias("text"))
    return texts.select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


# Text nodes of a page: script and style contents stay text, other markup becomes a space. The pages name four
# entities; &amp may stand without its semicolon.
PAGE_TEXT = r"""
SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(
    regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>(.*?)</script>|<style[^>]*>(.*?)</style>|</?[a-z][^>]*>|<![^>]*>', ' \1\2 ', 'g'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS t FROM pages)
"""

ITEMS = r"""
SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href,
       unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS raw,
       generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1), 1) AS pos FROM pages
"""
NAMED_ITEMS = rf"""
SELECT page_id, href, pos, trim(regexp_replace(replace(replace(replace(raw, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')) AS name FROM ({ITEMS})
"""


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_facts.store_facts(workload.store_pages(spark, sf_dir), "app_id")


def tag_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).select("app_id", F.inline("tags")).select("app_id", "name", "source", "rank")


TAG_RANK = f"""
SELECT page_id AS app_id, name, 'audience' AS source, CAST(pos AS INTEGER) AS rank FROM ({NAMED_ITEMS}) WHERE name <> ''
"""


def tag_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = html_facts.tag_counts(_store(spark, sf_dir))
    return counts.orderBy(F.col("products").desc(), "name").limit(25)


TAG_TOP = f"""
SELECT name, COUNT(*) AS products, CAST(MIN(pos) AS INTEGER) AS best_rank FROM ({NAMED_ITEMS}) WHERE name <> ''
GROUP BY name ORDER BY products DESC, name COLLATE C LIMIT 25
"""


def html_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir).select("app_id", F.posexplode("language_matrix").alias("pos", "l"))
    return rows.select("app_id", "pos", "l.name", "l.web_code", "l.interface", "l.full_audio", "l.subtitles")


HTML_PIVOT = """
SELECT page_id AS app_id, CAST(0 AS INTEGER) AS pos, 'English' AS name, 'en' AS web_code, page_id % 2 = 0 AS interface,
       page_id % 3 = 0 AS full_audio, page_id % 5 = 0 AS subtitles FROM pages WHERE page_id % 4 <> 0
UNION ALL SELECT page_id, 1, 'Page ' || page_id, NULL, false, true, false FROM pages WHERE page_id % 4 <> 0
"""


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = html_facts.achievement_facts(workload.achievement_pages(spark, sf_dir), "app_id")
    return facts.select("app_id", F.posexplode("achievements").alias("pos", "a")).select(
        "app_id", "pos", "a.name", "a.description", "a.global_percent", "a.hidden", "a.icon_url"
    )


HTML_BLOCKS = f"""
SELECT page_id AS app_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS pos, name,
       CASE WHEN page_id % 5 <> 0 THEN 'Get ' || name END AS description, CAST(page_id % 100 + 0.5 AS DOUBLE) AS global_percent,
       page_id % 3 = 0 AS hidden, CASE WHEN page_id % 2 = 0 THEN 'https://img.example' || href END AS icon_url
FROM ({NAMED_ITEMS}) WHERE name <> ''
"""


def achievement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = html_facts.achievement_facts(workload.achievement_pages(spark, sf_dir), "app_id")
    return html_facts.achievement_summary(facts, "app_id")


ACHIEVEMENT_STATS = f"""
SELECT p.page_id AS app_id, CAST(COALESCE(n, 0) AS INTEGER) AS achievements, CASE WHEN p.page_id % 3 = 0 THEN COALESCE(n, 0) ELSE 0 END AS hidden,
       CASE WHEN n > 0 THEN round(CAST(p.page_id % 100 + 0.5 AS DOUBLE), 4) END AS avg_percent
FROM pages p LEFT JOIN (SELECT page_id, COUNT(*) AS n FROM ({NAMED_ITEMS}) WHERE name <> '' GROUP BY page_id) i ON p.page_id = i.page_id
"""


def zip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = workload.score_pages(spark, sf_dir)
    return html_facts.score_facts(pages, "app_id").where(
        F.col("critic_score").isNotNull() | F.col("user_score_raw").isNotNull()
    )


ZIP_PAIRS = """
SELECT p_partkey AS app_id, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 2 THEN p_size WHEN 3 THEN CASE WHEN p_size + 60 <= 100 THEN p_size + 60 END END AS BIGINT) AS critic_score,
       CASE WHEN p_partkey % 5 = 0 THEN p_size / 10.0::DOUBLE END AS user_score,
       CASE p_partkey % 5 WHEN 0 THEN CAST(p_size / 10.0::DOUBLE AS VARCHAR) || ' of 10' WHEN 1 THEN 'tbd' END AS user_score_raw
FROM part WHERE p_partkey % 5 <> 4 AND NOT (p_partkey % 5 = 3 AND p_size + 60 > 100)
"""
def json_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = (
        table(spark, sf_dir, "events")
        .select(
            F.col("user_id").alias("app_id"),
            F.expr("event_id div 500").alias("block"),
            F.struct(
                "event_id",
                F.when(F.col("event_type") == "view", F.concat(F.lit('{"aggregateRating":{"ratingValue":'), F.get_json_object("props", "$.k"), F.lit("}}")))
                .when(F.col("event_type") == "error", F.lit('{"aggregateRating":'))
                .otherwise(F.col("props"))
                .alias("script"),
            ).alias("s"),
        )
        .groupBy("app_id", "block")
        .agg(F.array_sort(F.collect_list("s"))["script"].alias("scripts"))
    )
    return ordered.select("app_id", "block", html_facts.json_ld_score(F.col("scripts")).alias("score"))


JSON_FALLBACK = """
SELECT user_id AS app_id, event_id // 500 AS block,
       arg_min(CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END,
               CASE WHEN event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS DOUBLE) BETWEEN 0 AND 100 THEN event_id END) AS score
FROM events GROUP BY 1, 2
"""


def override_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", F.array("lang", "source").alias("listed"))
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, F.array()).otherwise(F.array(F.col("quality").cast("string"))).cast("array<string>").alias("matrix")
    )
    best = html_facts.override_languages(F.col("matrix"), F.col("listed"))
    return documents.join(labels, "doc_id", "left").select("doc_id", F.array_join(best, "/").alias("languages"))


OVERRIDE_JOIN = """
SELECT d.doc_id, CASE WHEN l.toxic = 0 THEN CAST(l.quality AS VARCHAR) ELSE d.lang || '/' || d.source END AS languages
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


REPORTS = {
    "page_text": (page_text, PAGE_TEXT),
    "tag_rank": (tag_rank, TAG_RANK),
    "tag_top": (tag_top, TAG_TOP),
    "html_pivot": (html_pivot, HTML_PIVOT),
    "html_blocks": (html_blocks, HTML_BLOCKS),
    "achievement_stats": (achievement_stats, ACHIEVEMENT_STATS),
    "zip_pairs": (zip_pairs, ZIP_PAIRS),
    "json_fallback": (json_fallback, JSON_FALLBACK),
    "override_join": (override_join, OVERRIDE_JOIN),
}
