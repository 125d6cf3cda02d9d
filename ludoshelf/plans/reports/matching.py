"""Reports over the cross-source match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.functions.text import slug
from ludoshelf.operators import matching, quantiles, title_join
from ludoshelf.plans import workload
from ludoshelf.plans.workload import table
from ludoshelf.sources.staging import Staging


def decorated(name: Column, key: Column) -> Column:
    """A part name as a store title: symbols, accents and edition suffixes by key."""
    return (
        F.when(key % 6 == 0, F.concat(name, F.lit("™  Complete Edition")))
        .when(key % 6 == 1, F.concat(name, F.lit(" GOTY")))
        .when(key % 6 == 2, F.concat(F.lit("Pokémon® "), name))
        .when(key % 6 == 3, F.concat(name, F.lit(": Game of the Year edition")))
        .when(key % 6 == 4, F.concat(F.lit("Über—"), name, F.lit("!")))
        .otherwise(name)
    )


TITLES = """
SELECT *, CASE p_partkey % 6 WHEN 0 THEN p_name || '™  Complete Edition' WHEN 1 THEN p_name || ' GOTY' WHEN 2 THEN 'Pokémon® ' || p_name
       WHEN 3 THEN p_name || ': Game of the Year edition' WHEN 4 THEN 'Über—' || p_name || '!' ELSE p_name END AS title FROM part
"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumn("title", decorated(F.col("p_name"), F.col("p_partkey")))


def title_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.variant_rows(_titles(spark, sf_dir), "title", "p_partkey")
    return rows.groupBy("variant_ord", "variant").agg(F.count("*").alias("titles"))


TITLE_VARIANTS = f"""
WITH v AS (
  SELECT p_partkey % 6 AS kind, title, CASE p_partkey % 6 WHEN 0 THEN p_name || ' Complete Edition' WHEN 2 THEN 'Pokémon ' || p_name ELSE title END AS plain, p_name FROM ({TITLES})),
rows AS (
  SELECT 0 AS variant_ord, title AS variant FROM v
  UNION ALL SELECT 1, plain FROM v WHERE plain <> title
  UNION ALL SELECT CASE WHEN plain <> title THEN 2 ELSE 1 END, CASE kind WHEN 3 THEN p_name || ':' ELSE p_name END FROM v WHERE kind IN (0, 1, 3))
SELECT CAST(variant_ord AS INTEGER) AS variant_ord, variant, COUNT(*) AS titles FROM rows GROUP BY 1, 2
"""


def slug_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select(slug("title").alias("slug")).groupBy("slug").agg(F.count("*").alias("titles"))


def _sql_slug(title: str) -> str:
    plain = f"regexp_replace(strip_accents(regexp_replace({title}, '[™®©]', '', 'g')), '[^\\x00-\\x7f]', '', 'g')"
    return f"lower(trim(regexp_replace({plain}, '[^a-zA-Z0-9]+', '-', 'g'), '-'))"


SLUG_KEY = f"SELECT {_sql_slug('title')} AS slug, COUNT(*) AS titles FROM ({TITLES}) GROUP BY 1"


def candidate_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("https://scores.example/"), "p_partkey"))
    rows = matching.candidate_rows(_titles(spark, sf_dir).withColumn("known", known), "title", "known", "p_partkey")
    return rows.groupBy("url").agg(F.count("*").alias("titles"), F.min("ord").alias("first_ord"))


CANDIDATE_URLS = f"""
WITH t AS (SELECT p_partkey, p_size, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title FROM ({TITLES})),
s AS (SELECT *, {_sql_slug('title')} AS first_slug, {_sql_slug("regexp_replace(title, '(?i)\\s+(?:complete|definitive|deluxe|ultimate|gold|game of the year|goty)(?:\\s+edition)?$', '')")} AS second_slug FROM t),
lists AS (SELECT p_partkey, list_concat(CASE WHEN p_size % 3 = 0 THEN ['https://scores.example/' || p_partkey] ELSE [] END,
            ['https://www.metacritic.com/game/pc/' || first_slug || '/', 'https://www.metacritic.com/game/' || first_slug || '/'],
            CASE WHEN second_slug <> first_slug THEN ['https://www.metacritic.com/game/pc/' || second_slug || '/', 'https://www.metacritic.com/game/' || second_slug || '/'] ELSE [] END) AS urls FROM s),
rows AS (SELECT unnest(urls) AS url, generate_subscripts(urls, 1) - 1 AS ord FROM lists)
SELECT url, COUNT(*) AS titles, CAST(MIN(ord) AS INTEGER) AS first_ord FROM rows GROUP BY url
"""


def _score_titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts ask for the score page of their own key, then for pages by name; pages by name exist for some names."""
    k = F.col("p_partkey")
    titles = table(spark, sf_dir, "part").select(
        k.alias("app_id"),
        F.col("p_name").alias("title"),
        F.when(k % 4 != 3, F.concat(F.lit("https://scores.example/"), k)).alias("known_url"),
        F.when(k % 4 == 0, F.col("p_size")).cast("bigint").alias("known_score"),
    )
    own = workload.score_pages(spark, sf_dir).select(
        "url", F.when(F.col("http_status") == 404, F.lit("http status 404")).alias("error"), "body"
    )
    by_name = (
        table(spark, sf_dir, "part")
        .where(F.col("p_name").startswith("b") | F.col("p_name").startswith("c"))
        .select(F.concat(F.lit("https://www.metacritic.com/game/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/")).alias("url"), "p_name")
        .distinct()
        .select(
            "url",
            F.lit(None).cast("string").alias("error"),
            F.when(
                F.col("p_name").startswith("b"),
                F.lit('<span data-testid="global-score-value">77</span><div data-testid="global-score-header">metascore</div>'),
            ).otherwise(F.lit("<p>nothing</p>")).alias("body"),
        )
    )
    return titles, own.unionByName(by_name)


def first_acceptable(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.score_lookup(*_score_titles(spark, sf_dir))
    return found.select(
        "app_id", "accepted_ord", "record.url", "record.critic_score", "record.user_score", "record.user_score_raw",
        F.array_join("candidates", " ").alias("candidates"), F.array_join("errors", "; ").alias("errors"),
    )


FIRST_ACCEPTABLE = """
WITH t AS (
  SELECT p_partkey AS k, p_size AS s, p_partkey % 4 <> 3 AS has_known, p_partkey % 10 <> 9 AS known_ok, p_name,
         'https://scores.example/' || p_partkey AS own, 'https://www.metacritic.com/game/pc/' || replace(p_name, ' ', '-') || '/' AS first_url,
         'https://www.metacritic.com/game/' || replace(p_name, ' ', '-') || '/' AS second_url FROM part),
r AS (
  SELECT *, has_known AND known_ok AS by_own,
    NOT (has_known AND known_ok) AND (p_name LIKE 'b%' OR (p_name LIKE 'c%' AND k % 4 = 0)) AS by_name FROM t)
SELECT k AS app_id, CAST(CASE WHEN by_own THEN 0 WHEN by_name THEN CASE WHEN has_known THEN 2 ELSE 1 END END AS INTEGER) AS accepted_ord,
  CASE WHEN by_own THEN own WHEN by_name THEN second_url END AS url,
  CAST(CASE WHEN by_own THEN COALESCE(CASE k % 5 WHEN 0 THEN s WHEN 2 THEN s WHEN 3 THEN CASE WHEN s + 60 <= 100 THEN s + 60 END END,
                                      CASE WHEN k % 4 = 0 THEN s END)
            WHEN by_name THEN CASE WHEN p_name LIKE 'b%' THEN 77 ELSE s END END AS BIGINT) AS critic_score,
  CASE WHEN by_own AND k % 5 = 0 THEN s / 10.0::DOUBLE END AS user_score,
  CASE WHEN by_own THEN CASE k % 5 WHEN 0 THEN CAST(s / 10.0::DOUBLE AS VARCHAR) || ' of 10' WHEN 1 THEN 'tbd' END END AS user_score_raw,
  CASE WHEN NOT by_own AND NOT by_name THEN CASE WHEN has_known THEN own || ' ' ELSE '' END || first_url || ' ' || second_url END AS candidates,
  CASE WHEN NOT by_own AND NOT by_name THEN CASE WHEN has_known THEN own || ': http status 404; ' ELSE '' END || first_url || ': not landed; '
       || CASE WHEN p_name LIKE 'c%' THEN 'No score found at ' || second_url ELSE second_url || ': not landed' END END AS errors
FROM r
"""


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.best_match(*workload.order_searches(spark, sf_dir))


# Per order the results with their similarity to the title, best first.
RANKED_RESULTS = """
SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY similarity DESC, l_linenumber, l_partkey, l_suppkey) AS rank FROM (
  SELECT t.app_id, t.title, p.p_name AS game_name, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CASE WHEN lower(t.title) = p.p_name THEN 1.0::DOUBLE
              ELSE 1 - levenshtein(lower(t.title), p.p_name)::DOUBLE / greatest(length(t.title), length(p.p_name)) END AS similarity
  FROM (SELECT l_orderkey AS app_id, arg_min(p_name, (l_partkey, l_suppkey)) AS title FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 1 GROUP BY 1) t
  JOIN lineitem l ON l.l_orderkey = t.app_id AND l.l_linenumber > 1 JOIN part p ON l.l_partkey = p.p_partkey)
"""


def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = matching.accepted_match(_matches(spark, sf_dir))
    hours = matching.hours(F.col("best"))
    return best.select(
        "app_id", F.lower("title").alias("title"), F.col("best.game_name").alias("game_name"), F.col("best.exact").alias("exact"),
        F.round("best.similarity", 6).alias("similarity"), hours["id"].alias("id"),
        hours["main_story_hours"].alias("main_story_hours"), hours["completionist_hours"].alias("completionist_hours"),
    )


FUZZY_MATCH = f"""
SELECT app_id, title, game_name, title = game_name AS exact, round(similarity, 6) AS similarity, l_partkey AS id,
       CASE WHEN l_suppkey % 3 <> 0 THEN l_suppkey / 2.0::DOUBLE END AS main_story_hours, l_suppkey::DOUBLE AS completionist_hours
FROM ({RANKED_RESULTS}) WHERE rank = 1 AND similarity >= 0.65
"""


def ambiguous_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    unclear = matching.ambiguous_match(_matches(spark, sf_dir))
    return unclear.select(
        "app_id", F.col("best.game_name").alias("best_match"), F.round("best.similarity", 6).alias("similarity"),
        F.array_join("listed", ",").alias("candidates"),
    )


AMBIGUOUS_TOP5 = f"""
SELECT app_id, arg_min(game_name, rank) AS best_match, round(MAX(similarity), 6) AS similarity,
       string_agg(CASE WHEN rank <= 5 THEN game_name END, ',' ORDER BY rank) AS candidates
FROM ({RANKED_RESULTS}) GROUP BY app_id HAVING MAX(similarity) < 0.65
"""


def match_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles, results = workload.order_searches(spark, sf_dir)
    return titles.join(results.select("app_id"), "app_id", "left_anti").select("app_id", F.lower("title").alias("title"))


MATCH_MISSING = """
SELECT l_orderkey AS app_id, arg_min(p_name, (l_partkey, l_suppkey)) AS title FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linenumber = 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 1) GROUP BY 1
"""


def _shop_titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as a catalogue of names, and as titles of another shop that writes them in its own ways."""
    k, parts = F.col("p_partkey"), table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", "p_type")
    title = (
        F.when(k % 6 == 0, F.concat(F.upper(name), F.lit("™")))
        .when(k % 6 == 1, F.concat(name, F.lit("  GOTY")))
        .when(k % 6 == 2, F.replace(name, F.lit("e"), F.lit("33")))
        .when(k % 6 == 3, F.concat_ws(" ", "p_brand", "p_type"))
        .when(k % 6 == 4, F.concat_ws(" ", F.lit("The"), name))
        .otherwise(F.concat_ws(" ", "p_type", "p_name"))
    )
    return parts.select(k.alias("app_id"), title.alias("title")), parts.select(k.alias("name_id"), name.alias("name"))


def catalogue_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best name of the whole catalogue for every title."""
    found = title_join.catalogue_match(*_shop_titles(spark, sf_dir), staged=Staging(spark))
    return found.withColumn("similarity", F.round("similarity", 6))


CATALOGUE_MATCH = """
WITH names AS (SELECT p_partkey AS name_id, p_name || ' ' || p_type AS name FROM part),
titles AS (SELECT p_partkey AS app_id, CASE p_partkey % 6 WHEN 0 THEN upper(p_name || ' ' || p_type) || '™' WHEN 1 THEN p_name || ' ' || p_type || '  GOTY'
  WHEN 2 THEN replace(p_name || ' ' || p_type, 'e', '33') WHEN 3 THEN p_brand || ' ' || p_type
  WHEN 4 THEN 'The ' || p_name || ' ' || p_type ELSE p_type || ' ' || p_name END AS title FROM part),
plain AS (SELECT title, trim(regexp_replace(replace(title, '™', ''), '\\s+', ' ', 'g')) AS n FROM (SELECT DISTINCT title FROM titles)),
cut AS (SELECT *, regexp_replace(n, '(?i)\\s+goty$', '') AS e FROM plain),
variants AS (SELECT title, 0 AS variant_ord, title AS v FROM cut UNION ALL SELECT title, 1, n FROM cut WHERE n <> title
  UNION ALL SELECT title, CASE WHEN n <> title THEN 2 ELSE 1 END, e FROM cut WHERE e <> title AND e <> n),
catalogue AS (SELECT lower(name) AS s, arg_min(name, (name, name_id)) AS name, arg_min(name_id, (name, name_id)) AS name_id FROM names GROUP BY 1),
scored AS (SELECT title, variant_ord, s, name, name_id, 1 - levenshtein(lower(v), s)::DOUBLE / greatest(length(v), length(s)) AS similarity FROM variants CROSS JOIN catalogue),
best AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY similarity DESC, variant_ord, s) AS place FROM scored WHERE similarity >= 0.65)
SELECT app_id, title, CAST(variant_ord AS INTEGER) AS variant_ord, name_id, name, round(similarity, 6) AS similarity, similarity = 1 AS exact
FROM titles JOIN best USING (title) WHERE place = 1
"""


def hours_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return matching.hours_summary(table(spark, sf_dir, "events").withColumn("text", text), "event_type", F.col("text"))


HOURS_STATS = """
SELECT event_type, COUNT(*) AS n, round(AVG(value), 4) AS avg_hours, MAX(value) AS max_hours
FROM events WHERE event_id % 10 <> 0 GROUP BY event_type
"""


def hours_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and ninth decile per type and over all, rolled up from sketches per type and day, each held against the values."""
    number = F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("value").cast("string"))
    events = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), number.alias("hours"))
    by_day = Staging(spark)(quantiles.sketches(events, ["event_type", "day"], F.col("hours")), "hour_sketches")
    by_type = quantiles.rolled_up(by_day, ["event_type"])
    groups = by_type.unionByName(quantiles.rolled_up(by_type, []).withColumn("event_type", F.lit("all")))
    found = quantiles.summary(groups, ["event_type", F.round("total", 2).alias("total_hours")])
    values = events.select("event_type", F.col("hours").try_cast("double").alias("hours")).where("hours is not null")
    values = values.select(F.explode(F.array("event_type", F.lit("all"))).alias("event_type"), "hours")

    def near(quantile: str, share: float) -> Column:
        below, up_to = F.count_if(F.col("hours") < F.col(quantile)), F.count_if(F.col("hours") <= F.col(quantile))
        return (below <= (share + quantiles.RANK_ERROR) * F.count("*")) & (up_to >= (share - quantiles.RANK_ERROR) * F.count("*"))

    held = values.join(found, "event_type").groupBy("event_type")
    facts = [F.first(c).alias(c) for c in ("n", "total_hours", "max_hours")]
    return held.agg(*facts, near("median_hours", 0.5).alias("median_near"), near("p90_hours", 0.9).alias("p90_near"))


HOURS_QUANTILES = """
SELECT coalesce(event_type, 'all') AS event_type, COUNT(*) AS n, round(SUM(value), 2) AS total_hours, MAX(value) AS max_hours, true AS median_near, true AS p90_near
FROM events WHERE event_id % 10 <> 0 GROUP BY GROUPING SETS ((event_type), ())
"""


REPORTS = {
    "title_variants": (title_variants, TITLE_VARIANTS),
    "slug_key": (slug_key, SLUG_KEY),
    "candidate_urls": (candidate_urls, CANDIDATE_URLS),
    "first_acceptable": (first_acceptable, FIRST_ACCEPTABLE),
    "fuzzy_match": (fuzzy_match, FUZZY_MATCH),
    "ambiguous_top5": (ambiguous_top5, AMBIGUOUS_TOP5),
    "match_missing": (match_missing, MATCH_MISSING),
    "catalogue_match": (catalogue_match, CATALOGUE_MATCH),
    "hours_stats": (hours_stats, HOURS_STATS),
    "hours_quantiles": (hours_quantiles, HOURS_QUANTILES),
}
