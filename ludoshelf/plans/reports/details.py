"""Reports over product details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.operators import assembly, details
from ludoshelf.plans import workload
from ludoshelf.plans.workload import details_body, landed, table, wide


def _admitted(rows: DataFrame, *names: str) -> DataFrame:
    """Admitted details; only the named members are read from the bodies, or all."""
    return details.landed_details(rows, names or details.FIELDS).where(F.col("error").isNull())


def _bodies(rows: DataFrame, key: str, data: Column, *names: str, **values: Column) -> DataFrame:
    """Admitted details of rows whose body holds ``data`` (JSON text), with the named members."""
    app_id = F.col(key)
    return _admitted(landed(rows, "app_details", app_id=app_id, body=details_body(app_id, data), **values), *names)


def base_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    data = F.to_json(F.struct(F.concat(F.lit("doc "), "doc_id").alias("name"), F.col("text").alias("detailed_description")))
    rows = landed(
        documents,
        "app_details",
        app_id=workload.source_id(),
        locale=F.col("lang"),
        fetched_at=F.timestamp_seconds("doc_id"),
        body=details_body(workload.source_id(), data, F.when(F.col("quality") == 1, "1").otherwise("0")),
    )
    order = F.array_position(F.array(*map(F.lit, ("de", "es", "fr", "en"))), F.col("locale"))
    picked = details.base_pick(details.with_texts(_admitted(rows).withColumn("locale_ord", order)))
    text = F.col("localizations")[F.col("base.locale")]
    return picked.select(
        "app_id",
        F.col("base.locale").alias("locale"),
        text["name"].alias("name"),
        F.size("localizations").alias("n_locales"),
        F.length(text["full_description"]["html"]).alias("text_length"),
    )


LATEST_TEXTS = """
SELECT CAST(substr(source, 4) AS BIGINT) AS app_id, lang AS locale, MAX(doc_id) AS doc_id,
       arg_max(text, doc_id) AS text, CASE lang WHEN 'de' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS ord
FROM documents JOIN labels USING (doc_id) WHERE quality = 1 GROUP BY source, lang
"""
BASE_PICK = f"""
SELECT app_id, arg_min(locale, ord) AS locale, 'doc ' || arg_min(doc_id, ord) AS name,
       CAST(COUNT(*) AS INTEGER) AS n_locales, CAST(length(arg_min(text, ord)) AS INTEGER) AS text_length
FROM ({LATEST_TEXTS}) GROUP BY app_id
"""


def localized_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _admitted(workload.part_details(spark, sf_dir)).withColumn(
        "locale_ord", F.when(F.col("locale") == "de-DE", 0).otherwise(1)
    )
    picked = details.base_pick(details.with_texts(rows))
    texts = picked.select("app_id", F.col("base.locale").alias("base_locale"), F.explode("localizations").alias("locale", "t"))
    return texts.select(
        "app_id", "locale", "base_locale", "t.name", "t.steam_language",
        F.col("t.short_description.text").alias("short_text"),
        F.col("t.full_description.text").alias("full_text"),
    )


PART_LOCALES = """
SELECT *, unnest(['de-DE', 'en-US']) AS locale FROM part WHERE p_size <> 50
"""
LOCALIZED_MAP = f"""
SELECT p_partkey AS app_id, locale, CASE WHEN p_size % 7 = 0 THEN 'en-US' ELSE 'de-DE' END AS base_locale, p_name AS name,
       CASE locale WHEN 'de-DE' THEN 'german' ELSE 'english' END AS steam_language, p_name || ' & ' || p_brand AS short_text,
       CASE WHEN p_size % 3 = 0 THEN 'About ' || p_name ELSE 'Made by ' || p_brand END AS full_text
FROM ({PART_LOCALES}) WHERE NOT (locale = 'de-DE' AND p_size % 7 = 0)
"""


def release_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (
        F.when(k % 8 == 0, F.date_format(day, "MMM d, yyyy"))
        .when(k % 8 == 1, F.date_format(day, "MMMM d, yyyy"))
        .when(k % 8 == 2, F.date_format(day, "d MMM, yyyy"))
        .when(k % 8 == 3, F.date_format(day, "yyyy-M-d"))
        .when(k % 8 == 4, F.concat(F.lit(" Q3 "), F.date_format(day, "yyyy"), F.lit(" ")))
        .when(k % 8 == 5, F.date_format(day, "MMM  d,  yyyy"))
        .when(k % 8 == 6, "Coming soon")
    )
    data = F.to_json(F.struct(F.struct(raw.alias("date"), (k % 2 == 0).alias("coming_soon")).alias("release_date")))
    dated = _bodies(wide(spark, sf_dir, "orders"), "o_orderkey", data, "release_date").select(
        details.release(F.col("data.release_date")).alias("r")
    )
    return dated.groupBy(
        F.year("r.release_date").alias("year"), F.month("r.release_date").alias("month"), F.col("r.coming_soon").alias("coming_soon")
    ).agg(F.count("*").alias("n"), F.count("r.release_date_raw").alias("with_raw"))


RELEASE_CALENDAR = """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, coming_soon, COUNT(*) AS n, COUNT(raw) AS with_raw
FROM (SELECT CASE WHEN o_orderkey % 8 = 4 THEN date_trunc('year', o_orderdate) WHEN o_orderkey % 8 < 6 THEN o_orderdate END AS d,
             o_orderkey % 2 = 0 AS coming_soon, CASE WHEN o_orderkey % 8 <> 7 THEN 1 END AS raw FROM orders)
GROUP BY 1, 2, 3
"""


def price_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    minor = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    price = F.struct(
        F.when(F.col("l_linenumber") == 7, " ").otherwise("KZT").alias("currency"),
        minor.alias("initial"),
        F.when(F.col("l_linenumber") == 6, "n/a").otherwise(minor.cast("string")).alias("final"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_percent"),
        F.lit(5).alias("initial_formatted"),
        F.concat(minor.cast("string"), F.lit(" ₸")).alias("final_formatted"),
    )
    data = F.to_json(F.struct(price.alias("price_overview")))
    priced = _bodies(
        wide(spark, sf_dir, "lineitem"), "l_orderkey", data, "price_overview", store_country=F.lower("l_returnflag")
    ).select("store_country", details.price(F.col("data.price_overview")).alias("price"))
    return details.price_summary(priced, "store_country")


PRICE_FACTS = """
SELECT lower(l_returnflag) AS store_country, COUNT(*) AS priced, MIN(d) AS min_discount, MAX(d) AS max_discount,
       round(AVG(d), 4) AS avg_discount, CAST(SUM(m) AS BIGINT) AS sum_initial, CAST(SUM(CASE WHEN l_linenumber <> 6 THEN m END) AS BIGINT) AS sum_final
FROM (SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_extendedprice * 100) AS BIGINT) AS m
      FROM lineitem WHERE l_linenumber <> 7) GROUP BY 1
"""


def media_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    shots = F.transform(
        links,
        lambda href, i: F.struct(
            i.cast("string").alias("id"),
            F.when(i % 2 == 0, F.concat(F.lit("https://img.example"), href)).otherwise(href).alias("path_full"),
            F.concat(F.lit("HTTP://img.example"), href).alias("path_thumbnail"),
        ),
    )
    data = F.regexp_replace(F.to_json(F.struct(shots.alias("screenshots"))), r"\]\}\z", ',7,"x",null]}')
    read = _bodies(wide(spark, sf_dir, "pages"), "page_id", data, "screenshots")
    return details.item_rows(read, details.screenshots(F.col("data.screenshots")), "app_id").select(
        "app_id", "pos", "item.id", "item.full_url", "item.thumbnail_url"
    )


MEDIA_LINKS = """
SELECT page_id AS app_id, CAST(i AS INTEGER) AS pos, CAST(i AS BIGINT) AS id,
       CASE WHEN i % 2 = 0 THEN 'https://img.example' || href END AS full_url, CAST(NULL AS VARCHAR) AS thumbnail_url
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
             generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS i FROM pages)
"""


def unpivot_os(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, t = F.col("quality").cast("string"), F.col("toxic").cast("string")
    data = F.to_json(
        F.struct(
            F.struct(F.concat(F.lit("q <b>"), q, F.lit("</b>")).alias("minimum")).alias("pc_requirements"),
            F.array(t).alias("mac_requirements"),
            F.struct(F.when(F.col("toxic") == 1, F.concat(F.lit("<p>t"), t)).alias("recommended")).alias("linux_requirements"),
        )
    )
    read = _bodies(wide(spark, sf_dir, "labels"), "doc_id", data)
    return details.requirement_rows(details.with_facts(read), "app_id")


UNPIVOT_OS = """
SELECT doc_id AS app_id, 'windows' AS os, 'q ' || quality AS minimum, CAST(NULL AS VARCHAR) AS recommended FROM labels
UNION ALL SELECT doc_id, 'linux', NULL, 't' || toxic FROM labels WHERE toxic = 1
"""


def split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    name = F.when(lang == "en", "English").when(lang == "fr", "French").when(lang == "de", "German").otherwise("Elvish")
    words = F.regexp_replace(F.concat(name, F.lit(" "), "text"), r"[^\p{L}]+", ", ")
    listed = F.concat(
        F.regexp_replace(words, "ing,", "ing<strong>*</strong>,"), F.lit(", *,<br><strong>*</strong>languages with full audio support")
    )
    data = F.to_json(F.struct(listed.alias("supported_languages")))
    read = _bodies(wide(spark, sf_dir, "documents"), "doc_id", data, "supported_languages").select(
        "app_id", details.language_fragments(F.col("data.supported_languages")).alias("parts")
    )
    return (
        details.item_rows(read, details.languages(F.col("parts")), "app_id")
        .groupBy("item.name", "item.steam_language", "item.full_audio", "item.subtitles")
        .agg(F.count("*").alias("n"))
    )


SPLIT_EXPLODE = f"""
SELECT word AS name, d.steam AS steam_language, word LIKE '%ing' AND NOT is_last AS full_audio, true AS subtitles, COUNT(*) AS n
FROM (SELECT unnest(words) AS word, generate_subscripts(words, 1) = len(words) AS is_last FROM (
        SELECT string_split_regex(regexp_replace(CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE 'Elvish' END
               || ' ' || text, '[^\\p{{L}}]+', ', ', 'g'), ', ') AS words FROM documents)) w
LEFT JOIN (VALUES ('english', 'english'), ('french', 'french'), ('german', 'german')) AS d(name, steam) ON lower(w.word) = d.name
WHERE word <> '' GROUP BY 1, 2, 3
"""


def genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _admitted(workload.part_details(spark, sf_dir))
    return (
        details.item_rows(read, details.genres(F.col("data.genres")))
        .groupBy(F.col("item").alias("genre"))
        .agg(F.count("*").alias("n"))
    )


ADMITTED_PARTS = f"SELECT * FROM ({PART_LOCALES}) WHERE NOT (locale = 'de-DE' AND p_size % 7 = 0)"
GENRE_COUNTS = f"""
SELECT genre, COUNT(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM ({ADMITTED_PARTS})) GROUP BY 1
"""


def category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _admitted(workload.part_details(spark, sf_dir)).where(F.col("locale") == "en-US")
    return details.item_rows(read, details.categories(F.col("data.categories")), "app_id").select(
        "app_id", "pos", "item.id", "item.name", "item.source"
    )


CATEGORY_ROWS = """
SELECT p_partkey AS app_id, CAST(0 AS INTEGER) AS pos, CAST(p_size AS BIGINT) AS id, p_type AS name, 'steam' AS source
FROM part WHERE p_size <> 50
"""


def company_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _admitted(workload.part_details(spark, sf_dir))
    return details.company_rows(read).groupBy("company", "role").agg(F.count("*").alias("n"))


COMPANY_COUNTS = f"""
WITH p AS ({ADMITTED_PARTS})
SELECT company, role, COUNT(*) AS n FROM (
  SELECT p_brand AS company, 'developer' AS role FROM p UNION ALL SELECT p_brand, 'publisher' FROM p UNION ALL SELECT p_type, 'publisher' FROM p)
GROUP BY 1, 2
"""


def map_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    flags = F.struct(
        (kind == "view").alias("windows"), (value > 20).alias("mac"), F.lit("yes").alias("linux"), F.lit(1).alias("deck")
    )
    read = _bodies(wide(spark, sf_dir, "events"), "user_id", F.to_json(F.struct(flags.alias("platforms"))), "platforms")
    return (
        details.item_rows(read, F.map_entries(details.platforms(F.col("data.platforms"))), "app_id")
        .groupBy("app_id", F.col("item.key").alias("os"))
        .agg(F.count("*").alias("n"), F.count_if("item.value").alias("yes"))
    )


MAP_FILTER = """
SELECT user_id AS app_id, os, COUNT(*) AS n, COUNT(CASE WHEN yes THEN 1 END) AS yes FROM (
  SELECT user_id, 'windows' AS os, event_type = 'view' AS yes FROM events
  UNION ALL SELECT user_id, 'mac', value > 20 FROM events) GROUP BY 1, 2
"""


def descriptor_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = F.struct(
        F.struct(
            F.col("text").alias("descriptors"), F.concat((F.col("n_chars") % 19).cast("string"), F.lit("")).alias("required_age"),
            F.lit("No").alias("banned"), F.lit(1).alias("use_age_gate"), F.col("lang").alias("rating"),
        ).alias("pegi"),
        F.struct(F.lit(12).alias("rating"), F.lit(12).alias("required_age")).alias("esrb"),
        F.lit("none").alias("dejus"),
    )
    read = _bodies(wide(spark, sf_dir, "documents"), "doc_id", F.to_json(F.struct(ratings.alias("ratings"))), "ratings")
    rows = details.item_rows(read, details.age_ratings(F.col("data.ratings")), "app_id")
    per_app = details.required_age(rows, "app_id")
    parts = F.col("item.descriptors")
    return rows.join(per_app, "app_id").select(
        "app_id",
        "item.authority",
        "item.rating",
        F.size(parts).alias("parts"),
        F.coalesce(F.length(F.array_join(parts, "")), F.lit(0)).alias("part_chars"),
        "item.banned",
        "item.use_age_gate",
        F.col("required_age").alias("app_required_age"),
    )


DESCRIPTOR_SPLIT = """
WITH parts AS (
  SELECT doc_id, trim(unnest(string_split_regex(text, '[;\\n]+')), ' \t\r') AS part FROM documents),
counted AS (SELECT doc_id, COUNT(*) AS parts, SUM(length(part)) AS chars FROM parts WHERE part <> '' GROUP BY doc_id)
SELECT d.doc_id AS app_id, 'pegi' AS authority, lang AS rating, CAST(COALESCE(c.parts, 0) AS INTEGER) AS parts,
       CAST(COALESCE(c.chars, 0) AS INTEGER) AS part_chars, false AS banned, true AS use_age_gate,
       greatest(n_chars % 19, 12) AS app_required_age
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
UNION ALL SELECT doc_id, 'esrb', '12', 0, 0, NULL, NULL, greatest(n_chars % 19, 12) FROM documents
"""


def scalar_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _admitted(workload.part_details(spark, sf_dir)).where(F.col("locale") == "en-US")
    keep = ("type", "is_free", "header_image", "website")
    return details.with_facts(read).select("app_id", *keep)


SCALAR_FACTS = """
SELECT p_partkey AS app_id, p_type AS type, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS is_free,
       CASE WHEN p_partkey % 2 = 0 THEN 'https://img.example/' || p_partkey END AS header_image,
       CASE WHEN p_partkey % 3 = 0 THEN 'http://site.example/' || p_partkey END AS website
FROM part WHERE p_size <> 50
"""


def score_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _admitted(workload.part_details(spark, sf_dir)).where(F.col("locale") == "en-US")
    stub = details.score_stub(F.col("data.metacritic"))
    return read.select("app_id", stub["url"].alias("url"), stub["critic_score"].alias("critic_score"), stub["platform"].alias("platform"))


SCORE_STUB = """
SELECT p_partkey AS app_id, CASE WHEN p_partkey % 4 <> 3 THEN 'https://scores.example/' || p_partkey END AS url,
       CAST(CASE WHEN p_partkey % 4 < 2 THEN p_size END AS BIGINT) AS critic_score,
       CASE WHEN p_partkey % 4 <> 3 THEN 'pc' END AS platform
FROM part WHERE p_size <> 50
"""


def score_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    stub = documents.select(
        "doc_id", F.struct(F.concat(F.lit("d"), "doc_id").alias("url"), (F.col("n_chars") % 100).alias("critic_score")).alias("stub")
    )
    found = table(spark, sf_dir, "labels").select(
        "doc_id", F.struct(F.concat(F.lit("p"), "doc_id").alias("url"), F.col("quality").cast("bigint").alias("critic_score")).alias("page")
    )
    best = assembly.fallback("page", "stub")
    return stub.join(found, "doc_id", "left").select("doc_id", best["url"].alias("url"), best["critic_score"].alias("critic_score"))


SCORE_FALLBACK = """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'd' ELSE 'p' END || d.doc_id AS url,
       COALESCE(CAST(l.quality AS BIGINT), d.n_chars % 100) AS critic_score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


REPORTS = {
    "base_pick": (base_pick, BASE_PICK),
    "localized_map": (localized_map, LOCALIZED_MAP),
    "release_calendar": (release_calendar, RELEASE_CALENDAR),
    "price_facts": (price_facts, PRICE_FACTS),
    "media_links": (media_links, MEDIA_LINKS),
    "unpivot_os": (unpivot_os, UNPIVOT_OS),
    "split_explode": (split_explode, SPLIT_EXPLODE),
    "genre_counts": (genre_counts, GENRE_COUNTS),
    "category_rows": (category_rows, CATEGORY_ROWS),
    "company_counts": (company_counts, COMPANY_COUNTS),
    "map_filter": (map_filter, MAP_FILTER),
    "descriptor_split": (descriptor_split, DESCRIPTOR_SPLIT),
    "scalar_facts": (scalar_facts, SCALAR_FACTS),
    "score_stub": (score_stub, SCORE_STUB),
    "score_fallback": (score_fallback, SCORE_FALLBACK),
}
