"""Cross-source match: title variants, candidate URLs in order, best candidate by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions.clean import col, collapse
from ludoshelf.functions.text import slug
from ludoshelf.operators.html_facts import score_facts
from ludoshelf.operators.keyed import top_k

# Symbols dropped from a title, and the edition suffix.
TITLE_SYMBOLS = "[™®�]"
EDITION = (
    r"(?i)\s+(?:complete|definitive|deluxe|ultimate|gold|game of the year|goty)(?:\s+edition)?$"
)
# The lowest accepted similarity, and how many names an ambiguous match lists.
ACCEPT_FROM = 0.65
LISTED_NAMES = 5
# The score page addresses of a slug.
SCORE_URLS = ("https://www.metacritic.com/game/pc/", "https://www.metacritic.com/game/")


def without_edition(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, EDITION, ""))


def title_variants(title: Column | str) -> Column:
    """The title, the title without symbols, the title without edition; ordered, distinct."""
    title = col(title)
    normalized = collapse(F.regexp_replace(title, TITLE_SYMBOLS, ""))
    return F.array_distinct(F.array(title, normalized, without_edition(normalized)))


def variant_rows(titles: DataFrame, title: str, *keep: str) -> DataFrame:
    """Join keys: one row per variant with its order."""
    return titles.select(*keep, F.posexplode(title_variants(title)).alias("variant_ord", "variant"))


def score_urls(title: Column | str, known_url: Column | str) -> Column:
    """Candidate score pages in order: the known one, then two per slug of title and edition-less title."""
    normalized = collapse(col(title))
    known = col(known_url)
    slugs = F.array_distinct(F.array(slug(normalized), slug(without_edition(normalized))))
    built = F.flatten(
        F.transform(
            F.filter(slugs, lambda s: s != ""),
            lambda s: F.array(*(F.concat(F.lit(prefix), s, F.lit("/")) for prefix in SCORE_URLS)),
        )
    )
    first = F.when(known != "", F.array(known)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, built))


def candidate_rows(titles: DataFrame, title: str, known_url: str, *keep: str) -> DataFrame:
    """One row per candidate URL with its order."""
    urls = score_urls(title, known_url)
    return titles.select(*keep, F.posexplode(urls).alias("ord", "url"))


def first_acceptable(
    candidates: DataFrame, key: str, accepted: Column, refusal: Column, *record: str
) -> DataFrame:
    """Per key the first accepted candidate (null record when none) and what was refused before it.

    ``ord`` orders the candidates. The pick is a partial aggregate; refusals hold at most the few addresses
    built for one title, and are null where one was accepted.
    """
    rows = candidates.select(
        key, "ord", "url", F.struct(*record).alias("record"),
        F.coalesce(accepted, F.lit(False)).alias("accepted"), refusal.alias("refusal"),
    )
    picked = rows.groupBy(key).agg(
        F.min(F.when(F.col("accepted"), F.col("ord"))).alias("accepted_ord"),
        F.min_by("record", F.when(F.col("accepted"), F.col("ord"))).alias("record"),
        F.array_sort(F.collect_list(F.when(~F.col("accepted"), F.struct("ord", "url", "refusal")))).alias("tried"),
    )
    return picked.select(
        key,
        "accepted_ord",
        "record",
        F.when(F.col("accepted_ord").isNull(), F.col("tried.url")).alias("candidates"),
        F.when(F.col("accepted_ord").isNull(), F.col("tried.refusal")).alias("errors"),
    )


def score_lookup(titles: DataFrame, score_pages: DataFrame, key: str = "app_id") -> DataFrame:
    """Score record per key from the first acceptable page.

    ``titles``: key, title, known_url, known_score. ``score_pages``: url, error, body, one row per URL.
    A page is parsed once, however many apps point at it; the details' own score fills a gap before the test.
    """
    asked = candidate_rows(titles, "title", "known_url", key, "known_url", "known_score")
    wanted = score_pages.join(asked.select("url").distinct(), "url", "left_semi")  # only asked pages are tokenized
    parsed = score_facts(wanted, "url", "error")
    joined = asked.join(parsed.withColumn("landed", F.lit(True)), "url", "left")
    ok = F.col("landed") & F.col("error").isNull()
    rows = joined.withColumn(
        "critic_score", F.when(ok, F.coalesce(F.col("critic_score"), F.col("known_score")))
    ).withColumn("platform", F.lit("pc"))
    accepted = ok & (
        (F.col("url") == F.col("known_url")) | F.col("critic_score").isNotNull() | F.col("user_score").isNotNull()
    )
    refusal = F.when(ok, F.concat(F.lit("No score found at "), F.col("url"))).otherwise(
        F.concat(F.col("url"), F.lit(": "), F.coalesce("error", F.lit("not landed")))
    )
    return first_acceptable(
        rows, key, accepted, refusal, "url", "critic_score", "user_score", "user_score_raw", "platform"
    )


def name_similarity(a: Column, b: Column) -> Column:
    """Normalised Levenshtein similarity, ignoring case."""
    a, b = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(1.0)


def best_match(titles: DataFrame, candidates: DataFrame, key: str = "app_id") -> DataFrame:
    """Best candidate per title: the first exact name in search order, else the highest similarity.

    ``titles``: key, title. ``candidates``: key, variant_ord, result_ord, game_name, similarity and what
    else to carry. Candidates belong to one title each (they are search results), so nothing is
    compared across titles. Where the source gave no similarity it is computed. Returns the five best per title
    as ``listed`` and the first of them as ``best``.
    """
    asked = titles.select(key, "title", title_variants("title").alias("variants"))
    lowered = F.transform("variants", F.lower)
    searched = F.coalesce(F.get("variants", F.col("variant_ord")), F.col("title"))
    rows = (
        candidates.join(asked, key)
        .withColumn("exact", F.array_contains(lowered, F.lower("game_name")))
        .withColumn(
            "similarity",
            F.when(F.col("exact"), 1.0).otherwise(
                F.coalesce("similarity", name_similarity(searched, F.col("game_name")))
            ),
        )
        .drop("variants")
    )
    order = [F.col("exact").desc(), F.col("similarity").desc(), F.col("variant_ord"), F.col("result_ord")]
    # The titles hold any number of candidates; the rank limit keeps five before anything is collected.
    nearest = top_k(rows, [key], order, LISTED_NAMES, salt_by=("variant_ord", "result_ord"), salts=8)
    item = F.struct("rank", *[c for c in rows.columns if c not in (key, "title")])
    return nearest.groupBy(key).agg(
        F.first("title").alias("title"),
        F.min_by(item, "rank").alias("best"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "game_name"))), lambda x: x["game_name"]
        ).alias("listed"),
    )


def accepted_match(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("best.similarity") >= ACCEPT_FROM)


def ambiguous_match(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("best.similarity") < ACCEPT_FROM)


def hours(best: Column) -> Column:
    """Hours record of a candidate; values that are no numbers become null."""
    return F.struct(
        best["game_id"].alias("id"),
        best["game_name"].alias("name"),
        best["game_web_link"].alias("url"),
        best["main_story"].try_cast("double").alias("main_story_hours"),
        best["main_extra"].try_cast("double").alias("main_extra_hours"),
        best["completionist"].try_cast("double").alias("completionist_hours"),
        best["all_styles"].try_cast("double").alias("all_styles_hours"),
        F.coalesce(best["json_content"], F.lit("{}")).alias("raw"),
    )


def hours_summary(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """Number, mean and maximum of hour values per group; values that are no numbers are skipped."""
    return (
        rows.select(key, value.try_cast("double").alias("hours"))
        .groupBy(key)
        .agg(
            F.count("hours").alias("n"),
            F.round(F.avg("hours"), 4).alias("avg_hours"),
            F.max("hours").alias("max_hours"),
        )
    )
