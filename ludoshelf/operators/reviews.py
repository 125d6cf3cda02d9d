"""Reviews: page chains, flattening, the most detailed k per product and polarity, rating summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.functions.clean import SPACES, blank_to_null, col, epoch_utc, percent
from ludoshelf.operators.keyed import first_wins, top_k, until_first_stop
from ludoshelf.sources.landing import with_payload

# Members read from a review object and its author.
REVIEW_FIELDS = (
    "recommendationid", "review", "voted_up", "language", "timestamp_created", "timestamp_updated",
    "votes_up", "votes_funny", "weighted_vote_score", "comment_count", "steam_purchase",
    "received_for_free", "written_during_early_access", "developer_response", "author",
)
AUTHOR_FIELDS = (
    "steamid", "num_games_owned", "num_reviews", "playtime_forever", "playtime_last_two_weeks",
    "playtime_at_review", "last_played",
)
SUMMARY_FIELDS = (
    "review_score", "review_score_desc", "total_positive", "total_negative", "total_reviews",
)
# The two polarities that are collected.
POLARITIES = ("positive", "negative")


def landed_reviews(landed: DataFrame) -> DataFrame:
    """Review responses with ``payload`` and ``error``; they need the success flag 1."""
    return with_payload(landed, ("cursor", "reviews", "query_summary"), require_success=True)


def review_pages(admitted: DataFrame) -> DataFrame:
    """Admitted pages of the polarity chains with their items and next cursor."""
    return admitted.where(F.col("review_type").isin(*POLARITIES)).select(
        "app_id",
        "review_type",
        "page_no",
        "cursor",
        variant.items("payload.reviews").alias("items"),
        blank_to_null(variant.text("payload.cursor")).alias("next_cursor"),
    )


def bounded_pages(
    pages: DataFrame,
    keys: list[str],
    limit: int | Column | None,
    page_no: str = "page_no",
    stop: Column | None = None,
) -> DataFrame:
    """First ``limit`` pages (None: all) of every chain, cut after the first stop. A literal limit reaches the scan."""
    window = pages if limit is None else pages.where(F.col(page_no) < limit)
    return window if stop is None else until_first_stop(window, keys, F.col(page_no), stop)


def chain_stop() -> Column:
    """A review chain ends at an empty page, without a next cursor, or when the cursor repeats."""
    return (
        (F.size("items") == 0)
        | F.col("next_cursor").isNull()
        | (F.col("next_cursor") == F.coalesce("cursor", F.when(F.col("page_no") == 0, F.lit("*"))))
    )


def _author(v: Column) -> Column:
    return variant.let(
        variant.read(v, variant.leaves(AUTHOR_FIELDS)),
        lambda a: F.struct(
            F.when(variant.truthy(a["steamid"]), variant.text(a["steamid"])).alias("steam_id"),
            variant.integer(a["num_games_owned"]).alias("games_owned"),
            variant.integer(a["num_reviews"]).alias("reviews_written"),
            variant.integer(a["playtime_forever"]).alias("playtime_forever_minutes"),
            variant.integer(a["playtime_last_two_weeks"]).alias("playtime_last_two_weeks_minutes"),
            variant.integer(a["playtime_at_review"]).alias("playtime_at_review_minutes"),
            epoch_utc(variant.integer(a["last_played"])).alias("last_played"),
        ),
    )


def _source_url(steam_id: Column, app_id: Column) -> Column:
    """The author's page of the review, or the product's review page."""
    by_author = F.concat(
        F.lit("https://steamcommunity.com/profiles/"), steam_id, F.lit("/recommended/"), app_id, F.lit("/")
    )
    return F.coalesce(
        by_author, F.concat(F.lit("https://steamcommunity.com/app/"), app_id, F.lit("/reviews/"))
    )


def _objects(items: Column) -> Column:
    ddl = variant.leaves(REVIEW_FIELDS)
    return F.filter(F.transform(items, lambda x: F.try_variant_get(x, "$", ddl)), lambda x: x.isNotNull())


def _picked(objects: Column, k: Column | None) -> Column:
    """(pos, r) of the k most detailed reviews of one page, or of all. The order is that of ``most_detailed``."""
    if k is None:
        return F.transform(objects, lambda r, i: F.struct(i.alias("pos"), r.alias("r")))
    last = F.lit(2**63 - 1)

    def sort_key(r: Column, i: Column) -> Column:
        created = F.nullif(variant.integer(r["timestamp_created"]), F.lit(0).cast("bigint"))
        return F.struct(
            (-F.length(F.btrim(variant.text(r["review"]), F.lit(SPACES)))).alias("chars"),
            (-F.coalesce(variant.number(r["weighted_vote_score"]), F.lit(0.0))).alias("score"),
            (-F.coalesce(variant.integer(r["votes_up"]), F.lit(0).cast("bigint"))).alias("votes"),
            F.coalesce(-created, last).alias("created"),
            i.alias("pos"),
        )

    filled = F.transform(
        F.transform(objects, sort_key), lambda s: s.withField("chars", F.coalesce(s["chars"], F.lit(0)))
    )
    best = F.slice(F.array_sort(filled), F.lit(1), F.greatest(k, F.lit(0)))
    return F.transform(best, lambda s: F.struct(s["pos"].alias("pos"), F.get(objects, s["pos"]).alias("r")))


def flatten(pages: DataFrame, k: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per object in the pages, with its place in API order (page_no, pos).

    With ``k`` every page is cut to its own k most detailed reviews first. The best k of a chain are among
    them, so the result of ``most_detailed`` is the same, and only those few are read in full and shuffled.
    """
    r = F.col("r")
    zero = F.lit(0).cast("bigint")
    keys = (*keep, "app_id", "review_type", "page_no", "pos")
    opened = variant.computed_once(pages, _objects=_objects(F.col("items")))
    opened = (
        variant.computed_once(opened, _picked=_picked(F.col("_objects"), k))
        .select(*keys[:-1], F.inline("_picked"))
        .select(*keys, "r", _author(r["author"]).alias("author"))
    )
    return opened.select(
        *keys,
        F.coalesce(variant.text(r["recommendationid"]), F.lit("")).alias("recommendation_id"),
        F.coalesce(variant.text(r["review"]), F.lit("")).alias("text"),
        variant.truthy(r["voted_up"]).alias("positive"),
        _source_url(F.col("author.steam_id"), F.col("app_id").cast("string")).alias("source_url"),
        variant.string(r["language"]).alias("language"),
        epoch_utc(variant.integer(r["timestamp_created"])).alias("created_at"),
        epoch_utc(variant.integer(r["timestamp_updated"])).alias("updated_at"),
        F.coalesce(variant.integer(r["votes_up"]), zero).alias("votes_up"),
        F.coalesce(variant.integer(r["votes_funny"]), zero).alias("votes_funny"),
        variant.number(r["weighted_vote_score"]).alias("weighted_vote_score"),
        F.coalesce(variant.integer(r["comment_count"]), zero).alias("comment_count"),
        variant.boolean(r["steam_purchase"]).alias("steam_purchase"),
        variant.boolean(r["received_for_free"]).alias("received_for_free"),
        variant.boolean(r["written_during_early_access"]).alias("written_during_early_access"),
        variant.string(r["developer_response"]).alias("developer_response"),
        "author",
    )


def unique_reviews(reviews: DataFrame) -> DataFrame:
    """Optional: one row per (app, recommendation), the first in API order. Off by default."""
    return first_wins(reviews, ["app_id", "review_type", "recommendation_id"], [F.col("page_no"), F.col("pos")])


def detail_order(text: Column | str, *then: Column) -> list[Column]:
    """Longest stripped text first, then the given sort columns."""
    return [F.length(F.btrim(col(text), F.lit(SPACES))).desc(), *then]


def most_detailed(reviews: DataFrame, k: int | Column, salts: int = 16, key: str = "app_id") -> DataFrame:
    """The k longest reviews per (key, polarity); ties by score, votes, time, then API order.

    One product may own a third of all reviews: rows are cut to k per group in each map task, then per salt.
    """
    order = detail_order(
        "text",
        F.coalesce("weighted_vote_score", F.lit(0.0)).desc(),
        F.col("votes_up").desc(),
        F.col("created_at").desc_nulls_last(),
        F.col("page_no"),
        F.col("pos"),
    )
    return top_k(reviews, [key, "review_type"], order, k, salt_by=("page_no", "pos"), salts=salts)


def told_summaries(admitted: DataFrame) -> DataFrame:
    """Rating summary as the response states it; one row per app globally (locale null) and per locale.

    The total falls back to the sum only when its key is missing; an explicit null counts as 0.
    """
    q = F.col("q")
    zero = F.lit(0).cast("bigint")
    positive = F.coalesce(variant.integer(q["total_positive"]), zero)
    negative = F.coalesce(variant.integer(q["total_negative"]), zero)
    total = F.when(q["total_reviews"].isNull(), positive + negative).otherwise(
        F.coalesce(variant.integer(q["total_reviews"]), zero)
    )
    return (
        admitted.where(F.col("review_type") == "all")
        .withColumn("q", variant.read("payload.query_summary", variant.leaves(SUMMARY_FIELDS)))
        .select(
            "app_id",
            "locale",
            F.col("steam_language").alias("review_language"),
            "store_country",
            variant.integer(q["review_score"]).alias("score"),
            variant.string(q["review_score_desc"]).alias("score_description"),
            positive.alias("total_positive"),
            negative.alias("total_negative"),
            total.alias("total_reviews"),
            percent(positive, negative).alias("positive_percent"),
        )
    )


def recomputed_summaries(
    reviews: DataFrame, app: str, language: str, positive: Column, rounding=percent
) -> DataFrame:
    """Summary from the reviews themselves: per app and per (app, language) in one pass.

    Both groupings share one scan and one partial aggregate; ``language`` is null in the per-app rows and
    ``per_language`` tells them from reviews without a language.
    """
    rows = reviews.select(
        F.col(app).alias("app"), F.col(language).alias("language"), positive.cast("boolean").alias("is_positive")
    )
    sums = rows.groupingSets([[F.col("app")], [F.col("app"), F.col("language")]], "app", "language").agg(
        (F.grouping("language") == 0).alias("per_language"),
        F.count_if(F.col("is_positive")).alias("total_positive"),
        F.count_if(~F.col("is_positive")).alias("total_negative"),
    )
    up, down = F.col("total_positive"), F.col("total_negative")
    return sums.select(
        F.col("app").alias(app),
        F.col("language").alias(language),
        "per_language",
        up,
        down,
        (up + down).alias("total_reviews"),
        rounding(up, down).alias("positive_percent"),
    )


def shortfalls(requested: DataFrame, got: DataFrame, keys: list[str], wanted: str = "wanted") -> DataFrame:
    """Requests (keys + wanted) for which fewer rows were found; apps without any row count as 0."""
    found = got.groupBy(*keys).agg(F.count("*").alias("found"))
    return (
        requested.join(found, keys, "left")
        .withColumn("found", F.coalesce("found", F.lit(0).cast("bigint")))
        .where(F.col("found") < F.col(wanted))
    )
