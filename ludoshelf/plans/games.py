"""The whole pipeline: landed responses and requests in, one nested record per product out."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.functions import variant
from ludoshelf.operators import assembly, details, html_facts, matching, requests, reviews
from ludoshelf.operators.keyed import newest_response, until_first_stop
from ludoshelf.sources.landing import scan, to_document, with_page
from ludoshelf.sources.staging import Stage, in_place


class Collected(NamedTuple):
    games: DataFrame
    diagnostics: DataFrame
    failed_apps: DataFrame
    rejected_requests: DataFrame


KEY = "request_id"


def _asked_locales(accepted: DataFrame) -> DataFrame:
    return accepted.select(KEY, "app_id", "store_country", F.posexplode("locales").alias("locale_ord", "l")).select(
        KEY, "app_id", "locale_ord", "l.locale", "l.steam_language", "store_country"
    )


def _first_locale(accepted: DataFrame) -> DataFrame:
    return accepted.select(KEY, "app_id", F.col("locales")[0]["locale"].alias("locale"), "store_country")


def _country(column: str = "store_country") -> Column:
    return F.coalesce(column, F.lit(""))


def _details_answers(landing: DataFrame, locales: DataFrame) -> DataFrame:
    """Landed details of the asked locales and countries, read once and given to every request that asked for them."""
    place = ["app_id", "locale", "_country"]
    asked = locales.withColumn("_country", _country())
    rows = scan(landing, "app_details").withColumn("_country", _country()).drop("steam_language", "store_country")
    rows = rows.join(asked.select(*place).distinct(), place, "left_semi")
    return details.landed_details(rows).join(asked, place).drop("_country")


def _missing(asked: DataFrame, answered: DataFrame, keys: list[str]) -> DataFrame:
    """Asked fetches without an admitted answer, with the error of a refused one."""
    errors = (
        answered.where(F.col("error").isNotNull()).groupBy(*keys).agg(F.max("error").alias("error"))
    )
    good = answered.where(F.col("error").isNull()).select(*keys)
    return (
        asked.join(good, keys, "left_anti")
        .join(errors, keys, "left")
        .withColumn("error", F.coalesce("error", F.lit("not landed")))
    )


def _page(landing: DataFrame, kind: str, first: DataFrame, country: bool, facts: Callable[..., DataFrame], stage: Stage) -> DataFrame:
    """Per request the facts of the newest page of its first locale and, where it counts, its country; ``error`` else.

    Only asked pages are taken, bodies become facts before requests are joined, and what is written is read twice.
    """
    place = ["app_id", "locale", *(["_country"] if country else [])]
    asked = first.withColumn("_country", _country()).select(KEY, *place)
    landed = scan(landing, kind).withColumn("_country", _country()).join(asked.select(*place).distinct(), place, "left_semi")
    told = facts(with_page(newest_response(landed, place)), *place, "error")
    return stage(asked.join(told, place).drop("app_id", "locale", "_country"), kind)


def _polarity(accepted: DataFrame, name: str) -> DataFrame:
    return accepted.select(
        KEY,
        "app_id",
        F.lit(name).alias("review_type"),
        F.col(f"{name}_review_count").alias("wanted"),
        "review_pages",
    )


def _reviews(landing: DataFrame, accepted: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected reviews, wanted per chain, chains that failed)."""
    wanted = _polarity(accepted, "positive").unionByName(_polarity(accepted, "negative"))
    place, chain = ["app_id", "review_type", "page_no"], [KEY, "review_type"]
    asked = wanted.where(F.col("wanted") > 0).select(
        *chain, "app_id", "wanted", "review_pages", F.explode(F.sequence(F.lit(0), F.col("review_pages") - 1)).alias("page_no")
    )
    landed = scan(landing, "reviews").where(F.col("review_type").isin(*reviews.POLARITIES))
    landed = landed.join(asked.select(*place).distinct(), place, "left_semi")
    answered = reviews.landed_reviews(newest_response(landed, place))
    pages = stage(
        answered.select(
            *place,
            "cursor",
            variant.items("payload.reviews").alias("items"),
            F.nullif(variant.text("payload.cursor"), F.lit("")).alias("next_cursor"),
            "error",
        ),
        "review_pages",
    )
    # Flags decide about chains; the items join back by page, so no product's pages meet in one task.
    ends = F.col("error").isNotNull() | F.coalesce(reviews.chain_stop(), F.lit(False))
    flags = pages.select(*place, "error", ends.alias("ends"))
    kept = until_first_stop(asked.join(flags, place), chain, F.col("page_no"), F.col("ends"))
    # A chain fails as a whole: a page that was refused, one missing before the last, or an end that never landed.
    seen = kept.groupBy(*chain, "review_pages").agg(
        F.max("error").alias("error"), F.count("*").alias("pages"), F.max("page_no").alias("last_page"), F.max("ends").alias("ended")
    )
    whole = F.col("error").isNull() & (F.col("pages") == F.col("last_page") + 1) & (F.col("ended") | (F.col("pages") == F.col("review_pages")))
    seen = stage(seen.select(*chain, whole.alias("whole"), F.coalesce("error", F.lit("not landed")).alias("error")), "review_chains")
    failed = (
        wanted.where(F.col("wanted") > 0)
        .join(seen, chain, "left")
        .where(~F.coalesce("whole", F.lit(False)))
        .select(*chain, F.coalesce("error", F.lit("not landed")).alias("error"))
    )
    good = kept.join(seen.where("whole").select(*chain), chain, "left_semi").select(*chain, "app_id", "page_no", "wanted")
    rows = reviews.flatten(pages.drop("error").join(good, place), F.col("wanted"), keep=(KEY, "wanted"))
    picked = reviews.most_detailed(rows, F.col("wanted"), key=KEY).drop("wanted")
    return stage(picked, "reviews"), wanted, failed


def _review_arrays(picked: DataFrame) -> DataFrame:
    item = (
        "recommendation_id text positive source_url language created_at updated_at votes_up votes_funny "
        "weighted_vote_score comment_count steam_purchase received_for_free "
        "written_during_early_access developer_response author"
    ).split()
    ranked = F.struct("rank", F.struct(*item).alias("item"))

    def of(name: str) -> Column:
        mine = F.collect_list(F.when(F.col("review_type") == name, ranked))
        return F.transform(
            F.array_sort(mine, lambda a, b: a["rank"] - b["rank"]), lambda x: x["item"]
        ).alias(name)

    return picked.groupBy(KEY).agg(of("positive"), of("negative"))


def _told(rows: DataFrame, what: str, **values: Column | str) -> DataFrame:
    return assembly.diagnostics(rows, what, key=KEY, **values)


def _diagnostic_array(rows: DataFrame) -> DataFrame:
    return assembly.nest(
        rows, KEY, ["stage", "ord", "code"], ["source", "code", "message", "severity", "details"], "diagnostics"
    )


def collect_games(
    landing: DataFrame,
    requested: DataFrame,
    candidates: DataFrame,
    provider_failures: DataFrame | None = None,
    stage: Stage = in_place,
) -> Collected:
    """One record per accepted request whose product has details.

    ``stage`` may write an intermediate table and read it back (see ``sources.staging``): details, review
    pages and selected reviews are read more than once, so a large run should pass it.
    """
    accepted, rejected = requests.normalize(requested)
    accepted = stage(accepted, "requests")
    locales = _asked_locales(accepted)

    # Details: required. Base facts from the first admitted locale, texts from all.
    answered = stage(
        _details_answers(landing, locales),
        "details",
    )
    picked = details.base_pick(details.with_texts(answered.where(F.col("error").isNull())), KEY, "app_id")
    base = stage(
        details.with_facts(
            picked.select(
                KEY,
                "app_id",
                "localizations",
                F.coalesce(
                    F.nullif(F.col("localizations")[F.col("base.locale")]["name"], F.lit("")),
                    F.col("app_id").cast("string"),
                ).alias("title"),
                F.col("base.data").alias("data"),
            )
        ),
        "base",
    )
    apps, failed = assembly.required(accepted, base, KEY)
    apps = stage(apps, "apps")

    # Pages of the first locale: best effort.
    first = _first_locale(apps)
    store = _page(landing, "store_page", first, True, html_facts.store_facts, stage)
    store_facts = store.where(F.col("error").isNull()).drop("error")
    unlocked = _page(landing, "achievements", first, False, html_facts.achievement_facts, stage)
    achievement_facts = unlocked.where(F.col("error").isNull()).drop("error")

    # Rating summaries: one global, one per locale, by the language asked for.
    summaries = stage(
        reviews.landed_reviews(
            newest_response(scan(landing, "reviews", apps, review_type="all"), ["app_id", "steam_language"])
        ),
        "summaries",
    )
    told = reviews.told_summaries(summaries.where(F.col("error").isNull())).drop("locale", "store_country")
    rating = [f.split(":")[0] for f in schemas.RATING[len("struct<") : -1].split(",")]
    overall = told.where(F.col("review_language") == "all").join(apps.select(KEY, "app_id", "store_country"), "app_id")
    overall = overall.withColumn("locale", F.lit(None).cast("string")).select(
        KEY, F.struct(*rating).alias("steam_rating")
    )
    asked_languages = locales.join(apps.select(KEY), KEY, "left_semi")
    by_locale = (
        asked_languages.join(
            told.withColumnRenamed("review_language", "steam_language"), ["app_id", "steam_language"]
        )
        .withColumnRenamed("steam_language", "review_language")
        .groupBy(KEY)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("locale", F.struct(*rating)))).alias("ratings_by_locale")
        )
    )

    chosen, wanted, broken = _reviews(landing, apps, stage)

    # Outside sources.
    titles = base.select(
        KEY, "app_id", "title", F.col("score_stub.url").alias("known_url"), F.col("score_stub.critic_score").alias("known_score")
    )
    score_pages = with_page(newest_response(scan(landing, "score_page"), ["url"])).select(
        "url", "error", "body"
    )
    scored = stage(matching.score_lookup(titles, score_pages, KEY), "scores")
    of_app = apps.select(KEY, "app_id")
    search_errors = stage(
        candidates.where(F.col("error").isNotNull()).groupBy("app_id").agg(F.max("error").alias("error")).join(of_app, "app_id"), "search_errors"
    )
    usable = (
        candidates.where(F.col("error").isNull())
        .drop("error")
        .join(search_errors.select("app_id").distinct(), "app_id", "left_anti")
        .join(of_app, "app_id")
    )
    matched = stage(matching.best_match(titles, usable, KEY), "matches")
    hours = matching.accepted_match(matched).select(KEY, matching.hours(F.col("best")).alias("how_long_to_beat"))

    # Diagnostics, one union; the stage number gives their order.
    no_details = _missing(locales, answered, [KEY, "locale"]).join(apps.select(KEY), KEY, "left_semi")
    no_store = _missing(first, store, [KEY])
    no_achievements = _missing(first, unlocked, [KEY])
    asked_all = apps.select(KEY, "app_id", F.lit("all").alias("steam_language"))
    no_summary = _missing(asked_all, summaries, ["app_id", "steam_language"])
    no_locale_summary = _missing(asked_languages, summaries, ["app_id", "steam_language"])
    few = reviews.shortfalls(wanted, chosen, [KEY, "review_type"])
    known = titles.join(search_errors.select(KEY), KEY, "left_anti")
    no_hours = known.join(matched.select(KEY), KEY, "left_anti")
    unclear = matching.ambiguous_match(matched)
    no_url = titles.join(scored.select(KEY), KEY, "left_anti")
    no_score = scored.where(F.col("record").isNull()).join(titles.select(KEY, "title"), KEY)
    rows = [
        _told(
            no_details, "details", order=F.col("locale_ord"), subject="locale", locale="locale", error="error"
        ),
        _told(no_store, "store_page", error="error"),
        _told(no_achievements, "achievements", error="error"),
        _told(no_summary, "summary", error="error"),
        _told(
            no_locale_summary,
            "locale_summary",
            order=F.col("locale_ord"),
            subject="locale",
            locale="locale",
            error="error",
        ),
        *(
            _told(broken.where(F.col("review_type") == p), p, error="error")
            for p in reviews.POLARITIES
        ),
        *(
            _told(few.where(F.col("review_type") == p), f"few_{p}") for p in reviews.POLARITIES
        ),
        _told(
            search_errors, "hours_request", error="error"
        ),
        _told(no_hours, "hours_missing", subject="title"),
        _told(
            unclear,
            "hours_ambiguous",
            subject="title",
            best_match=F.col("best.game_name"),
            similarity=F.col("best.similarity").cast("string"),
            candidates=F.to_json("listed"),
        ),
        _told(no_url, "score_url", subject="title"),
        _told(
            no_score,
            "score_request",
            subject="title",
            candidates=F.to_json("candidates"),
            errors=F.to_json("errors"),
        ),
    ]
    if provider_failures is not None:
        failures = provider_failures.join(of_app, "app_id")
        rows += [
            _told(failures.where(F.col("source") == source), what, error="error")
            for source, what in (("hltb", "hours_provider"), ("metacritic", "score_provider"))
        ]
    found = stage(assembly.union_all(rows).join(of_app, KEY), "diagnostics")

    record = assembly.join_all(
        base.join(
            apps.select(
                KEY, "store_country", "review_pages", "positive_review_count", "negative_review_count"
            ),
            KEY,
        ),
        [
            store_facts,
            achievement_facts,
            overall,
            by_locale,
            _review_arrays(chosen),
            scored.select(KEY, F.col("record").alias("provider_score")),
            hours,
            _diagnostic_array(found),
        ],
        KEY,
    )
    return Collected(_record(record), found, failed.select(KEY, "app_id", "url"), rejected)


def _record(joined: DataFrame) -> DataFrame:
    """Column list and types of the final record; absent children become empty."""
    app = F.col("app_id").cast("string")
    shaped = joined.withColumns(
        {
            "platform": F.lit("steam"),
            "store_url": F.concat(F.lit("https://store.steampowered.com/app/"), app, F.lit("/")),
            "achievements_url": F.concat(F.lit("https://steamcommunity.com/stats/"), app, F.lit("/achievements/")),
            "supported_languages": html_facts.override_languages(
                F.col("language_matrix"), F.col("supported_languages")
            ),
            "metacritic": assembly.fallback("provider_score", "score_stub"),
            "reviews": F.struct(
                assembly.empty_if_null("positive", f"array<{schemas.REVIEW}>").alias("positive"),
                assembly.empty_if_null("negative", f"array<{schemas.REVIEW}>").alias("negative"),
                F.col("review_pages").alias("pages_requested"),
                F.col("positive_review_count").alias("positive_requested"),
                F.col("negative_review_count").alias("negative_requested"),
            ),
        }
    )
    columns = []
    for name, data_type in schemas.GAME.items():
        value = (
            assembly.empty_if_null(name, data_type)
            if data_type.startswith(("array", "map"))
            else F.col(name).cast(data_type)
        )
        columns.append(value.alias(name))
    return shaped.select(*columns)


def game_documents(games: DataFrame) -> DataFrame:
    return to_document(games)
