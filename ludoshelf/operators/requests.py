"""Requests: URL to id, locale and country rules, and the expansion into single fetches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.functions.clean import blank_to_null, col, country_code
from ludoshelf.functions.dims import DEFAULT_LOCALE, DEFAULT_STORE_COUNTRY, locale_info

# Store host and product path.
STORE_URL = (
    r"^(?i:https?://store\.steampowered\.com)/app/(\d+)"
    r"(?:[/?#]|;[^/?#]*(?:[?#]|$)|$)"
)
REPEATED = "repeated request"


def app_id_of(url: Column | str) -> Column:
    """Id in a product URL; null for another scheme, host or path."""
    return blank_to_null(F.regexp_extract(col(url), STORE_URL, 1)).try_cast("bigint")


def normalized_locales(languages: Column | str) -> Column:
    """Locale structs in request order, first of equal tags kept; unsupported tags are null elements.

    The list lies inside one request row, so ordered de-duplication needs no shuffle.
    """
    languages = col(languages)
    asked = F.when(F.size(languages) > 0, languages).otherwise(F.array(F.lit(DEFAULT_LOCALE)))

    def first_of_each(infos: Column, tags: Column) -> Column:
        return F.filter(infos, lambda x, i: x.isNull() | (F.array_position(tags, F.lower(x["locale"])) == i + 1))

    return variant.let(
        F.transform(asked, locale_info),
        lambda infos: variant.let(
            F.transform(infos, lambda x: F.lower(x["locale"])), lambda tags: first_of_each(infos, tags)
        ),
    )


def normalize(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): every request is in one of them. Rejected: url and reason.

    ``request_id`` is a digest of what is asked. Requests for one product with other locales, country or counts stay apart; of
    exact repeats one is accepted and the others are rejected. Without a country column the default country is asked.
    """
    if "store_country" not in requests.columns:
        requests = requests.withColumn("store_country", F.lit(DEFAULT_STORE_COUNTRY))
    rows = variant.computed_once(
        requests.withColumnRenamed("store_country", "asked_country"),
        app_id=app_id_of("url"),
        locales=normalized_locales("languages"),
        store_country=country_code("asked_country"),
    ).withColumn(
        "reason",
        F.when(F.col("app_id").isNull(), F.lit("unsupported url"))
        .when(F.exists("locales", lambda x: x.isNull()), F.lit("unsupported locale"))
        .when(F.col("asked_country").isNotNull() & F.col("store_country").isNull(), F.lit("unsupported country"))
        .when(F.least("positive_review_count", "negative_review_count") < 0, F.lit("negative review count"))
        .when(F.col("review_pages") < 1, F.lit("no review pages")),
    )
    usable = rows.where(F.col("reason").isNull()).drop("reason", "asked_country", "languages")
    asked = F.to_json(F.struct(*usable.columns), {"ignoreNullFields": "false"})
    counted = usable.groupBy(F.sha2(asked, 256).alias("request_id")).agg(
        F.any_value(F.struct(*usable.columns)).alias("r"), F.count("*").alias("n")
    )
    repeats = counted.where("n > 1").select("r.url", F.explode(F.array_repeat(F.lit(REPEATED), (F.col("n") - 1).cast("int"))).alias("reason"))
    refused = rows.where(F.col("reason").isNotNull()).select("url", "reason")
    return counted.select("request_id", "r.*"), refused.unionByName(repeats)


def _fetch(kind: str, locale: Column, country: Column, language: Column, review_type: Column | None = None) -> Column:
    no_text = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("request_kind"),
        locale.alias("locale"),
        language.alias("steam_language"),
        country.alias("store_country"),
        (no_text if review_type is None else review_type).alias("review_type"),
    )


def expand(accepted: DataFrame) -> DataFrame:
    """Every fetch a request needs: 2 per locale plus 5, from one generate over the request row."""
    none = F.lit(None).cast("string")
    country = F.col("store_country")
    first = F.col("locales")[0]
    every = F.lit("all")
    fetches = F.concat(
        F.transform("locales", lambda x: _fetch("app_details", x["locale"], country, x["steam_language"])),
        F.transform("locales", lambda x: _fetch("reviews", x["locale"], none, x["steam_language"], every)),
        F.array(
            _fetch("store_page", first["locale"], country, first["steam_language"]),
            _fetch("achievements", first["locale"], none, first["steam_language"]),
            _fetch("reviews", none, none, every, every),
            _fetch("reviews", none, none, every, F.lit("positive")),
            _fetch("reviews", none, none, every, F.lit("negative")),
        ),
    )
    return accepted.select("request_id", "app_id", F.inline(fetches))
