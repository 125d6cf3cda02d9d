"""Assembly: diagnostics as rows, required and optional sources, nested output."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions.clean import col

# Order, source, code and message of every diagnostic. {} takes the locale or the title.
DIAGNOSTICS = {
    "details": (1, "steam", "localized_details_failed", "Localized Steam details unavailable for {}"),
    "store_page": (2, "steam_store_html", "page_unavailable", "Steam Store HTML page unavailable"),
    "achievements": (3, "steam_achievements", "page_unavailable", "Steam achievements page unavailable"),
    "summary": (4, "steam_reviews", "summary_unavailable", "Global Steam review summary unavailable"),
    "locale_summary": (
        5, "steam_reviews", "localized_summary_unavailable", "Steam review summary unavailable for {}",
    ),
    "positive": (6, "steam_reviews", "positive_reviews_unavailable", "Positive Steam reviews unavailable"),
    "negative": (7, "steam_reviews", "negative_reviews_unavailable", "Negative Steam reviews unavailable"),
    "few_positive": (
        8, "steam_reviews", "insufficient_positive_reviews",
        "Steam returned fewer positive reviews than requested",
    ),
    "few_negative": (
        9, "steam_reviews", "insufficient_negative_reviews",
        "Steam returned fewer negative reviews than requested",
    ),
    "hours_provider": (10, "hltb", "provider_failed", "HowLongToBeat provider failed"),
    "score_provider": (11, "metacritic", "provider_failed", "Metacritic provider failed"),
    "hours_request": (12, "hltb", "request_failed", "HowLongToBeat request failed"),
    "hours_missing": (12, "hltb", "not_found", "No HowLongToBeat match found for {}"),
    "hours_ambiguous": (
        12, "hltb", "ambiguous_match", "No high-confidence HowLongToBeat match found for {}",
    ),
    "score_url": (13, "metacritic", "url_unavailable", "Could not build a Metacritic URL for {}"),
    "score_request": (13, "metacritic", "request_failed", "Metacritic lookup failed for {}"),
}
SEVERITY = "warning"
# Diagnostics whose message quotes the title.
QUOTED = ("hours_missing", "hours_ambiguous", "score_url", "score_request")


def quoted(text: Column) -> Column:
    """A text in single quotes, or in double quotes if only those are free; backslashes, line ends and inner quotes escaped."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    return F.when(single & ~double, F.concat(F.lit('"'), out, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(out, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def diagnostics(
    rows: DataFrame,
    what: str,
    key: str = "app_id",
    order: Column | None = None,
    subject: Column | str | None = None,
    **details: Column | str,
) -> DataFrame:
    """Each row becomes one diagnostic. Lists among the details are written as JSON text."""
    stage, source, code, message = DIAGNOSTICS[what]
    before, _, after = message.partition("{}")
    text = F.lit(message) if subject is None else F.concat(F.lit(before), quoted(col(subject)) if what in QUOTED else col(subject), F.lit(after))
    pairs = [item for name, value in details.items() for item in (F.lit(name), col(value))]
    found = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(
        F.col(key),
        F.lit(stage).alias("stage"),
        (F.lit(0) if order is None else order).cast("int").alias("ord"),
        F.lit(source).alias("source"),
        F.lit(code).alias("code"),
        text.alias("message"),
        F.lit(SEVERITY).alias("severity"),
        F.map_filter(found, lambda _, v: v.isNotNull()).alias("details"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def nest(rows: DataFrame, key: str, order: Sequence[str], item: Sequence[str], name: str) -> DataFrame:
    """Child rows to one ordered array of structs per key. Only for children bounded per key."""
    sortable = F.struct(*order, F.struct(*item).alias("item"))
    return rows.groupBy(key).agg(
        F.transform(
            F.array_sort(
                F.collect_list(sortable),
                lambda a, b: _compare(a, b, order),
            ),
            lambda x: x["item"],
        ).alias(name)
    )


def _compare(a: Column, b: Column, order: Sequence[str]) -> Column:
    out = F.lit(0)
    for name in reversed(order):
        out = F.when(a[name] < b[name], F.lit(-1)).when(a[name] > b[name], F.lit(1)).otherwise(out)
    return out


def required(rows: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, failed): rows whose required source is there, and rows without it."""
    keys = source.select(key).distinct()
    return rows.join(keys, key, "left_semi"), rows.join(keys, key, "left_anti")


def fallback(first: Column | str, second: Column | str) -> Column:
    """The provider's record, or the stand-in when the provider gave none."""
    return F.coalesce(col(first), col(second))


def join_all(base: DataFrame, children: Sequence[DataFrame], key: str) -> DataFrame:
    """Left joins on one key. All sides are hashed by that key, so each is exchanged once."""
    return reduce(lambda left, child: left.join(child, key, "left"), children, base)


def empty_if_null(name: str, data_type: str) -> Column:
    kind = F.create_map() if data_type.startswith("map") else F.array()
    return F.coalesce(F.col(name), kind.cast(data_type))
