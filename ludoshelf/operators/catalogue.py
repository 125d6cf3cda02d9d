"""Id catalogue: flatten pages, distinct, order, limit, keyset paging, chain audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.functions import variant
from ludoshelf.operators.keyed import until_first_stop
from ludoshelf.sources.landing import with_payload
from ludoshelf.sources.staging import Stage, in_place

# Fixed value: ids per full catalogue page.
FULL_PAGE = 50_000


def list_pages(landed: DataFrame) -> DataFrame:
    """Landed ``app_list`` bodies to (chain, page_no, last_appid, apps, next_key, has_more, error).

    ``cursor`` of a landing row is the key the page was asked to continue after; ``url`` names the chain.
    """
    names = ("apps", "last_appid", "have_more_results")
    rows = with_payload(landed, ("response",))
    response = variant.read("payload.response", variant.leaves(names))
    apps = variant.read("r.apps", "array<variant>")
    last = F.try_element_at("apps", F.lit(-1))
    own_key = variant.integer(F.try_variant_get(last, "$.appid", "variant"))
    told = F.col("r.last_appid")
    has_told = told.isNotNull() & (variant.kind(told) != "VOID")
    opened = variant.computed_once(variant.computed_once(rows, r=response), apps=apps)
    return (
        opened.select(
            F.col("url").alias("chain"),
            "page_no",
            F.col("cursor").try_cast("bigint").alias("last_appid"),
            "apps",
            F.when(has_told, variant.integer(told)).otherwise(own_key).alias("next_key"),
            variant.truthy("r.have_more_results").alias("has_more"),
            F.coalesce(
                "error",
                F.when(F.col("r").isNull(), F.lit("no response object")),
                F.when(F.col("apps").isNull(), F.lit("no apps list")),
            ).alias("error"),
        )
    )


def page_ids(pages: DataFrame) -> DataFrame:
    """(chain, page_no, app_id) of every usable id: objects with ``appid`` or bare scalars, above 0."""
    item = F.col("item")
    own = F.coalesce(F.try_variant_get(item, "$.appid", "bigint"), variant.integer(item))
    return (
        pages.select("chain", "page_no", F.explode("apps").alias("item"))
        .select("chain", "page_no", own.alias("app_id"))
        .where(F.col("app_id") > 0)
    )


def stop_rule(page_size: int = FULL_PAGE) -> Column:
    """Why a page is the last one of its chain; null when paging goes on."""
    n = F.size("apps")
    return (
        F.when(F.col("error").isNotNull(), F.lit("error"))
        .when(n == 0, F.lit("empty page"))
        .when(F.col("next_key").isNull(), F.lit("no next key"))
        .when(F.col("next_key") <= F.col("last_appid"), F.lit("key not advancing"))
        .when((n < page_size) & ~F.col("has_more"), F.lit("short page"))
        .when(F.coalesce(F.col("new_ids"), F.lit(0)) == 0, F.lit("no new ids"))
    )


def audited_pages(pages: DataFrame, page_size: int = FULL_PAGE) -> DataFrame:
    """Pages up to and including the first stop of their chain, with ``stop_reason``."""
    new_ids = (
        page_ids(pages)
        .groupBy("chain", "app_id")
        .agg(F.min("page_no").alias("page_no"))
        .groupBy("chain", "page_no")
        .agg(F.count("*").alias("new_ids"))
    )
    known = pages.join(new_ids, ["chain", "page_no"], "left").withColumn("stop_reason", stop_rule(page_size))
    return until_first_stop(known, ["chain"], F.col("page_no"), F.col("stop_reason").isNotNull())


def distinct_ids(ids: DataFrame, column: str = "app_id", limit: int | None = None) -> DataFrame:
    """Distinct positive ids in ascending order, optionally the smallest ``limit`` of them."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    out = (
        ids.select(F.col(column).try_cast("bigint").alias("app_id"))
        .where(F.col("app_id") > 0)
        .distinct()
        .orderBy("app_id")
    )
    return out if limit is None else out.limit(limit)


def app_ids(
    landed: DataFrame, limit: int | None = None, page_size: int = FULL_PAGE, stage: Stage = in_place
) -> DataFrame:
    """The catalogue: ids of all landed pages that belong to an unbroken chain.

    The audit reads the parsed pages several times; ``stage`` may write them once (see ``sources.staging``).
    """
    pages = audited_pages(stage(list_pages(landed), "catalogue_pages"), page_size)
    return distinct_ids(page_ids(pages.where(F.col("error").isNull())), limit=limit)


def keyset_page(ids: DataFrame, column: str, last: int | None, size: int) -> DataFrame:
    """The next ``size`` distinct ids after ``last``; the range filter reaches the scan."""
    key = F.col(column)
    rows = ids if last is None else ids.where(key > last)
    return rows.select(key.alias("app_id")).distinct().orderBy("app_id").limit(size)


def unknown_ids(ids: DataFrame, known: DataFrame) -> DataFrame:
    """Ids not collected before."""
    return ids.select("app_id").distinct().join(known.select("app_id").distinct(), "app_id", "left_anti")


def of_kinds(rows: DataFrame, column: str, kinds: list[str]) -> DataFrame:
    """Rows of the switched-on kinds; a pushed filter."""
    return rows.where(F.col(column).isin(*kinds))
