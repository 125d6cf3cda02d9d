from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.functions.clean import country_code
from ludoshelf.functions.dims import language_by_name, locale_dimension, locale_info
from ludoshelf.operators import requests


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def locale(spark, tag):
    got = one(spark, locale_info(F.lit(tag)))
    return got and tuple(got)


def test_locales(spark):
    assert locale(spark, "ru-RU") == ("ru-RU", "ru", "russian")
    assert locale(spark, "pt-BR") == ("pt-BR", "pt-BR", "brazilian")
    assert locale(spark, " pt_br\n") == ("pt-br", "pt-BR", "brazilian")
    assert locale(spark, "zh-HK") == ("zh-HK", "zh-CN", "schinese")
    assert locale(spark, "zh-TW")[2] == "tchinese"
    assert locale(spark, "es-MX")[2] == "spanish" and locale(spark, "es-419")[2] == "latam"
    assert locale(spark, "xx-XX") is None and locale(spark, " ") is None
    assert locale_dimension(spark).count() == 32


def test_language_names(spark):
    assert tuple(one(spark, language_by_name(F.lit(" Spanish -  Latin America ")))) == ("es-419", "latam")
    assert one(spark, language_by_name(F.lit("Klingon"))) is None


def test_country(spark):
    assert one(spark, country_code(F.lit(" KZ\n"))) == "kz"
    assert one(spark, country_code(F.lit("russian"))) is None
    assert one(spark, country_code(F.lit("k1"))) is None


def test_urls(spark):
    base = "https://store.steampowered.com"
    urls = {
        f"{base}/app/620/Portal_2/?cc=us": 620,
        "HTTP://STORE.steampowered.com/app/7": 7,
        f"{base}/app/7?x=1": 7,
        f"{base}/app/7#top": 7,
        f"{base}/app/7;v": 7,
        f"{base}/app/7 with space/": None,
        f"{base}/app/7x/": None,
        f"{base}/App/7/": None,
        f"{base}:443/app/7/": None,
        "ftp://store.steampowered.com/app/7/": None,
        "https://steamcommunity.com/app/620/": None,
        f"{base}/app/12/Name with space|odd/": 12,
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", requests.app_id_of("url").alias("id"))
    assert {r.url: r.id for r in df.collect()} == urls


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.REQUESTS)


def test_ordered_distinct_locales_and_default(spark):
    url = "https://store.steampowered.com/app/{}/"
    accepted, rejected = requests.normalize(
        frame(
            spark,
            (url.format(1), ["en-US", "EN_us", "ru-RU", "en-US"], None, 4, 4, 1),
            (url.format(2), [], "kz", 4, 4, 1),
            (url.format(3), None, "kz", 4, 4, 1),
            (url.format(3) + "again", ["de"], "us", 4, 4, 1),
            (url.format(4), ["en", "xx"], "kz", 4, 4, 1),
            (url.format(5), ["en"], "kz", -1, 4, 1),
            (url.format(6), ["en"], "kz", 1, 4, 0),
        )
    )
    got = sorted((r.app_id, [x.locale for x in r.locales], r.store_country or "") for r in accepted.collect())
    assert got == [(1, ["en-US", "ru-RU"], ""), (2, ["en-US"], "kz"), (3, ["de"], "us"), (3, ["en-US"], "kz")]
    assert sorted(r.reason for r in rejected.collect()) == ["negative review count", "no review pages", "unsupported locale"]


def test_expansion_counts_two_per_locale_plus_five(spark):
    accepted, _ = requests.normalize(
        frame(spark, ("https://store.steampowered.com/app/620/", ["ru-RU", "en-US"], "kz", 4, 4, 1))
    )
    rows = requests.expand(accepted).collect()
    assert len(rows) == 2 * 2 + 5
    details = {(r.store_country, r.steam_language) for r in rows if r.request_kind == "app_details"}
    assert details == {("kz", "russian"), ("kz", "english")}
    page = [r for r in rows if r.request_kind == "store_page"]
    assert [(r.store_country, r.steam_language) for r in page] == [("kz", "russian")]
    asked = {r.steam_language for r in rows if r.request_kind == "reviews" and r.review_type == "all"}
    assert asked == {"all", "russian", "english"}


def test_no_request_is_lost(spark):
    url = "https://store.steampowered.com/app/7/"
    rows = [(url, ["en-US"], "kz", 4, 4, 1), (url, ["de"], "us", 4, 4, 1), (url, ["fr"], None, 4, 4, 1)] + [(url, ["en"], "us", 4, 4, 1)] * 3
    accepted, rejected = requests.normalize(frame(spark, *rows))
    assert sorted(x.locales[0].locale for x in accepted.collect()) == ["de", "en", "en-US", "fr"]
    assert [r.reason for r in rejected.collect()] == ["repeated request"] * 2
    assert len({r.request_id for r in accepted.collect()}) == 4


def test_default_country(spark):
    asked = frame(spark, ("https://store.steampowered.com/app/7/", None, "us", 4, 4, 1)).drop("store_country")
    assert requests.normalize(asked)[0].first().store_country == "kz"
