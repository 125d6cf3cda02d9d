import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ludoshelf.functions.text import plain_text, slug
from ludoshelf.operators import details
from ludoshelf.sources.landing import with_details
from tests.payloads import landing_rows


def facts(spark, **data):
    rows = landing_rows(spark, [dict(app_id=1, body={"1": {"success": True, "data": data}})])
    return details.with_facts(with_details(rows, details.FIELDS).select("app_id", "data")).first()


@pytest.mark.parametrize(
    "raw, date",
    [
        ("Apr 18, 2011", dt.date(2011, 4, 18)),
        ("apr  8,  2011", dt.date(2011, 4, 8)),
        ("April 18, 2011", dt.date(2011, 4, 18)),
        ("May 1, 2020", dt.date(2020, 5, 1)),
        ("18 Apr, 2011", dt.date(2011, 4, 18)),
        ("2011-04-18", dt.date(2011, 4, 18)),
        ("Feb 30, 2020", dt.date(2020, 1, 1)),
        ("18 апр. 2011 г.", dt.date(2011, 1, 1)),
        ("Q3 2025", dt.date(2025, 1, 1)),
        ("0000", None),
        ("Coming soon", None),
    ],
)
def test_release_dates(spark, raw, date):
    got = facts(spark, release_date={"date": f" {raw} ", "coming_soon": True})
    assert (got.release_date, got.release_date_raw, got.coming_soon) == (date, raw, True)


def test_release_without_text(spark):
    assert facts(spark, release_date={"date": "  "}).release_date_raw == "  "
    got = facts(spark, release_date=[])
    assert (got.release_date, got.release_date_raw, got.coming_soon) == (None, None, None)


def test_languages(spark):
    listed = "English<strong>*</strong>, Simplified Chinese, Russian*, , Portuguese - Brazil &amp; more<br><strong>*</strong>languages with full audio support"
    rows = facts(spark, supported_languages=listed).supported_languages
    assert [(x.name, x.web_code, x.full_audio) for x in rows] == [
        ("English", "en", True),
        ("Simplified Chinese", "zh-CN", False),
        ("Russian", "ru", True),
        ("Portuguese - Brazil & more", None, False),
    ]
    assert all(x.interface and x.subtitles for x in rows)
    assert facts(spark, supported_languages="").supported_languages == []
    assert facts(spark, supported_languages=None).supported_languages == []


def test_price_needs_a_currency(spark):
    assert facts(spark, price_overview={"currency": " ", "final": 1}).price is None
    assert facts(spark, price_overview=[1]).price is None
    price = facts(spark, price_overview={"currency": "EUR", "initial": "", "final": "12", "final_formatted": 3}).price
    assert (price.initial, price.final, price.final_formatted) == (None, 12, None)


def test_lenient_booleans(spark):
    values = {True: True, "YES ": True, " no": False, "1": True, "2": None, 0: False, 3.5: True, None: None, "maybe": None}
    for value, want in values.items():
        assert facts(spark, is_free=value).is_free is want, value


def test_null_lists_are_empty(spark):
    got = facts(spark, screenshots=None, movies=None, categories=None, genres="x", developers=None, platforms=[], ratings=None)
    assert (got.screenshots, got.videos, got.categories, got.genres, got.developers) == ([], [], [], [], [])
    assert got.platforms == {} and got.age_ratings == []


def test_score_stub(spark):
    assert facts(spark, metacritic={"url": ""}).score_stub is None
    stub = facts(spark, metacritic={"score": 90}).score_stub
    assert (stub.url, stub.critic_score, stub.platform) == (None, 90, "pc")


def test_full_text_falls_back_on_empty(spark):
    data = {"detailed_description": "", "about_the_game": "About"}
    rows = landing_rows(spark, [dict(app_id=1, locale="en", body={"1": {"success": True, "data": data}})])
    got = details.with_texts(with_details(rows, details.FIELDS)).first().localized
    assert got.full_description.text == "About" and got.short_description is None


def test_base_is_the_first_asked_locale_with_the_newest_body(spark):
    rows = [
        dict(app_id=1, locale=loc, fetched_at=dt.datetime(2024, 1, day), body={"1": {"success": ok, "data": {"name": name}}})
        for loc, day, ok, name in [("de", 1, False, "x"), ("en", 1, True, "old"), ("en", 2, True, "new"), ("fr", 3, True, "fr")]
    ]
    landed = with_details(landing_rows(spark, rows), details.FIELDS).where("error is null")
    order = F.array_position(F.array(*map(F.lit, ("de", "en", "fr"))), F.col("locale"))
    got = details.base_pick(details.with_texts(landed.withColumn("locale_ord", order))).first()
    assert got.base.locale == "en" and {k: v.name for k, v in got.localizations.items()} == {"en": "new", "fr": "fr"}


@pytest.mark.parametrize(
    "html, text",
    [
        ("Short <b>description</b>", "Short description"),
        ("a<br>b<!-- c -->d", "a b d"),
        ("x &lt;b&gt; &amp;amp; y&nbsp;&nbsp;z &#x41;&eacute;", "x <b> &amp; y z Aé"),
        ('<a title="a>b" href=\'c>d\'>e</a> < f', "e < f"),
        ("<script>if (a<b) c</script>d<style>p{}</style>", "if (a<b) c d p{}"),
        (" a\n\tb  c ", "a b c"),
        ("", ""),
        (None, None),
    ],
)
def test_plain_text(spark, html, text):
    got = spark.createDataFrame([(html,)], "h string").select(plain_text("h").alias("t")).first().t
    assert got == text


def test_slug(spark):
    titles = {
        "Horizon Zero Dawn™ Complete Edition": "horizon-zero-dawn-complete-edition",
        "Pokémon — Über!": "pokemon-uber",
        "ﬁne ½": "fine-12",
        "игра": "",
    }
    df = spark.createDataFrame([(t,) for t in titles], "t string").select("t", slug("t").alias("s"))
    assert {r.t: r.s for r in df.collect()} == titles


def test_body_is_parsed_once(spark):
    rows = landing_rows(spark, [dict(app_id=1, body=json.dumps({"1": {"success": True, "data": {"name": "a"}}}))])
    picked = details.with_facts(with_details(rows, details.FIELDS).where("error is null").select("app_id", "data"))
    plan = picked.where("size(genres) > 0 and price is not null")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
