import datetime as dt
import json

import pytest

from ludoshelf import Staging, collect_games, game_documents, schemas
from tests.payloads import (
    ACHIEVEMENTS_HTML,
    DETAILS,
    SCORE_HTML,
    STORE_HTML,
    SUMMARY,
    landing_rows,
    review,
)

STORE_URL = "https://store.steampowered.com/app/{}/"


def landing(spark):
    rows = []
    for locale, language in (("ru-RU", "russian"), ("en-US", "english")):
        rows.append(
            dict(request_kind="app_details", app_id=4127, locale=locale, steam_language=language, store_country="kz",
                 body={"4127": {"success": True, "data": DETAILS}})
        )
    rows.append(
        dict(request_kind="app_details", app_id=8806, locale="en-US", steam_language="english", store_country="kz",
             body={"8806": {"success": True, "data": {"name": "Salt Road Deluxe Edition", "type": "dlc"}}})
    )
    rows.append(
        dict(request_kind="app_details", app_id=8806, locale="de", steam_language="german", store_country="kz",
             body={"8806": {"success": False}})
    )
    rows.append(dict(request_kind="app_details", app_id=999, locale="en-US", store_country="kz", body="[]"))
    rows.append(dict(request_kind="store_page", app_id=4127, locale="ru-RU", store_country="kz", body=STORE_HTML))
    rows.append(dict(request_kind="achievements", app_id=4127, locale="ru-RU", body=ACHIEVEMENTS_HTML))
    for language in ("all", "russian", "english"):
        rows.append(
            dict(request_kind="reviews", app_id=4127, steam_language=language, review_type="all", page_no=0, cursor="*",
                 body={"success": 1, "query_summary": SUMMARY, "cursor": "n", "reviews": []})
        )
    for polarity in ("positive", "negative"):
        rows.append(
            dict(request_kind="reviews", app_id=4127, steam_language="all", review_type=polarity, page_no=0, cursor="*",
                 body={"success": 1, "cursor": "next", "reviews": [
                     review("1", "calm", voted_up=polarity == "positive", votes_up=10, weighted_vote_score="0.8"),
                     review("2", "rowed for hours, never found the second lamp", voted_up=polarity == "positive", votes_up=2,
                            weighted_vote_score="0.2", timestamp_created=1700000000, author={"steamid": "77"}),
                 ]})
        )
    rows.append(
        dict(request_kind="score_page", url="https://scores.lantern.example/lantern-harbor-3", body=SCORE_HTML)
    )
    return landing_rows(spark, rows)


def requests(spark):
    return spark.createDataFrame(
        [
            (STORE_URL.format(4127) + "Lantern_Harbor_3/?cc=us", ["ru-RU", "en-US", "ru-ru"], "KZ", 1, 1, 1),
            (STORE_URL.format(8806), ["de", "en_US"], "kz", 2, 0, 1),
            (STORE_URL.format(999), None, "kz", 1, 1, 1),
            ("https://steamcommunity.com/app/4127/", None, "kz", 1, 1, 1),
            (STORE_URL.format(5), ["xx-XX"], "kz", 1, 1, 1),
            (STORE_URL.format(6), ["en-US"], "russian", 1, 1, 1),
        ],
        schemas.REQUESTS,
    )


def candidates(spark):
    return spark.createDataFrame(
        [
            (4127, 0, 0, 11, "Lantern Harbor", "u1", "3", "4", None, "x", 0.9, "{}", None),
            (4127, 0, 1, 12, "LANTERN HARBOR 3", "u2", "8.5", "13", "21", "9", 0.8, '{"a":1}', None),
        ],
        schemas.CANDIDATES,
    )


@pytest.fixture(scope="module")
def collected(spark):
    return collect_games(landing(spark), requests(spark), candidates(spark), stage=Staging(spark))


@pytest.fixture(scope="module")
def games(collected):
    return {row.app_id: row for row in collected.games.collect()}


def test_requests_are_split(collected):
    reasons = {r.url: r.reason for r in collected.rejected_requests.collect()}
    assert reasons == {
        "https://steamcommunity.com/app/4127/": "unsupported url",
        STORE_URL.format(5): "unsupported locale",
        STORE_URL.format(6): "unsupported country",
    }
    assert [r.app_id for r in collected.failed_apps.collect()] == [999]


def test_scalar_facts(games):
    game = games[4127]
    assert list(game.asDict()) == list(schemas.GAME)
    assert (game.platform, game.store_country, game.type, game.is_free) == ("steam", "kz", "game", False)
    assert (game.price.currency, game.price.final, game.price.final_formatted) == ("KZT", 258750, "2 587,50")
    assert game.release_date == dt.date(2017, 2, 9)
    assert game.header_image and game.website is None
    assert game.developers == ["Quayside Nine"] and game.publishers == ["Quayside Nine"]
    assert game.platforms == {"windows": True, "mac": False}
    assert [(c.id, c.name, c.source) for c in game.categories] == [(38, "Online co-op", "steam")]
    assert game.genres == ["Sailing"]
    assert game.requirements.windows.minimum.text == "Windows 8.1"
    assert game.requirements.windows.recommended is None and game.requirements.mac is None


def test_localized_texts(games):
    texts = games[4127].localizations
    assert set(texts) == {"ru-RU", "en-US"}
    assert texts["ru-RU"].steam_language == "russian" and texts["ru-RU"].store_country == "kz"
    assert texts["en-US"].short_description.text == "A harbor of lanterns"
    assert texts["en-US"].short_description.html == "A harbor of <u>lanterns</u>"
    assert texts["en-US"].full_description.text == "Row out at dusk and light the pier"


def test_media_and_age(games):
    game = games[4127]
    assert [(s.id, s.thumbnail_url, s.full_url) for s in game.screenshots] == [(6, "https://img.lantern.example/s6", None)]
    assert [(v.id, v.name, v.highlight) for v in game.videos] == [(31, "Night tide", True)]
    ages = {a.authority: a for a in game.age_ratings}
    assert set(ages) == {"pegi", "esrb"}
    assert ages["pegi"].descriptors == ["Mild peril", "Deep water"] and ages["pegi"].required_age == 7
    assert ages["pegi"].banned is False and ages["esrb"].use_age_gate is True


def test_page_facts(games):
    game = games[4127]
    assert [(t.name, t.rank) for t in game.tags] == [("Boats", 1), ("Fog <thick>", 3)]
    rows = [(x.name, x.web_code, x.interface, x.full_audio, x.subtitles) for x in game.supported_languages]
    assert rows == [("English", "en", False, True, True), ("Russian", "ru", True, True, False)]
    found = [(a.name, a.description, a.global_percent, a.hidden, a.icon_url) for a in game.achievements]
    assert found == [
        ("Lamp Thief", None, None, True, None),
        ("Oarsman", "Cross the bay twice", 6.25, False, "https://img.lantern.example/oar.png"),
    ]


def test_reviews_and_ratings(games):
    game = games[4127]
    assert [r.recommendation_id for r in game.reviews.positive] == ["2"]
    assert game.reviews.positive[0].positive is True and game.reviews.negative[0].positive is False
    assert game.reviews.positive[0].source_url == "https://steamcommunity.com/profiles/77/recommended/4127/"
    assert game.reviews.positive[0].created_at == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert game.steam_rating.positive_percent == 75.0 and game.steam_rating.review_language == "all"
    assert set(game.ratings_by_locale) == {"ru-RU", "en-US"}
    assert game.ratings_by_locale["ru-RU"].review_language == "russian"


def test_outside_sources(games):
    game = games[4127]
    assert (game.metacritic.critic_score, game.metacritic.user_score) == (68, 8.3)
    assert (game.how_long_to_beat.id, game.how_long_to_beat.main_story_hours) == (12, 8.5)
    assert game.how_long_to_beat.raw == '{"a":1}'
    assert game.diagnostics == []


def test_diagnostics_in_order(games):
    game = games[8806]
    assert game.localizations["en-US"].name == "Salt Road Deluxe Edition"
    assert game.supported_languages == [] and game.tags == [] and game.price is None
    assert [(d.source, d.code) for d in game.diagnostics] == [
        ("steam", "localized_details_failed"),
        ("steam_store_html", "page_unavailable"),
        ("steam_achievements", "page_unavailable"),
        ("steam_reviews", "summary_unavailable"),
        ("steam_reviews", "localized_summary_unavailable"),
        ("steam_reviews", "localized_summary_unavailable"),
        ("steam_reviews", "positive_reviews_unavailable"),
        ("steam_reviews", "insufficient_positive_reviews"),
        ("hltb", "not_found"),
        ("metacritic", "request_failed"),
    ]
    assert game.diagnostics[0].details == {"locale": "de", "error": "app was not found"}
    tried = json.loads(game.diagnostics[-1].details["candidates"])
    assert [u.rsplit("/", 2)[1] for u in tried] == ["salt-road-deluxe-edition"] * 2 + ["salt-road"] * 2


def test_documents_keep_nulls(collected):
    docs = [json.loads(r.document) for r in game_documents(collected.games).collect()]
    assert all(list(d) == list(schemas.GAME) for d in docs)
    assert any(d["price"] is None for d in docs)


def test_each_request_has_its_record(spark):
    url = STORE_URL.format(4127)
    asked = [(url, ["ru-RU"], "kz", 1, 1, 1), (url, ["en-US"], "kz", 2, 0, 1), (url, ["en-US"], "us", 1, 1, 1)]
    got = collect_games(landing(spark), spark.createDataFrame(asked, schemas.REQUESTS), candidates(spark), stage=Staging(spark))
    games = sorted((sorted(g.localizations), len(g.reviews.positive), len(g.reviews.negative)) for g in got.games.collect())
    assert games == [(["en-US"], 2, 0), (["ru-RU"], 1, 1)]
    assert [(r.app_id, r.url) for r in got.failed_apps.collect()] == [(4127, url)]  # nothing landed for the third one's country


def test_a_review_chain_without_its_end_fails(spark):
    asked = [(STORE_URL.format(4127), ["ru-RU"], "kz", 1, 1, 3)]  # three pages asked, one landed, and its cursor goes on
    got = collect_games(landing(spark), spark.createDataFrame(asked, schemas.REQUESTS), candidates(spark), stage=Staging(spark))
    game = got.games.first()
    assert game.reviews.positive == [] and game.reviews.negative == []
    assert [d.code for d in game.diagnostics][:2] == ["positive_reviews_unavailable", "negative_reviews_unavailable"]


def test_messages_quote_titles(spark):
    from pyspark.sql import functions as F

    from ludoshelf.operators.assembly import quoted

    titles = ["plain", "Captain's Log", 'say "hi"', "both ' and \"", "back\\slash\n"]
    rows = spark.createDataFrame([(t,) for t in titles], "t string").select("t", quoted(F.col("t")).alias("q")).collect()
    assert [r.q for r in rows] == [repr(t) for t in titles]
