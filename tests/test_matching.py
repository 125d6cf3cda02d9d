from pyspark.sql import functions as F

from ludoshelf import schemas
from ludoshelf.operators import matching


def variants(spark, title):
    return spark.range(1).select(matching.title_variants(F.lit(title)).alias("v")).first().v


def test_title_variants(spark):
    assert variants(spark, "Doom") == ["Doom"]
    assert variants(spark, "Doom™  Complete Edition") == ["Doom™  Complete Edition", "Doom Complete Edition", "Doom"]
    assert variants(spark, "Doom GOTY") == ["Doom GOTY", "Doom"]
    assert variants(spark, "Doom: Game of the Year EDITION") == ["Doom: Game of the Year EDITION", "Doom:"]
    assert variants(spark, "Gold") == ["Gold"] and variants(spark, "Gold Rush") == ["Gold Rush"]


def urls(spark, title, known=None):
    return spark.range(1).select(matching.score_urls(F.lit(title), F.lit(known).cast("string")).alias("v")).first().v


def test_candidate_urls(spark):
    base = "https://www.metacritic.com/game/"
    slug, short = "horizon-zero-dawn-complete-edition", "horizon-zero-dawn"
    assert urls(spark, "Horizon Zero Dawn™ Complete Edition") == [
        f"{base}pc/{slug}/", f"{base}{slug}/", f"{base}pc/{short}/", f"{base}{short}/",
    ]
    assert urls(spark, "Doom", f"{base}doom/") == [f"{base}doom/", f"{base}pc/doom/"]
    assert urls(spark, "игра") == []


def candidates(spark, *rows):
    full = [(1, v, r, n, name, f"u{n}", "1.5", "bad", None, "3", sim, None, None) for n, (v, r, name, sim) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.CANDIDATES)


def best(spark, title, *rows):
    titles = spark.createDataFrame([(1, title)], "app_id bigint, title string")
    return matching.best_match(titles, candidates(spark, *rows)).first()


def test_first_exact_name_wins(spark):
    got = best(spark, "Doom GOTY", (0, 0, "Doom Eternal", 0.99), (0, 1, "DOOM", 0.2), (1, 0, "Doom", 0.9))
    assert (got.best.game_name, got.best.similarity) == ("DOOM", 1.0)


def test_highest_similarity_is_stable(spark):
    got = best(spark, "Doom", (0, 0, "a", 0.7), (0, 1, "b", 0.8), (1, 0, "c", 0.8), (1, 1, "d", 0.1), (1, 2, "e", 0.2), (1, 3, "f", 0.3))
    assert got.best.game_name == "b" and got.listed == ["b", "c", "a", "f", "e"]


def test_threshold(spark):
    titles = spark.createDataFrame([(1, "Doom")], "app_id bigint, title string")
    for value, accepted in ((0.65, 1), (0.649, 0)):
        found = matching.best_match(titles, candidates(spark, (0, 0, "x", value)))
        assert matching.accepted_match(found).count() == accepted
        assert matching.ambiguous_match(found).count() == 1 - accepted


def test_similarity_is_computed_where_none_is_given(spark):
    got = best(spark, "Portal 2", (0, 0, "portal 3", None), (0, 1, "Half-Life", None))
    assert (got.best.game_name, round(got.best.similarity, 3)) == ("portal 3", 0.875)


def test_hours(spark):
    titles = spark.createDataFrame([(1, "x")], "app_id bigint, title string")
    found = matching.best_match(titles, candidates(spark, (0, 0, "X", 0.1)))
    got = found.select(matching.hours(F.col("best")).alias("h")).first().h
    assert (got.main_story_hours, got.main_extra_hours, got.completionist_hours, got.all_styles_hours, got.raw) == (1.5, None, None, 3.0, "{}")


SCORE = '<span data-testid="global-score-value">{}</span><div data-testid="global-score-header">{}</div>'


def lookup(spark, known_url, known_score, *pages):
    titles = spark.createDataFrame(
        [(1, "Doom", known_url, known_score)], "app_id bigint, title string, known_url string, known_score bigint"
    )
    landed = spark.createDataFrame(list(pages) or [("none", None, "")], "url string, error string, body string")
    return matching.score_lookup(titles, landed).first()


def test_score_lookup(spark):
    base = "https://www.metacritic.com/game/"
    got = lookup(spark, "k", None, ("k", None, ""), (f"{base}pc/doom/", None, SCORE.format(80, "metascore")))
    assert (got.record.url, got.record.critic_score) == ("k", None)  # a known page is taken as it is
    got = lookup(spark, "k", None, ("k", "http status 404", ""), (f"{base}pc/doom/", None, "empty"), (f"{base}doom/", None, SCORE.format("7.5", "User Score")))
    assert (got.accepted_ord, got.record.url, got.record.user_score) == (2, f"{base}doom/", 7.5)
    got = lookup(spark, None, 66, (f"{base}pc/doom/", None, "empty"))
    assert (got.record.url, got.record.critic_score) == (f"{base}pc/doom/", 66)  # filled before the test
    got = lookup(spark, "k", 66, (f"{base}doom/", None, ""))
    assert got.record.critic_score == 66
    got = lookup(spark, None, None, (f"{base}doom/", None, ""))
    assert got.record is None and got.candidates == [f"{base}pc/doom/", f"{base}doom/"]
    assert got.errors == [f"{base}pc/doom/: not landed", f"No score found at {base}doom/"]
