import random

import pytest
from pyspark.sql import functions as F

from ludoshelf.functions.clean import percent
from ludoshelf.operators import reviews
from ludoshelf.operators.keyed import first_wins, top_k
from tests.payloads import SUMMARY, landing_rows, review


def chain(spark, *bodies, app_id=1, review_type="positive"):
    rows = []
    for n, body in enumerate(bodies):
        rows.append(
            dict(request_kind="reviews", app_id=app_id, review_type=review_type, page_no=n, steam_language="all",
                 cursor="*" if n == 0 else f"c{n}", body={"success": 1, **body})
        )
    return reviews.review_pages(reviews.landed_reviews(landing_rows(spark, rows)))


def test_longest_text_wins_over_votes(spark):
    rows = [
        review("1", "short", votes_up=10, weighted_vote_score="0.8"),
        review("2", "a much longer and more detailed review", votes_up=2, weighted_vote_score="0.2"),
    ]
    best = reviews.most_detailed(reviews.flatten(chain(spark, {"cursor": "next", "reviews": rows})), 1).collect()
    assert [r.recommendation_id for r in best] == ["2"]


def test_tie_order(spark):
    rows = [
        review("a", "same", weighted_vote_score="0.5", votes_up=1, timestamp_created=5),
        review("b", " same ", weighted_vote_score="0.5", votes_up=1, timestamp_created=5),
        review("c", "same", weighted_vote_score="0.5", votes_up=1),
        review("d", "same", weighted_vote_score="0.5", votes_up=2),
        review("e", "same", weighted_vote_score=""),
        review("f", "same", weighted_vote_score=0.9),
        review("g", "sam😀e"),
        "no object",
        {"review": None},
    ]
    for k in (None, F.lit(99)):
        flat = reviews.flatten(chain(spark, {"cursor": "n", "reviews": rows}), k)
        best = reviews.most_detailed(flat, 99).orderBy("rank").collect()
        assert [r.recommendation_id for r in best] == ["g", "f", "d", "a", "b", "c", "e", ""]


def test_review_fields(spark):
    full = review("7", "t", voted_up=1, author={"steamid": 76, "last_played": 0, "num_reviews": "3"}, steam_purchase=True,
                  timestamp_updated="86400", votes_funny=None, weighted_vote_score="bad", developer_response="thanks")
    got = {r.recommendation_id: r for r in reviews.flatten(chain(spark, {"reviews": [full, review("8", "x")]}, app_id=620)).collect()}
    one, two = got["7"], got["8"]
    assert one.positive is True and two.positive is False
    assert one.source_url == "https://steamcommunity.com/profiles/76/recommended/620/"
    assert two.source_url == "https://steamcommunity.com/app/620/reviews/"
    assert one.updated_at.isoformat() == "1970-01-02T00:00:00" and one.created_at is None
    assert (one.votes_funny, one.weighted_vote_score, one.steam_purchase, one.developer_response) == (0, None, True, "thanks")
    assert (one.author.reviews_written, one.author.last_played) == (3, None)


@pytest.mark.parametrize(
    "second, kept",
    [
        ({"cursor": "c9", "reviews": []}, [0, 1]),
        ({"cursor": "", "reviews": [review("2", "b")]}, [0, 1]),
        ({"reviews": [review("2", "b")]}, [0, 1]),
        ({"cursor": "c1", "reviews": [review("2", "b")]}, [0, 1]),
        ({"cursor": "c2", "reviews": [review("2", "b")]}, [0, 1, 2]),
    ],
)
def test_chain_ends(spark, second, kept):
    page = {"cursor": "c1", "reviews": [review("1", "a")]}
    pages = chain(spark, page, second, {"cursor": "c3", "reviews": [review("3", "c")]}, {"cursor": "c4", "reviews": []})
    cut = reviews.bounded_pages(pages, ["app_id", "review_type"], 3, stop=reviews.chain_stop())
    assert sorted(r.page_no for r in cut.collect()) == kept


def test_summary_total_missing_or_null(spark):
    def summary(**more):
        rows = [dict(request_kind="reviews", app_id=1, review_type="all", steam_language="all", body={"success": 1, "query_summary": q})
                for q in (SUMMARY, {"total_positive": 2, "total_negative": 1}, {"total_positive": 2, "total_reviews": None}, {}, None)]
        return landing_rows(spark, rows)

    told = reviews.told_summaries(reviews.landed_reviews(summary())).collect()
    got = sorted((r.total_positive, r.total_negative, r.total_reviews, r.positive_percent or -1) for r in told)
    assert got == [(0, 0, 0, -1), (0, 0, 0, -1), (2, 0, 0, 100.0), (2, 1, 3, 66.67), (33, 11, 44, 75.0)]


def test_percent_rounds_like_python(spark):
    pairs = [(p, n) for p in range(0, 400, 3) for n in range(0, 300, 7)]
    df = spark.createDataFrame(pairs, "p bigint, n bigint").select("p", "n", percent(F.col("p"), F.col("n")).alias("v"))
    for r in df.collect():
        total = r.p + r.n
        assert r.v == (round(r.p * 100 / total, 2) if total else None)


def test_only_success_one_is_admitted(spark):
    rows = [dict(app_id=n, review_type="all", body={"success": s}) for n, s in enumerate((1, 2, "1", True, None, 1.0))]
    read = {r.app_id: r.error for r in reviews.landed_reviews(landing_rows(spark, rows)).collect()}
    assert [n for n, e in read.items() if e is None] == [0, 3, 5]


@pytest.mark.parametrize("k, salts", [(3, 1), (3, 8), ("per key", 4), (2000, 4)])
def test_top_k_equals_brute_force_on_a_hot_key(spark, k, salts):
    rng = random.Random(7)
    data = [(0 if i % 3 == 0 else rng.randrange(40), i, rng.randrange(50)) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, id int, v int").repartition(7)
    limit = F.col("k") % 5 if k == "per key" else k
    got = top_k(df, ["k"], [F.col("v").desc(), F.col("id")], limit, salt_by=("id",), salts=salts)
    want = set()
    for key in range(40):
        rows = sorted((-v, i) for kk, i, v in data if kk == key)
        limit = key % 5 if k == "per key" else k
        want |= {(key, i, n) for n, (_, i) in enumerate(rows[:limit], 1)}
    assert {(r.k, r.id, r.rank) for r in got.collect()} == want


def test_page_cut_gives_the_same_best_rows(spark):
    rng = random.Random(3)
    bodies = [
        {"cursor": f"c{n + 1}", "reviews": [review(f"{n}-{i}", "x" * rng.randrange(6), votes_up=rng.randrange(3)) for i in range(30)]}
        for n in range(5)
    ]
    pages = chain(spark, *bodies)
    whole = reviews.most_detailed(reviews.flatten(pages), 4).select("rank", "recommendation_id").collect()
    cut = reviews.most_detailed(reviews.flatten(pages, F.lit(4)), 4).select("rank", "recommendation_id").collect()
    assert sorted(whole) == sorted(cut)
    assert reviews.flatten(pages, F.lit(4)).count() == 20


def test_selection_ignores_partitioning(spark):
    rows = spark.range(500).select((F.col("id") % 7).alias("k"), "id", (F.col("id") * 37 % 101).alias("v"))
    one = first_wins(rows.coalesce(1), ["k"], [F.col("v"), F.col("id")])
    many = first_wins(rows.repartition(13, "v"), ["k"], [F.col("v"), F.col("id")])
    assert sorted(one.collect()) == sorted(many.collect()) == sorted(first_wins(many, ["k"], [F.col("v"), F.col("id")]).collect())


def test_recomputed_summary_tells_null_language_apart(spark):
    rows = spark.createDataFrame([(1, "en", True), (1, None, False), (1, "en", False)], "app int, lang string, up boolean")
    got = reviews.recomputed_summaries(rows, "app", "lang", F.col("up"))
    assert {(r.lang, r.per_language, r.total_reviews, r.positive_percent) for r in got.collect()} == {
        (None, False, 3, 33.33), (None, True, 1, 0.0), ("en", True, 2, 50.0),
    }
