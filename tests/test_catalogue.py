import json

import pytest
from pyspark.sql import functions as F

from ludoshelf.operators import catalogue, keyed
from ludoshelf.sources import landing
from tests.payloads import landing_rows


def pages(spark, *bodies, chain="c"):
    rows = []
    for n, (last, body) in enumerate(bodies):
        rows.append(
            dict(request_kind="app_list", url=chain, page_no=n, cursor=None if last is None else str(last), body=body)
        )
    return landing_rows(spark, rows)


def page(apps, last=None, more=None):
    response = {"apps": apps}
    if last is not None:
        response["last_appid"] = last
    if more is not None:
        response["have_more_results"] = more
    return {"response": response}


def ids(spark, *bodies, **kw):
    return [r.app_id for r in catalogue.app_ids(pages(spark, *bodies), **kw).collect()]


def test_pages_are_joined_by_last_id(spark):
    first = page([{"appid": 10}, {"appid": 20}], 20, True)
    second = page([{"appid": 20}, {"appid": 30}], 30, False)
    assert ids(spark, (None, first), (20, second)) == [10, 20, 30]


def test_limit_keeps_the_smallest(spark):
    assert ids(spark, (None, page([{"appid": 30}, {"appid": 10}, {"appid": 20}], 30, True)), limit=2) == [10, 20]
    with pytest.raises(ValueError):
        ids(spark, (None, page([])), limit=0)


def test_mixed_items(spark):
    apps = [5, "7", {"appid": "9"}, {"appid": None}, None, "x", -3, 0, {"name": "n"}, 2.9, [1]]
    assert ids(spark, (None, page(apps))) == [2, 5, 7, 9]


@pytest.mark.parametrize(
    "second, last, reason",
    [
        (page([], 30, True), 20, "empty page"),
        (page(["x"], None, True), 20, "no next key"),
        (page([{"appid": 30}], "abc", True), 20, "no next key"),
        (page([{"appid": 30}], 20, True), 20, "key not advancing"),
        (page([{"appid": 30}], 30, False), 20, "short page"),
        (page([{"appid": 30}], 30), 20, "short page"),
        (page([{"appid": 20}], 30, True), 20, "no new ids"),
        ("{", 20, "error"),
        ({"response": []}, 20, "error"),
    ],
)
def test_stop_rules(spark, second, last, reason):
    landed = pages(
        spark, (None, page([{"appid": 10}, {"appid": 20}], 20, True)), (last, second), (30, page([{"appid": 99}], 99, True))
    )
    kept = catalogue.audited_pages(catalogue.list_pages(landed)).orderBy("page_no").collect()
    assert [r.stop_reason for r in kept] == [None, reason]


def test_full_page_goes_on_without_flag(spark):
    landed = pages(spark, (None, page([1, {"appid": 2}])), (2, page([3], 3)))
    kept = catalogue.audited_pages(catalogue.list_pages(landed), page_size=2).orderBy("page_no").collect()
    assert [r.next_key for r in kept] == [2, 3]
    assert [r.stop_reason for r in kept] == [None, "short page"]


def test_keyset_and_increment(spark):
    rows = spark.createDataFrame([(i,) for i in (5, 1, 3, 3, 9)], "app_id bigint")
    assert [r.app_id for r in catalogue.keyset_page(rows, "app_id", 1, 2).collect()] == [3, 5]
    assert [r.app_id for r in catalogue.keyset_page(rows, "app_id", None, 2).collect()] == [1, 3]
    known = spark.createDataFrame([(3,), (5,)], "app_id bigint")
    assert sorted(r.app_id for r in catalogue.unknown_ids(rows, known).collect()) == [1, 9]


def test_id_seed_file(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("20\n10\n\n x \n10\n-1\n 30\n")
    assert sorted(r.app_id for r in landing.id_seed(spark, str(tmp_path / "ids.txt")).collect()) == [10, 20, 30]


def test_landing_round_trip_prunes(spark, tmp_path):
    rows = landing_rows(
        spark,
        [
            dict(request_kind="reviews", app_id=1, body={"a": 1}),
            dict(request_kind="store_page", app_id=2, body="<p>"),
        ],
    )
    landing.write_landing(rows, str(tmp_path / "l"))
    scanned = landing.scan(landing.read_landing(spark, str(tmp_path / "l")), "reviews", app_id=1)
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(request_kind" in plan and "EqualTo(app_id,1)" in plan
    assert [json.loads(r.body) for r in scanned.collect()] == [{"a": 1}]


def test_admission(spark):
    rows = landing_rows(
        spark,
        [
            dict(app_id=1, body={"1": {"success": True, "data": {"name": "a"}}}),
            dict(app_id=2, body={"2": {"success": 1, "data": {}}}),
            dict(app_id=3, body={"3": {"success": True, "data": []}}),
            dict(app_id=4, body={"4": {"success": False, "data": {"name": "a"}}}),
            dict(app_id=5, body={"6": {"success": True, "data": {"name": "a"}}}),
            dict(app_id=7, body="[]"),
            dict(app_id=8, body="{"),
            dict(app_id=9, http_status=500, body={"9": {"success": True, "data": {}}}),
        ],
    )
    read = {r.app_id: r.error for r in landing.with_details(rows, ("name",)).collect()}
    lost, odd = "app was not found", "unexpected response"
    assert read == {1: None, 2: None, 3: lost, 4: lost, 5: lost, 7: odd, 8: odd, 9: "http status 500"}


def test_prefix_until_stop_on_a_hot_chain(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id", (F.col("id") % 997 == 996).alias("stop")
    )
    kept = keyed.until_first_stop(rows, ["k"], F.col("id"), F.col("stop"))
    got = {(r.k, r.id) for r in kept.collect()}
    want, ended = set(), set()
    for i in range(20_000):
        k = 0 if i % 3 == 0 else i % 50
        if k not in ended:
            want.add((k, i))
            if i % 997 == 996:
                ended.add(k)
    assert got == want
