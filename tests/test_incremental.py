import datetime as dt
import time

import pytest

from ludoshelf.operators.keyed import latest_by
from ludoshelf.streaming import incremental as inc

SCHEMA = "app_id bigint, kind string, cursor string, fetched_at timestamp_ntz, body string"
KEYS = ["app_id", "kind", "cursor"]
YEARS = 365 * 86_400_000


def rows(spark, *data):
    return spark.createDataFrame([(a, "reviews", c, None if h is None else dt.datetime(2024, 1, 1, h), b) for a, c, h, b in data], SCHEMA)


def land(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


def newest_rows(spark, schema, keys, *paths):
    return sorted((r.app_id, r.body) for r in inc.read_newest(spark, schema, keys, ["fetched_at"], *paths).collect())


def test_newest_equals_batch_and_late_rows_count(spark, tmp_path):
    first = rows(spark, (1, "*", 1, "a"), (2, "*", 5, "b"), (3, "*", 1, "c"), (5, "*", None, "no stamp"))
    second = rows(spark, (1, "*", 2, "newer"), (2, "*", 4, "older"), (4, "*", 1, "d"), (5, "*", 0, "stamp"))
    landing, deltas, checkpoint = (str(tmp_path / name) for name in ("landing", "deltas", "checkpoint"))
    assert newest_rows(spark, first.schema, ["app_id"], deltas) == []
    for more in (first, second):
        land(more, landing)
        inc.drain(inc.read_increment(spark, landing, first.schema), inc.append_newest(deltas, ["app_id"], ["fetched_at"]), checkpoint)
    want = sorted((r.app_id, r.body) for r in latest_by(first.unionByName(second), ["app_id"], "fetched_at").collect())
    assert newest_rows(spark, first.schema, ["app_id"], deltas) == want
    assert sorted(p.name for p in (tmp_path / "deltas").iterdir()) == ["batch=0", "batch=1"]


def test_a_batch_tried_again_changes_nothing(spark, tmp_path):
    deltas = str(tmp_path / "deltas")
    sink = inc.append_newest(deltas, ["app_id"], ["fetched_at"])
    old, new = rows(spark, *((k, "*", 1, "old") for k in range(20))), rows(spark, *((k, "*", 2, "new") for k in range(0, 20, 2)))
    for batch, number in ((old, 0), (new, 1), (new, 1), (old, 0)):
        sink(batch, number)
    want = [(k, "old" if k % 2 else "new") for k in range(20)]
    assert newest_rows(spark, old.schema, ["app_id"], deltas) == want
    # Written under another number, as after a lost checkpoint: still the same.
    sink(old, 7)
    assert newest_rows(spark, old.schema, ["app_id"], deltas) == want


def test_a_stopped_batch_is_done_after_a_restart(spark, tmp_path):
    landing, deltas, checkpoint = (str(tmp_path / name) for name in ("landing", "deltas", "checkpoint"))
    data = rows(spark, *((k, "*", 1, "x") for k in range(9)))
    land(data, landing)
    sink = inc.append_newest(deltas, ["app_id"], ["fetched_at"])

    def stops(batch, number):
        sink(batch.where("app_id < 4"), number)  # a part is written, then the driver is gone
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        inc.drain(inc.read_increment(spark, landing, data.schema), stops, checkpoint)
    assert len(newest_rows(spark, data.schema, ["app_id"], deltas)) == 4
    inc.drain(inc.read_increment(spark, landing, data.schema), sink, checkpoint)
    assert newest_rows(spark, data.schema, ["app_id"], deltas) == [(k, "x") for k in range(9)]


def test_compaction_keeps_the_rows(spark, tmp_path):
    deltas, base = str(tmp_path / "deltas"), str(tmp_path / "base")
    sink = inc.append_newest(deltas, ["app_id"], ["fetched_at"])
    for hour in range(3):
        sink(rows(spark, *((k, "*", hour, f"at {hour}") for k in range(hour, 6))), hour)
    schema = rows(spark, (1, "*", 1, "a")).schema
    want = newest_rows(spark, schema, ["app_id"], deltas)
    inc.compact(spark, schema, ["app_id"], ["fetched_at"], deltas, base)
    assert newest_rows(spark, schema, ["app_id"], base) == newest_rows(spark, schema, ["app_id"], base, deltas) == want
    sink(rows(spark, (0, "*", 9, "later")), 3)
    assert newest_rows(spark, schema, ["app_id"], base, deltas) == [(0, "later"), *want[1:]]
    assert spark.read.parquet(base).count() == 6


def test_each_record_once_across_restarts_and_late_rows_apart(spark, tmp_path):
    landing, checkpoint, once, late = (str(tmp_path / name) for name in ("landing", "checkpoint", "once", "late"))
    schema = rows(spark, (1, "*", 1, "a")).schema

    def run():
        stream = inc.first_of_each(inc.read_increment(spark, landing, schema, max_files=1), KEYS, "fetched_at", 100 * YEARS)
        inc.drain(stream, inc.append_split(once, late), checkpoint)
        return [sorted(((r.app_id, r.cursor, r.body) for r in spark.read.schema(schema).parquet(path).collect()), key=str) for path in (once, late)]

    land(rows(spark, (1, "*", 21, "again"), (1, "*", 20, "a"), (2, "*", 20, "b")), landing)
    assert run() == [[(1, "*", "a"), (2, "*", "b")], []]
    assert run() == [[(1, "*", "a"), (2, "*", "b")], []]
    old = spark.createDataFrame([(3, "reviews", "*", dt.datetime(1900, 1, 1), "long ago"), (3, "reviews", "*", dt.datetime(1901, 1, 1), "long ago too")], SCHEMA)
    land(rows(spark, (1, "*", 22, "again"), (1, "c1", 22, "c"), (4, "*", None, "no stamp"), (None, None, 3, "no key")).unionByName(old), landing)
    assert set(run()[1]) == {(3, "*", "long ago"), (3, "*", "long ago too"), (4, "*", "no stamp")}
    kept = {(r.app_id, r.cursor, r.body) for r in spark.read.schema(schema).parquet(once).collect()}
    assert kept == {(1, "*", "a"), (2, "*", "b"), (1, "c1", "c"), (None, None, "no key")}


def test_keys_of_one_bucket_are_told_apart(spark, tmp_path):
    """Calls do not grow with the keys: thousands of keys, null and alike ones too, are first, known and dropped each for themselves."""
    landing, checkpoint, once, late = (str(tmp_path / name) for name in ("landing", "checkpoint", "once", "late"))
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0)
    keep = 60 * 60_000

    def run(*data):
        rows = [(a, k, c, None if m is None else now - dt.timedelta(minutes=m), b) for a, k, c, m, b in data]
        land(spark.createDataFrame(rows, SCHEMA).repartition(1), landing)
        inc.drain(inc.first_of_each(inc.read_increment(spark, landing, SCHEMA), KEYS, "fetched_at", keep, buckets=3), inc.append_split(once, late), checkpoint)
        got = [sorted(((r.app_id, r.kind, r.cursor, r.body) for r in spark.read.schema(SCHEMA).parquet(path).collect()), key=str) for path in (once, late)]
        return *got, spark.read.format("statestore").load(checkpoint).count()

    odd = [(None, "a", "b", 5, "x"), (None, "a", None, 5, "x"), (None, None, "a", 5, "x"), (7, "ab", "", 5, "x"), (7, "a", "b", 5, "x")]
    many = [(k, "reviews", "*", 30, f"body {k}") for k in range(4000)]
    first, late_rows, states = run(*odd, *many, *[(k, "reviews", "*", 20, "newer") for k in range(4000)], (1, "reviews", "*", 70, "late"), (5000, "reviews", "*", None, "no stamp"))
    want = sorted(((a, k, c, b) for a, k, c, _, b in [*odd, *many]), key=str)
    assert (first, late_rows, states) == (want, [(1, "reviews", "*", "late"), (5000, "reviews", "*", "no stamp")], 3)
    again, _, states = run(*odd, *many[::2], (4000, "reviews", "*", 1, "new"), (4000, "reviews", "*", 2, "older"))
    assert (again, states) == (sorted([*want, (4000, "reviews", "*", "older")], key=str), 3)


def test_state_is_dropped_by_its_timer(spark, tmp_path):
    """A key is remembered for its time only: afterwards its rows are late, and the state is empty."""
    landing, checkpoint, once, late = (str(tmp_path / name) for name in ("landing", "checkpoint", "once", "late"))
    schema = rows(spark, (1, "*", 1, "a")).schema
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    land(spark.createDataFrame([(k, "reviews", "*", now, "x") for k in range(5)], SCHEMA), landing)

    def run():
        stream = inc.first_of_each(inc.read_increment(spark, landing, schema), KEYS, "fetched_at", 25_000)
        inc.drain(stream, inc.append_split(once, late), checkpoint)
        state = spark.read.format("statestore").load(checkpoint)
        return state.count()

    assert run() == 5
    time.sleep(max(0, 26 - (dt.datetime.now(dt.UTC).replace(tzinfo=None) - now).total_seconds()))
    land(spark.createDataFrame([(0, "reviews", "*", now, "repeat")], SCHEMA), landing)
    assert run() == 0
    assert [(r.app_id, r.body) for r in spark.read.schema(schema).parquet(late).collect()] == [(0, "repeat")]
    assert spark.read.schema(schema).parquet(once).count() == 5
