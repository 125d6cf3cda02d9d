"""Reports over the incremental paths; their results equal the batch ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.operators.keyed import latest_by
from ludoshelf.plans.workload import table
from ludoshelf.session import shared_dir
from ludoshelf.streaming.incremental import append_newest, append_split, drain, first_of_each, read_increment, read_newest

KEPT = 200 * 365 * 86_400_000  # the test events are years old: remember them all the same
COLUMNS = ("event_id", "user_id", "event_type", "ts")


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ludoshelf/{uuid.uuid4().hex}"


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land twice, the second time in another order; each is kept once, or among the late ones if its time is no longer remembered."""
    root = _run_dir(spark)
    events = table(spark, sf_dir, "events").select(*COLUMNS)
    for order in ("event_id", "ts"):
        events.repartition(3, order).write.mode("append").parquet(f"{root}/landing")
    rows = read_increment(spark, f"{root}/landing", events.schema, max_files=4)
    drain(first_of_each(rows, ["event_id", "event_type"], "ts", KEPT), append_split(f"{root}/once", f"{root}/late"), f"{root}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{root}/once").select("event_id", "user_id", "event_type")


LANDING_STREAM = "SELECT event_id, user_id, event_type FROM events"


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_by(events, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


LATEST_BY_KEY = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""


def latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through micro-batches that append deltas, batch files in any order."""
    root = _run_dir(spark)
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    events.repartition(4, "event_id").write.parquet(f"{root}/landing")
    keys, stamps = ["user_id"], ["ts", "event_id"]
    drain(read_increment(spark, f"{root}/landing", events.schema, max_files=2), append_newest(f"{root}/deltas", keys, stamps), f"{root}/checkpoint")
    latest = read_newest(spark, events.schema, keys, stamps, f"{root}/deltas")
    return latest.select("user_id", "event_id", "event_type", "value", F.col("ts").isNotNull().alias("placed"))


LATEST_UPSERT = f"SELECT *, true AS placed FROM ({LATEST_BY_KEY})"

REPORTS = {
    "landing_stream": (landing_stream, LANDING_STREAM),
    "latest_by_key": (latest_by_key, LATEST_BY_KEY),
    "latest_upsert": (latest_upsert, LATEST_UPSERT),
}
