"""Incremental landing: each landed record once, and one newest record per key, however late a row lands.

Both write plain Parquet below a folder for every batch. A batch that is tried again overwrites its own folder with the same rows, so a stop at
any point changes nothing; readers need no manifest, since what they compute does not change when rows repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BATCH = "batch"
LATE = "late"
BUCKETS = 1 << 12
NEVER = -(2**63)


def read_increment(
    spark: SparkSession, path: str, schema: str | T.StructType, max_files: int = 1000, glob: str | None = None
) -> DataFrame:
    """New Parquet files of a landing folder, a bounded number of files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def drain(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream until what has landed is done; ``sink`` gets every micro-batch with its number, again after a stop.

    Batches without data are off meanwhile: an operator with timers asks for one after another, so the run would not end. Timers that are due go off in the next batch with data.
    """
    conf, setting = rows.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(setting)
    conf.set(setting, "false")
    try:
        query = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(setting, before)
    query.awaitTermination()


# Newest record per key ------------------------------------------------------------------------------------------------


def newest(rows: DataFrame, keys: Sequence[str], stamps: Sequence[str]) -> DataFrame:
    """The newest row per key, as a partial aggregate; rows with equal stamps are decided by a hash, null stamps are oldest."""
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(*stamps, F.xxhash64(*rows.columns))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in rows.columns])


def append_newest(path: str, keys: Sequence[str], stamps: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A sink that adds the newest row per key of every batch as a delta below ``path``; nothing that is there is read or rewritten."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        newest(batch, keys, stamps).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return sink


def read_newest(spark: SparkSession, schema: T.StructType, keys: Sequence[str], stamps: Sequence[str], *paths: str) -> DataFrame:
    """The newest row per key over all deltas below ``paths``, merged when they are read; a folder that is not there yet has none."""
    deltas = spark.createDataFrame([], schema)
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            deltas = deltas.unionByName(spark.read.schema(schema).parquet(path).select(*schema.names))
    return newest(deltas, keys, stamps)


def compact(spark: SparkSession, schema: T.StructType, keys: Sequence[str], stamps: Sequence[str], path: str, into: str) -> None:
    """Merge the deltas below ``path`` to one table ``into``, as an ordinary job.

    Reading both folders gives the same rows before, during and after this job, and also when any of the merged batch folders have been removed after it.
    """
    read_newest(spark, schema, keys, stamps, path).write.mode("overwrite").parquet(into)


# Each record once -----------------------------------------------------------------------------------------------------


def _runs(*order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by the last array, then the one before it and so on, and where rows begin that differ from the row before in the last two."""
    place = np.lexsort(order)
    one, two = order[-1][place], order[-2][place]
    return place, np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))


def first_of_each(rows: DataFrame, keys: Sequence[str], stamp: str, keep_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """A stream's first row of every key, and with ``late`` true its rows that are older than what is remembered.

    A key is remembered until ``keep_ms`` after the newest of its stamps; then a timer drops it, so the state holds no more than the keys of that time.
    A row whose stamp lies further back when it lands can not be told from a repeat: it goes to the late rows, none is lost. A row without
    stamp is late. Of the rows of one batch the one with the least stamp stays.

    Keys are dealt to ``buckets`` by hash. The keys of a bucket, as 128-bit hashes with their newest stamps, are one state, so a batch costs a call for each
    bucket that it meets instead of each key, and rewrites the states of those buckets. A checkpoint stays with its number of buckets.
    """
    names, schema = rows.columns, rows.schema
    parts = [x for key in keys for x in (F.col(key).isNull(), F.col(key))]  # a hash passes over nulls
    dealt = {
        "_at": F.coalesce(F.unix_millis(F.col(stamp).cast("timestamp")), F.lit(NEVER)),
        "_key1": F.xxhash64(*parts),
        "_key2": F.xxhash64(F.lit(1), *parts),
        "_bucket": F.pmod(F.xxhash64(*parts), F.lit(buckets)),
    }

    def one_bucket(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = [np.frombuffer(x, np.int64) for x in state.get] if state.exists else [np.zeros(0, np.int64)] * 3
        firsts, newest = [], [held[2]]
        for frame in () if state.hasTimedOut else frames:
            in_time = frame["_at"].to_numpy() > now - keep_ms
            if not in_time.all():
                yield frame.loc[~in_time, names].assign(**{LATE: True})
                frame = frame[in_time]
            if len(frame):
                at = frame["_at"].to_numpy()
                place, begins = _runs(at, frame["_key2"].to_numpy(), frame["_key1"].to_numpy())
                firsts.append(frame.iloc[place[begins]])
                newest.append(at[place[np.append(begins[1:], len(place)) - 1]])
        one, two, at = (
            np.concatenate([old, *(f[c].to_numpy() for f in firsts)])
            for c, old in (("_key1", held[0]), ("_key2", held[1]), ("_at", np.full(len(held[0]), NEVER)))
        )
        if not len(one):
            return
        place, begins = _runs(at, two, one)  # what is held stands before this batch's rows of the same key
        chosen, start = place[begins], len(held[0])
        for frame in firsts:
            mine = np.sort(chosen[(chosen >= start) & (chosen < start + len(frame))]) - start
            start += len(frame)
            if len(mine):
                yield frame[names].iloc[mine].assign(**{LATE: False})
        last = np.maximum.reduceat(np.concatenate(newest)[place], begins)
        kept = last + keep_ms > now
        if kept.any():
            state.update(tuple(x[kept].tobytes() for x in (one[chosen], two[chosen], last)))
            state.setTimeoutDuration(int(last[kept].min()) + keep_ms - now)
        elif state.exists:
            state.remove()

    return rows.withColumns(dealt).groupBy("_bucket").applyInPandasWithState(
        one_bucket,
        T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())]),
        "keys1 binary, keys2 binary, lasts binary",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def append_split(once: str, late: str) -> Callable[[DataFrame, int], None]:
    """A sink for ``first_of_each``: first rows below one folder, late rows below another, by batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        is_late: Column = F.col(LATE)
        for path, wanted in ((once, ~is_late), (late, is_late)):
            batch.where(wanted).drop(LATE).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        batch.unpersist()

    return sink
