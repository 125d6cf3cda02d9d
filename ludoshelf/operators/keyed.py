"""Keyed selection: first-wins, latest-wins, top-k and prefix-until-stop.

None of them needs a whole group in one task. ``row_number() <= k`` is cut to k rows per group inside
every map task before the shuffle; ``salts`` adds one more level, so that a group spread over very many map
tasks is cut again in parallel before its last step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int | Column,
    salt_by: Sequence[str] = (),
    salts: int = 8,
    rank: str = "rank",
) -> DataFrame:
    """First ``k`` rows per key in ``order``, with their rank. ``k`` may be a column constant per key.

    ``order`` must be total. ``salt_by`` names columns that spread the rows of one key; the salt is a
    hash of them, so a recomputed task routes its rows as before. A literal ``k`` is also cut in the map tasks where the
    planner pushes rank limits; a column ``k`` is not, so a key with very many rows wants ``salt_by`` then.
    """
    if salt_by:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= k).drop(rank, "_salt")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def first_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], salt_by: Sequence[str] = (), salts: int = 8
) -> DataFrame:
    """The first row per key."""
    return top_k(df, keys, order, 1, salt_by, salts).drop("rank")


def latest_by(df: DataFrame, keys: Sequence[str], *stamps: str | Column) -> DataFrame:
    """The newest row per key by the given columns, which together must be a total order."""
    return first_wins(df, keys, [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in stamps])


def newest_response(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest landed response per key; equal or missing stamps are decided by status and body, so a retry agrees."""
    return latest_by(df, keys, "fetched_at", "http_status", F.xxhash64("body"), F.xxhash64(F.lit(1), "body"))


def until_first_stop(df: DataFrame, keys: Sequence[str], order: Column, stop: Column) -> DataFrame:
    """Rows of each chain up to and including its first stop row.

    Flags decide: the stop position is a partial aggregate (one row per chain), and what lies behind it is found on
    rows of key and order alone. The whole rows meet only the positions to drop, by key and order, so a chain that holds a
    large share of the rows is spread. ``df`` is read for the flags and for the rows; write it first where it is costly. A null stop is none.
    """
    marked = df.withColumn("_order", order)
    flags = marked.select(*keys, "_order", stop.alias("_stop"))
    stops = flags.where("_stop").groupBy(*keys).agg(F.min("_order").alias("_stop_at"))
    behind = flags.join(stops, list(keys)).where(F.col("_order") > F.col("_stop_at")).select(*keys, "_order").distinct()
    return marked.join(behind, [*keys, "_order"], "left_anti").select(*df.columns)
