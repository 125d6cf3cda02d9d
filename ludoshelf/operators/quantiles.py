"""Quantiles from mergeable sketches: one small sketch per fine group, stored, and rolled up to any coarser group without the values.

A sketch (KLL) holds about ``3 * SIZE`` values however many it has seen, so partial sketches are built before the shuffle and a hot group costs no
more than a small one. New values only need sketches of their own, which are merged with the stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A quantile's rank is off by at most ``RANK_ERROR`` of the values; for this size the sketch promises half of that in 99 of 100 cases.
SIZE = 800
RANK_ERROR = 0.01


def sketches(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``keys``, ``n``, ``total``, ``largest`` and ``sketch`` of the numbers among the values of each group.

    What is no number (null, text, NaN) is skipped; a group of nothing else has n = 0 and null for the rest.
    """
    number = value.try_cast("double")
    read = rows.select(*keys, F.when(~F.isnan(number), number).alias("_value"))
    made = read.groupBy(*keys).agg(
        F.count("_value").alias("n"),
        F.sum("_value").alias("total"),
        F.max("_value").alias("largest"),
        F.kll_sketch_agg_double("_value", F.lit(SIZE)).alias("sketch"),
    )
    return made.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def rolled_up(made: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same table for coarser groups (none: all), from the sketches alone. Sketches of several runs may be put together first."""
    merged = made.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max("largest").alias("largest"),
        F.kll_merge_agg_double("sketch", F.lit(SIZE)).alias("sketch"),
    )
    return merged.withColumns({"n": F.coalesce("n", F.lit(0).cast("long")), "sketch": F.when(F.col("n") > 0, F.col("sketch"))})


def quantile(share: float) -> Column:
    """The value below which about ``share`` of a group's values lie; null for a group without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))


def summary(made: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Number, mean, largest, median and ninth decile of each group, behind ``keys`` (what else to carry)."""
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return made.select(*keys, "n", F.round(mean, 4).alias("avg_hours"), F.col("largest").alias("max_hours"), quantile(0.5).alias("median_hours"), quantile(0.9).alias("p90_hours"))
