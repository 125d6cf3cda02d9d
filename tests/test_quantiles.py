import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludoshelf.operators import quantiles


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    made = [("rpg", int(d), str(round(float(v), 3))) for d, v in zip(rng.integers(0, 9, 40_000), rng.exponential(20, 40_000))]
    made += [("puzzle", d, str(h)) for d, h in ((1, 3.0), (1, 5.0), (2, 4.0), (3, 4.0))] + [("puzzle", 2, None), ("puzzle", 2, "n/a"), ("puzzle", 3, "NaN"), ("none", 1, "--"), (None, 1, "7")]
    return spark.createDataFrame(made, "genre string, day int, hours string").repartition(5)


def test_rolled_up_twice_within_the_stated_error(rows, tmp_path, spark):
    quantiles.sketches(rows, ["genre", "day"], F.col("hours")).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    by_genre = quantiles.rolled_up(stored, ["genre"])
    got = {r.genre: r for r in quantiles.summary(by_genre, ["genre"]).collect()}
    values = np.sort([float(r.hours) for r in rows.where("genre = 'rpg'").collect()])
    for share, found in ((0.5, got["rpg"].median_hours), (0.9, got["rpg"].p90_hours)):
        assert abs(np.searchsorted(values, found) / len(values) - share) <= quantiles.RANK_ERROR
    assert got["rpg"].n == 40_000 and got["rpg"].max_hours == values[-1] and got["rpg"].avg_hours == pytest.approx(values.mean(), abs=1e-3)
    assert (got["puzzle"].n, got["puzzle"].avg_hours, got["puzzle"].median_hours) == (4, 4.0, statistics.median([3, 5, 4, 4]))
    assert (got["none"].n, got["none"].avg_hours, got["none"].median_hours) == (0, None, None) and got[None].median_hours == 7.0
    everything = quantiles.summary(quantiles.rolled_up(by_genre, []), []).first()
    assert everything.n == 40_005 and abs(np.searchsorted(values, everything.median_hours) / len(values) - 0.5) <= quantiles.RANK_ERROR


def test_new_values_need_only_their_own_sketches(rows):
    old, new = (quantiles.sketches(rows.where(c), ["genre", "day"], F.col("hours")) for c in ("day < 2", "day >= 2"))
    parts = {r.genre: r for r in quantiles.summary(quantiles.rolled_up(old.union(new), ["genre"]), ["genre"]).collect()}
    assert parts["puzzle"].median_hours == 4.0 and parts["rpg"].n == 40_000


def test_no_rows(rows):
    empty = quantiles.sketches(rows.limit(0), ["genre"], F.col("hours"))
    assert quantiles.summary(empty, ["genre"]).count() == 0
    assert quantiles.summary(quantiles.rolled_up(empty, []), []).first().asDict() == {"n": 0, "avg_hours": None, "max_hours": None, "median_hours": None, "p90_hours": None}
