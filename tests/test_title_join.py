import random

import pytest

from ludoshelf.operators import title_join
from ludoshelf.operators.matching import ACCEPT_FROM
from ludoshelf.sources.staging import Staging


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def by_hand(titles, names):
    out = {}
    for t in {t for t in titles if t}:
        best = min(((-(1 - edits(t, n) / max(len(t), len(n))), n) for n in names if n), default=(0, ""))
        if -best[0] >= ACCEPT_FROM:
            out[t] = (best[1], -best[0])
    return out


def catalogue(seed, alphabet, lengths, n):
    """Names, and titles that are names with up to a third of their letters changed."""
    rnd = random.Random(seed)
    names = ["".join(rnd.choices(alphabet, k=rnd.choice(lengths))) for _ in range(n)]
    titles = []
    for name in names * 2:
        for _ in range(rnd.randrange(len(name) // 3 + 2)):
            k = rnd.randrange(len(name) + 1)
            name = rnd.choice([name[:k] + name[k + 1 :], name[:k] + rnd.choice(alphabet) + name[k:], name[:k] + rnd.choice(alphabet) + name[k + 1 :]])
        titles.append(name)
    return titles, names


@pytest.mark.parametrize(
    ("alphabet", "lengths", "crowded"), [("abcdefghij ", [8, 12, 20, 30], 2000), ("ab", [1, 2, 3, 4, 5, 6, 7, 9], 3), ("a", range(1, 30), 1), ("abcdé", [3, 4, 5, 10], 5)]
)
def test_equals_comparing_all_names(spark, alphabet, lengths, crowded):
    titles, names = catalogue(len(alphabet), alphabet, list(lengths), 60)

    def column(values):
        return spark.createDataFrame([(v,) for v in sorted({*values, ""})], "s string")

    got = title_join.nearest(column(titles), column(names), Staging(spark), crowded=crowded).collect()
    assert {r.title: (r.name, r.similarity) for r in got} == by_hand(titles, names)
    assert len(got) == len({r.title for r in got})


def test_a_crowded_block_is_cut(spark):
    names = [f"common prefix {k:04d}" for k in range(300)]
    both = spark.createDataFrame([("common prefix 0001x", "title"), *[(n, "name") for n in names]], "s string, side string")
    placed = title_join.blocks(both, 0.65, 2, 40).where("side = 'name'")
    assert placed.groupBy("gram", "part").count().agg({"count": "max"}).first()[0] < 100
    assert placed.select("part").distinct().count() == 8


def test_titles_by_variant(spark):
    titles = spark.createDataFrame(
        [(1, "Doom™ GOTY"), (2, "doom eternal"), (3, "Portal 3"), (4, "Nothing like it"), (5, None), (6, "Portal 3"), (None, "DOOM")], "app_id bigint, title string"
    )
    names = spark.createDataFrame([(10, "Doom"), (9, "DOOM"), (11, "Doom Eternal"), (12, "Portal 2"), (13, "Portal 1"), (14, None), (15, "")], "name_id bigint, name string")
    got = {(r.app_id, r.title): (r.name_id, r.name, r.variant_ord, round(r.similarity, 3), r.exact) for r in title_join.catalogue_match(titles, names).collect()}
    assert got == {
        (1, "Doom™ GOTY"): (9, "DOOM", 2, 1.0, True), (2, "doom eternal"): (11, "Doom Eternal", 0, 1.0, True), (None, "DOOM"): (9, "DOOM", 0, 1.0, True),
        (3, "Portal 3"): (13, "Portal 1", 0, 0.875, False), (6, "Portal 3"): (13, "Portal 1", 0, 0.875, False),
    }
    assert title_join.catalogue_match(titles.limit(0), names).count() == 0
    assert title_join.catalogue_match(titles, names.limit(0)).count() == 0


def test_no_cross_join(spark, tmp_path):
    titles, names = catalogue(1, "abc", [5, 9], 20)
    frames = [spark.createDataFrame([(v,) for v in sorted(set(values))], "s string") for values in (titles, names)]
    plan = title_join.nearest(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
