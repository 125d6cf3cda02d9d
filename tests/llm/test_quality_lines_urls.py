import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from ludoshelf.llm import line_dedup, quality, url_filter
from ludoshelf.llm.common import components, stage
from tests.llm.conftest import PROSE


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = list(zip(words, words[1:], words[2:]))
    often, marked = Counter(threes), set()
    for i, t in enumerate(threes):
        if often[t] > 1:
            marked |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), len(lines)


def test_statistics_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(300):
        text = "".join(rng.choice(list("ab#\n \té"), rng.integers(0, 60)))
        assert quality.statistics(text) == brute_statistics(text)
    assert quality.statistics(None) == (0,) * 6


def test_outliers_go_and_copies_do_not_bend_the_estimate(spark):
    rng = np.random.default_rng(6)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(400)]
    prose = lambda: " ".join(rng.choice(vocabulary, rng.integers(60, 400)))
    junk = lambda: " ".join(w + "###" for w in rng.choice(vocabulary, 120))
    copy = junk()
    texts = [(k, prose(), "en", "a") for k in range(150)] + [(1000 + k, copy, "en", "a") for k in range(400)] + [(2000 + k, junk(), "de", None) for k in range(3)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[k].kept for k in range(150))
    assert not any(got[1000 + k].kept for k in range(400)) and not any(got[2000 + k].base_failed for k in range(3))


def test_mcd_is_the_classical_estimate_of_the_clean_part(spark):
    rng = np.random.default_rng(8)
    clean = rng.normal(0, 2, (3000, quality.D)) + np.arange(quality.D)
    far = rng.normal(40, 1, (700, quality.D))
    vectors = spark.createDataFrame([("g", x.tolist()) for x in np.concatenate([clean, far])], "grp string, x array<double>")
    found = quality.estimates(vectors, stage(spark)).first()
    assert found.mu == pytest.approx(np.arange(quality.D), abs=0.3)


def test_quality_odd_rows(odd_docs, no_docs):
    got = quality.assess(odd_docs).collect()
    assert len(got) == 12 and {r.doc_id for r in got if not r.base_failed} == {5}
    assert quality.keep(odd_docs).columns == odd_docs.columns
    assert quality.assess(no_docs).count() == 0 and quality.keep(no_docs).count() == 0


def brute_dedup(docs):
    seen, out = set(), {}
    for doc_id, text in docs:
        lines = text.split("\n")
        worded = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for at in zip(worded, worded[1:], worded[2:]):
            window = tuple(lines[k] for k in at)
            if window in seen:
                gone |= set(at)
            seen.add(window)
        out[doc_id] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_lines_by_brute_force_and_sql(make_docs):
    rng = np.random.default_rng(9)
    docs = [(k, "\n".join(rng.choice(["a", "b", "c", "", " "], rng.integers(0, 12)))) for k in range(60)]
    got = line_dedup.dedup_lines(make_docs(docs))
    assert {r.doc_id: r.text for r in got.collect()} == brute_dedup(docs)
    documents = make_docs(docs).select("doc_id", "text").toPandas()  # noqa: F841
    want = duckdb.sql(line_dedup.SQL).fetchall()
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect())) == sorted(want)


def test_lines_odd_rows(odd_docs, no_docs):
    got = line_dedup.dedup_lines(odd_docs)
    assert got.count() == 12 and got.where("n_removed > 0").count() == 0
    assert got.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_lines_of_repeated_rows_are_one_document(make_docs):
    text = "x\ny\nz"
    got = line_dedup.dedup_lines(make_docs([(1, text), (1, text), (2, text), (None, "p\nq\nr"), (3, "p\nq\nr\ns")])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "p\nq\nr"), (1, text), (1, text), (2, ""), (3, "s")]


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "x") for k, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string")


def judged(df):
    return {r.page_id: r for r in url_filter.judge(df).collect()}


def test_rules(spark):
    urls = ["http://A.example.NET/en/1", "x://example.net/fr", "http://x.net", "http://net/", "http://badnet/", "https://q.org/fr/?a", "http://example.com/de/x#y", "plain", None, "http://example.com?x://net/"]
    got = judged(pages(spark, [(u, None) for u in urls]))
    verdicts = [(got[k].rule, got[k].verdict) for k in range(len(urls))]
    assert verdicts == [("example.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("net/", "block"), (None, "allow"), ("org/fr/", "allow"), ("example.com/de/", "block"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert (got[0].host, got[0].path) == ("a.example.net", "/en/1") and (got[8].host, got[8].path) == ("", "")


def test_blocks_spread_over_redirects_and_allows_win(spark):
    canonical, refresh = '<LINK href="{}" rel=canonical>', "<meta http-equiv='refresh' content='0; URL={}'>"
    rows = [
        ("http://a.test/1", canonical.format("http://b.test/2")),
        ("http://b.test/2", refresh.format("//bad.net/x")),  # the target is blocked, though no page
        ("http://www.a.test/1?utm_source=x", None),
        ("http://c.test/1", refresh.format("http://bad.net/y")),
        ("http://d.test/1", refresh.format("http://c.test/1")),
        ("http://e.org/fr/z", canonical.format("http://d.test/1")),  # allowed by its rule, and so are its aliases
        ("http://f.test/1", canonical.format("/2")),
    ]
    got = judged(pages(spark, rows))
    assert [got[k].verdict for k in range(7)] == ["block", "block", "block", "allow", "allow", "allow", "allow"]
    frame = pages(spark, rows)
    duck = duckdb.connect()
    duck.register("pages", frame.toPandas())
    assert sorted(duck.sql(url_filter.SQL).fetchall()) == sorted(map(tuple, url_filter.judge(frame).collect()))
    assert got[0].n_aliases == 4 and judged(pages(spark, [])) == {}


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(3)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [tuple(map(int, rng.integers(2000, 2200, 2))) for _ in range(120)] + [(5, 5)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), stage(spark)).collect()}
    assert got == {n: find(n) for n in parent}
