import re
from collections import Counter as Bag

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from ludoshelf.llm import mixing, token_counts
from ludoshelf.llm.common import running_total
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["Hello world, it's a test.", "  two  spaces ", "Ünïcödé ß ñ", "aaaa aaaa bbbb", "日本語 text\nwith lines\n\n", "\u2581mark \u2581\u2581", "", "x" * 3000]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.read_pieces()


def test_counts_equal_the_public_tokenizer(pieces):
    """The unigram model of the tokenizers library over the same pieces and scores, without byte fallback."""
    scored, _ = pieces
    public = Tokenizer(models.Unigram([("<unk>", min(scored.values())), *scored.items()], 0, False))
    counter = token_counts.Counter(scored, byte_fallback=False)
    for text in TEXTS:
        want = public.encode("\u2581" + text.replace(" ", "\u2581")).ids if text else []
        assert counter.text(text)[0] == len(want), text


def brute(text, scores, unknown):
    """Best score over all segmentations and, by the tie rule, the number of pieces."""
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            score = scores.get(text[i:j], unknown if j - i == 1 else None)
            if score is not None and best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, best[i][1] + (1 if text[i:j] in scores else len(text[i:j].encode())))
    return best[-1]


def test_ties_and_unknowns_by_brute_force():
    scores = {"a": -1.0, "b": -1.0, "ab": -2.0, "ba": -2.0, "aba": -3.0, "\u2581": -1.0, "\u2581a": -2.0}
    counter = token_counts.Counter(scores, byte_fallback=True)
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = "".join(rng.choice(list("ab é\n"), rng.integers(1, 14)))
        score, n = brute("\u2581" + text.replace(" ", "\u2581"), scores, -13.0)
        assert counter.text(text) == (n, pytest.approx(score)), repr(text)


def test_token_rows(odd_docs, no_docs, pieces):
    got = token_counts.count_tokens(odd_docs)
    assert got.count() == 12 and got.where("n_tokens = 0 and score = 0").count() == 3
    assert token_counts.count_tokens(no_docs).count() == 0


@pytest.fixture(scope="module")
def sources(spark):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(["w"] * int(rng.integers(0, 90))), ["a", "b", None, "Z"][int(min(i % 7, 3))]) for i in range(400)]
    return spark.createDataFrame(texts, "doc_id long, text string, source string")


def water_fill(sizes, weights, cap):
    left, target = dict(sizes), {}
    total = sum(sizes.values())
    while left:
        share = {s: (total - sum(target.values())) * weights[s] / sum(weights[x] for x in left) for s in left}
        full = [s for s in left if share[s] > cap * sizes[s]]
        if not full:
            return target | share
        for s in full:
            target[s] = cap * sizes[s]
            del left[s]
    return target


def test_mix_meets_its_targets(sources):
    mix = mixing.mix(sources, block_words=16, shard_slots=100)
    docs = mix.documents.toPandas()
    rows = sources.toPandas()
    rows["words"] = [len(WORDS.findall(t)) for t in rows.text]
    docs = docs.merge(rows, on="doc_id")
    assert (docs["size"] == docs.words).all() and (docs.taken <= 3 * docs["size"]).all()
    sizes = docs.groupby("source", dropna=False).words.sum().to_dict()
    order = sorted([s for s in sizes if isinstance(s, str)]) + [s for s in sizes if not isinstance(s, str)]
    want = water_fill(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3)
    for source, group in docs.groupby("source", dropna=False):
        key = source if isinstance(source, str) else order[-1]
        assert group.target.iloc[0] == pytest.approx(want[key]) and group.source_size.iloc[0] == sizes[key]
        assert abs(group.taken.sum() - want[key]) <= 32
    again = mixing.mix(sources.repartition(5), block_words=16, shard_slots=100).documents.toPandas()
    assert sorted(map(tuple, again.values.tolist())) == sorted(map(tuple, docs[again.columns].values.tolist()))


def test_slots_and_contents(sources):
    mix = mixing.mix(sources, block_words=16, shard_slots=100)
    slots = mix.slots.toPandas()
    quota = {r.source_no: (r.slots, r.blocks) for r in mix.sources.collect()}
    assert slots.groupby("source_no").size().to_dict() == {s: n for s, (n, _) in quota.items() if n}
    assert (slots.groupby("shard").size().iloc[:-1] == 100).all()
    for s, (n, blocks) in quota.items():  # every pass goes through all blocks once
        times = Bag(slots[slots.source_no == s].block)
        assert all(n // blocks <= times[b] <= -(-n // blocks) for b in range(blocks))
    full = mix.contents().groupBy("shard").agg(F.sum("words").alias("n")).collect()
    assert all(r.n <= 1600 for r in full)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_permutation(size):
    assert sorted(mixing.permuted(np.arange(size), size, 7, 1)) == list(range(size))


def test_mix_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).documents
    assert got.count() == 12 and got.where("size = 0 and taken = 0").count() == 4
    assert mixing.mix(no_docs).documents.count() == 0


def test_running_total(spark):
    df = spark.range(100).selectExpr("id % 3 as s", "id as o", "id % 7 as v", "id div 10 as c")
    got = running_total(df, ["s"], "c", [F.col("o")], "v", "t").collect()
    assert all(r.t == sum(x % 7 for x in range(r.o) if x % 3 == r.s) for r in got)
