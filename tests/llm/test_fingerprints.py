import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ludoshelf.llm import fingerprints as fp
from ludoshelf.llm.common import stage
from tests.llm.conftest import PROSE


def by_hand(texts, steps=fp.STEPS):
    """Fingerprints of texts by plain votes, given Spark's hashes of their words."""
    import math

    split = [[w for w in t.lower().replace("\n", " ").replace("\t", " ").split(" ") if w] for t in texts]
    held = Counter(w for words in split for w in set(words))

    def weight(word):
        n = held[word]
        return math.floor(math.log2(len(texts) / n)) + 1 if n * (1 << steps) >= len(texts) else steps + 1

    def of(words, hashes):
        out = []
        for k in range(fp.LONGS):
            bits = 0
            for b in range(64):
                votes = sum(n * weight(w) * (1 if hashes[w][k] >> b & 1 else -1) for w, n in Counter(words).items())
                bits |= (votes > 0) << b
            out.append(bits)
        return out

    return split, of


def hashes_of(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w"), F.xxhash64(F.lit(1), "w")).collect()
    return {r[0]: (r[1] & (1 << 64) - 1, r[2] & (1 << 64) - 1) for r in rows}


def expected(rows):
    """(doc_id, text) rows without ties but exact repeats: doc_id -> sorted (n_chars, digest of the edited text)."""
    out = Counter()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        third = len(text) // 3
        out[doc_id, len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()] += 1
    return out


def test_edited_texts_and_votes(spark, make_docs):
    rnd = random.Random(3)
    words = [f"w{k}é" for k in range(40)]
    texts = [(k * 7 % 31, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for k in range(31)] + [(50, None), (51, ""), (52, "ſ\tK\nw1é"), (None, "w2é w3é")]
    got = fp.edit_likeness(make_docs(texts)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected(texts)

    split, of = by_hand([t or "" for _, t in texts])
    hashes = hashes_of(spark, {w for s in split for w in s})
    prints = {i: of(s, hashes) for (i, _), s in zip(texts, split, strict=True)}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p[1]:016x}{p[0]:016x}" for i, p in prints.items()}

    order = sorted(prints, key=lambda i: (i is None, -(i or 0)))
    likeness = {a: 1 - sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b], strict=True)) / 128 for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert {r.doc_id: r.near_next for r in got} == likeness
    for r in got:
        both = int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)
        assert r.near_edited == 1 - both.bit_count() / 128


def test_an_edited_text_is_nearer_than_the_next(make_docs):
    rnd = random.Random(5)
    words = [f"word{k}" for k in range(3000)]
    got = fp.edit_likeness(make_docs([(k, "the and of " * 20 + " ".join(rnd.choices(words, k=200))) for k in range(60)])).collect()
    assert sum(r.near_edited > r.near_next for r in got) == 60


def test_repeated_rows_follow_themselves(make_docs):
    rows = [(3, PROSE)] * 3 + [(2, PROSE.upper())] * 2 + [(9, "one two three")]
    got = fp.edit_likeness(make_docs(rows)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected(rows)
    assert len({r.fingerprint for r in got if r.doc_id == 3}) == 1
    assert {(r.doc_id, r.group_id) for r in got} == {(3, 2), (2, 2), (9, 9)}


def test_odd_rows(odd_docs, no_docs):
    got = fp.edit_likeness(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.fingerprint for r in got if r.doc_id in (2, 3, 4)} == {"0" * 32}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.edited_sha256) == 64 for r in got)
    assert fp.edit_likeness(no_docs).count() == 0


def random_prints(n, flips, seed):
    rnd = random.Random(seed)
    bases = [rnd.getrandbits(128) for _ in range(n)]
    near = [b ^ sum(1 << k for k in rnd.sample(range(128), rnd.randrange(flips + 1))) for b in bases for _ in range(3)]
    return sorted(set(bases + near + [0, (1 << 128) - 1, 1 << 63, 1 << 127]))


def as_rows(prints, name):
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    return [(k, signed(p & (1 << 64) - 1), signed(p >> 64)) for k, p in enumerate(prints)], f"{name} long, f0 long, f1 long"


@pytest.mark.parametrize(("radius", "blocks"), [(0, 3), (3, 5), (4, 6)])
def test_tables_find_all_within_the_radius(spark, radius, blocks):
    prints = random_prints(120, 7, radius)
    got = fp.search(spark.createDataFrame(*as_rows(prints, "found")), spark.createDataFrame(*as_rows(prints, "query")), radius, blocks)
    want = {(a, b, (p ^ q).bit_count()) for a, p in enumerate(prints) for b, q in enumerate(prints) if (p ^ q).bit_count() <= radius}
    assert {tuple(r) for r in got.collect()} == want
    with pytest.raises(ValueError, match="whole block"):
        fp.block_keys(spark.createDataFrame(*as_rows(prints, "found")), blocks, blocks)


def test_groups_are_components(spark):
    prints = random_prints(60, 3, 1)
    got = {r.node: r.root for r in fp.groups(spark.createDataFrame(*as_rows(prints, "node")), stage(spark)).collect()}
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, p in enumerate(prints):
        for b in range(a):
            if (p ^ prints[b]).bit_count() <= fp.RADIUS:
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {k: find(k) for k in range(len(prints))}
    sizes = Counter(want.values())
    assert got == {k: r for k, r in want.items() if sizes[r] > 1}
