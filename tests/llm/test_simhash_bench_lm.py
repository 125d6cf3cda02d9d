import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ludoshelf.llm import decontaminate, lm, simhash
from ludoshelf.llm.trie import EliasFano, Quantised, Trie
from tests.llm.conftest import PROSE


def brute_print(text, words=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    split = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(split[k : k + words]) for k in range(len(split) - words + 1)] or ([" ".join(split)] if split else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_code_is_perfect():
    assert len(set(simhash.ERRORS.tolist())) == 2048
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 2000)
    own = simhash.indices(words, 23)
    assert set(np.unique([len(set(r)) for r in own.tolist()])) <= {1, 6}


def test_linked_prints_share_a_key():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    other = prints.copy()
    for k in range(len(other)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            other[k] ^= np.uint64(1) << np.uint64(bit)
    sets = []
    for side in (prints, other):
        of, key = simhash.keys(side)
        groups = [set() for _ in side]
        for i, k in zip(of, key):
            groups[i].add(int(k))
        sets.append(groups)
    assert all(a & b for a, b in zip(*sets))


def test_near_duplicates_by_brute_force(make_docs):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(["Ab", "cd", "ef", "é", "gh", "ij"], 60)) for _ in range(25)]
    texts = list(base)
    for text in base:
        for _ in range(3):
            words = text.split(" ")
            words[rng.integers(60)] = "changed"
            texts.append(" ".join(words))
    texts += ["", "", "one two", "ONE two"]
    docs = list(enumerate(texts, 10))
    prints = {i: brute_print(t) for i, t in docs}
    root = {i: i for i, _ in docs}
    for _ in docs:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    got = simhash.near_duplicates(make_docs(docs)).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == root


def test_representatives(make_docs, odd_docs, no_docs):
    rng = np.random.default_rng(12)
    text = " ".join(rng.choice([f"w{k}" for k in range(400)], 300))
    words = text.split(" ")
    near = " ".join([*words[:150], "other", *words[151:]])
    far = " ".join(rng.permutation(words))
    got = simhash.representatives(make_docs([(4, text), (2, near), (3, text), (2, near), (9, far), (7, ""), (8, None)]))
    assert sorted(r.doc_id for r in got.collect()) == [2, 7, 9]
    kept = simhash.representatives(odd_docs)
    assert kept.columns == odd_docs.columns and simhash.representatives(no_docs).count() == 0
    assert {r.doc_id for r in kept.collect()} >= {None, 5, 6, 7}


def test_representatives_by_brute_force(make_docs):
    """Pairs at a similarity of 0.7 to 0.9, long and short: one of two stays exactly if they are at 0.8 or more."""
    rng = np.random.default_rng(31)
    texts, similar = [], {}
    for k in range(150):
        n = int(rng.integers(12, 300))
        words = [f"d{k}w{v}" for v in rng.integers(0, 10_000, n)]
        other = list(words)
        for _ in range(int(rng.integers(1, max(2, n // 28 + 1)))):
            at = int(rng.integers(0, n))
            other[at] = "changed"
        of = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, other)]
        similar[k] = len(of[0] & of[1]) / len(of[0] | of[1])
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    assert sum(0.8 <= s < 0.9 for s in similar.values()) >= 20 and sum(0.7 <= s < 0.8 for s in similar.values()) >= 20
    kept = {r.doc_id for r in simhash.representatives(make_docs(texts)).collect()}
    assert kept == {2 * k for k in similar} | {2 * k + 1 for k, s in similar.items() if s < 0.8}


def near_copies(rng, number):
    """Texts 2k and 2k + 1 that differ in a few words, and the similarity and bits of each two."""
    texts, similar, bits = [], {}, {}
    for k in range(number):
        words = [f"d{k}w{v}" for v in rng.integers(0, 10_000, 300)]
        other = list(words)
        for at in rng.integers(0, 300, int(rng.integers(1, 6))):
            other[at] = "changed"
        a, b = (simhash.shingle_set(" ".join(w), 5) for w in (words, other))
        similar[k] = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        bits[k] = int((simhash.wide_print(a)[:1] ^ simhash.wide_print(b)[:1]).view(np.uint64)[0]).bit_count()
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return texts, similar, bits


def test_representatives_meet_in_golay_keys(make_docs, monkeypatch):
    """Without any shared shingle as key, exactly those that SimHash's Golay keys promise are linked."""
    texts, similar, bits = near_copies(np.random.default_rng(17), 60)
    near = {k for k in similar if similar[k] >= 0.8 and bits[k] <= simhash.RADIUS}
    assert len(near) >= 10 and len(similar) - len(near) >= 10
    whole = simhash.text_prints
    monkeypatch.setattr(simhash, "text_prints", lambda *of: whole(*of).withColumn("keys", F.expr("slice(keys, 1, 0)")))
    kept = {r.doc_id for r in simhash.representatives(make_docs(texts)).collect()}
    assert kept == {i for i, _ in texts} - {2 * k + 1 for k in near}


def test_sets_are_made_only_for_pairs_whose_prints_agree(spark, make_docs, monkeypatch):
    """Texts that share a passage meet in its shingles, but are far from similar: none of them is read again."""
    rng = np.random.default_rng(18)
    texts = [(k, " ".join([f"d{k}w{v}" for v in rng.integers(0, 10_000, 100)] + PROSE.split()[:12])) for k in range(80)]
    texts += [(100, texts[0][1] + " more"), (101, texts[1][1] + " more")]
    made, whole = [], simhash.shingle_sets

    def counted(docs, words, keys):
        if keys == ["node"]:
            made.append(docs.select("node").distinct().count())
        return whole(docs, words, keys)

    monkeypatch.setattr(simhash, "shingle_sets", counted)
    monkeypatch.setattr(simhash, "common_shingles", lambda *of: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    kept = {r.doc_id for r in simhash.representatives(make_docs(texts)).collect()}
    assert kept == set(range(80)) and 4 <= sum(made) <= 8


def test_parity_prints_never_differ_in_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(8)
    for n, changed in ((1, 1), (30, 3), (146, 30), (3000, 700), (3000, 3000)):
        hashes = np.unique(rng.integers(-(2**63), 2**63 - 1, n + changed, np.int64))
        a, b = hashes[:n], hashes[changed:]
        bits = sum(int(x).bit_count() for x in (simhash.parity_print(a) ^ simhash.parity_print(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))
    assert not simhash.parity_print(hashes[:0]).any() and not simhash.wide_print(hashes[:0]).any()


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == 12 and {r.fingerprint for r in got if r.doc_id in (2, 3, 4)} == {"0" * 16}
    assert {r.component_id for r in got if r.doc_id is None} <= {1, 2}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_documents_shorter_than_an_item_meet_an_anchor(spark, make_docs):
    """Items of ten words without the last one share five of six shingles."""
    items = [[f"i{k}x{j}" for j in range(10)] for k in range(60)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = decontaminate.contaminations(make_docs([(k, " ".join(w[:9])) for k, w in enumerate(items)]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k in range(60)}


def test_decontamination_by_brute_force(spark, make_docs):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(300)]
    draw = lambda n: list(rng.choice(vocabulary, n))
    items = [draw(rng.integers(1, 70)) for _ in range(25)] + [["", "  "], draw(3)]
    docs = []
    for k in range(120):
        words = draw(rng.integers(0, 150))
        item = list(items[rng.integers(25)])
        if k % 2:
            for _ in range(rng.integers(0, 3)):
                item[rng.integers(len(item))] = "edited"
            at = rng.integers(len(words) + 1)
            words[at:at] = item
        docs.append((k, ", ".join(words).upper()))
    bench = spark.createDataFrame([(k, " ".join(w), "x") for k, w in enumerate(items)] + [(50, None, "x"), (None, "lone item text", "x")], "item_id long, text string, n string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminations(make_docs(docs), bench).collect()}
    want = {}
    for i, text in docs:
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        for k, item in enumerate(items):
            item = [w for w in item if w.strip()]
            if not item:
                continue
            n, size = min(len(item), len(words)), min(5, len(item))
            bag = Counter(tuple(item[a : a + size]) for a in range(len(item) - size + 1))
            best = 0
            for a in range(len(words) - n + 1):
                window = Counter(tuple(words[b : b + size]) for b in range(a, a + n - size + 1))
                shared = (bag & window).total()
                best = max(best, shared / max(1, (bag | window).total()))
            if best >= 0.8:
                want[i, k] = best
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) > 20  # windows in line with an anchor
    assert all(got[x] == pytest.approx(want[x]) for x in got)
    left = {r.doc_id for r in decontaminate.clean(make_docs(docs), bench).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in got}


def test_windows_between_anchors_and_beyond_the_radius_are_found(spark, make_docs):
    """Halves that changed places score best where no single anchor puts a window; a run of one word moves a print by more than the radius."""
    short, long = [f"s{k}" for k in range(60)], [f"t{k}" for k in range(300)]
    bench = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(long)), (None, "an item without a number stands here")], "item_id long, text string")
    other = [f"o{k}" for k in range(500)]
    docs = [
        (1, other[:200] + short[30:] + short[:30] + other[200:400]),
        (2, other[:150] + long[:270] + ["ha"] * 30 + other[150:]),
        (3, other[:90] + short[:20] + other[90:120] + short[20:] + other[120:]),
        (4, other[:50] + "an item without a number stands here".split() + other[50:]),
        (5, other),
    ]
    got = decontaminate.contaminations(make_docs([(k, " ".join(w)) for k, w in docs]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.start) for r in got if r.item_id) == [(1, 1, 200), (2, 2, 120)]  # of equally similar windows the first
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == {(1, 1): pytest.approx(52 / 60), (2, 2): pytest.approx(266 / 326), (4, None): 1}
    assert {r.doc_id for r in decontaminate.clean(make_docs([(k, " ".join(w)) for k, w in docs]), bench).collect()} == {3, 5}


def test_all_windows_by_brute_force(spark, make_docs):
    """Edits that move, repeat and insert words; every document, item, start and similarity is that of all windows."""
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(40)]
    draw = lambda n: list(rng.choice(words, n))
    items = [draw(n) for n in (3, 5, 9, 14, 25, 40, 59)] + [["again"] * 30 + draw(12), (draw(3) * 9)[:25]]
    docs = []
    for k in range(150):
        item = list(items[k % len(items)])
        cut = int(rng.integers(len(item)))
        for _ in range(rng.integers(0, 3)):
            at = int(rng.integers(len(item)))
            item[at:at] = [draw(1), ["again"] * 5, item[at : at + 3]][rng.integers(3)]
        item = item[cut:] + item[:cut] if k % 3 == 0 else item[: len(item) - k % 4]
        around = draw(rng.integers(0, 80)) if k % 5 else []
        docs.append((k, around[:30] + item + around[30:] + (item if k % 7 == 0 else [])))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in decontaminate.contaminations(make_docs([(k, " ".join(w)) for k, w in docs]), bench).collect()}
    want = {}
    for i, text in docs:
        for k, item in enumerate(items):
            n, size = min(len(item), len(text)), min(5, len(item))
            bag = Counter(tuple(item[a : a + size]) for a in range(len(item) - size + 1))
            windows = [Counter(tuple(text[b : b + size]) for b in range(a, a + n - size + 1)) for a in range(len(text) - n + 1)]
            scores = [(bag & w).total() / max(1, (bag | w).total()) for w in windows]
            if max(scores, default=0) >= 0.8:
                want[i, k] = (scores.index(max(scores)), n, max(scores))
    assert len(want) > 40 and set(got) == set(want)
    assert all(got[x] == (want[x][0], want[x][1], pytest.approx(want[x][2])) for x in want)


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, PROSE, "a"), (1, PROSE, "a"), (2, "", "b"), (None, None, None)], "item_id long, text string, shingles string")
    got = decontaminate.contaminations(odd_docs, bench)
    assert sorted((r.doc_id or 0, r.item_id) for r in got.collect()) == [(0, 1), (1, 1), (1, 1)]
    assert sorted(r.doc_id or 0 for r in decontaminate.clean(odd_docs, bench).collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert decontaminate.contaminations(no_docs, bench).count() == 0
    assert decontaminate.contaminations(odd_docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("n, universe", [(0, 9), (1, 1), (700, 5000), (900, 10**13), (64, 64)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n)) if universe > 64 else np.arange(n)
    sequence = EliasFano(values)
    assert (sequence.get(np.arange(len(values))) == values).all()
    ask = np.concatenate([values, rng.integers(0, universe + 9, 500)])
    place = {int(v): k for k, v in enumerate(values)}
    assert sequence.search(ask).tolist() == [place.get(int(v), -1) for v in ask]


def test_trie_finds_grams_of_three_orders():
    rng = np.random.default_rng(7)
    grams = np.unique(rng.integers(0, 12, (400, 3)), axis=0)
    pairs = np.unique(grams[:, :2], axis=0)
    place = {tuple(p): k for k, p in enumerate(pairs.tolist())}
    context = np.array([place[tuple(g)] for g in grams[:, :2].tolist()])
    trie = Trie(14, [(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)) / 7), (context, grams[:, 2], np.zeros(len(grams)))], np.zeros(14))
    every = np.array([(a, b, c) for a in range(14) for b in range(14) for c in range(14)])
    known = {tuple(g): k for k, g in enumerate(grams.tolist())}
    assert trie.find(every).tolist() == [known.get(tuple(g), -1) for g in every.tolist()]
    assert trie.find(every[:, :2]).tolist() == [place.get(tuple(g[:2]), -1) for g in every.tolist()]


def test_quantised_values_are_near():
    values = -np.random.default_rng(1).exponential(1, 5000)
    assert np.abs(Quantised(values).get(np.arange(5000)) - values).max() <= np.ptp(values) / 256


def model(docs):
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in docs}
    one, two = Counter(), Counter()
    for i, words in tokens.items():
        if not lm.held_out(i):
            one.update(words)
            two.update(zip([b"\n", *words], words))
    n, types, once = one.total(), len(one), sum(c == 1 for c in two.values())
    share = min(once / n, 1) if n else 1
    unigram = lambda w: (one[w] + 1) / (n + types + 1)

    def probability(v, w):
        weight = share + (1 - share) * lm.K / (one[v] + lm.K) if one[v] else 1
        return (1 - weight) * two[v, w] / max(one[v], 1) + weight * unigram(w)

    return tokens, one, unigram, probability


def test_scores_by_brute_force(make_docs):
    rng = np.random.default_rng(5)
    words = ["The", "a", "cat", "dog", "sat", "ran", "on", "mat", "é"] + [f"rare{k}" for k in range(200)]
    share = np.array([8.0] * 9 + [0.1] * 200)
    docs = [(k, " ".join(rng.choice(words, rng.integers(0, 80), p=share / share.sum()))) for k in range(120)] + [(500, None), (501, "")]
    tokens, one, unigram, probability = model(docs)
    for v in (b"\n", b"cat", b"rare3"):  # a distribution over the training tokens and one unknown
        assert sum(probability(v, w) for w in [*one, b"never"]) == pytest.approx(1)
    for most in (lm.BATCH_TOKENS, 300):
        lm_batches = lm.batches
        lm.batches = lambda d, most=most: lm_batches(d, most)
        try:
            got = {r.doc_id: r for r in lm.score(make_docs(docs).repartition(3)).collect()}
        finally:
            lm.batches = lm_batches
        for i, words_of in tokens.items():
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words_of), sum(one[w] > 0 for w in words_of), one.total())
            assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
            assert r.base_score == pytest.approx(sum(math.log10(unigram(w)) for w in words_of))
            assert r.score == pytest.approx(sum(math.log10(probability(*p)) for p in zip([b"\n", *words_of], words_of)), abs=0.02 * len(words_of))


def test_scores_do_not_depend_on_batches_or_files(make_docs, monkeypatch):
    texts = [" ".join(PROSE.split()[k % 7 : 9 + k % 11]) + f" w{k % 13}" for k in range(120)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts)]
    by_batches, whole = [], lm.batches
    for most, parts in ((lm.BATCH_TOKENS, 1), (150, 5), (40, 3)):
        monkeypatch.setattr(lm, "batches", lambda d, most=most: whole(d, most))
        by_batches.append({r.doc_id: r.score for r in lm.score(make_docs(docs).repartition(parts)).collect()})
    assert by_batches[0] == by_batches[1] == by_batches[2]
    assert all(by_batches[0][i] == by_batches[0][1000 + i] for i in range(len(texts)))


def test_pairs_of_a_batch_take_half_the_room():
    """Places of pairs and tokens are 32 bits wide, and no array of 64 bits a token outlives its use."""
    rng = np.random.default_rng(9)
    vocabulary = np.unique(rng.integers(0, 2**63, 2000, dtype=np.uint64))
    tokens, sizes = rng.integers(0, len(vocabulary), 100_000).astype(np.uint32), np.array([40_000, 60_000])
    tracemalloc.start()
    keys, context, token, pair_of = lm._pairs(vocabulary, tokens, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (keys[1:] > keys[:-1]).all() and {x.dtype.itemsize for x in (context, token, pair_of)} == {4}
    assert (token[pair_of] == tokens).all() and (context[pair_of][1:40_000] == tokens[:39_999]).all()
    assert peak <= 64 * len(tokens)


def test_a_batch_row_is_small(make_docs):
    """Common words make up most of a batch, so its row takes far less than four bytes a token, and comes back whole."""
    rng = np.random.default_rng(4)
    docs = [(k, " ".join(f"w{x}" for x in rng.zipf(1.4, 3000) % 30_000)) for k in range(40)]
    rows = lm.batches(make_docs(docs).coalesce(1)).collect()
    assert len(rows) == 1 and len(rows[0].tokens) < 2 * rows[0].n
    vocabulary, tokens, sizes = lm._read(rows[0].asDict())
    place = {int(h): k for k, h in enumerate(vocabulary)}
    hashes = [place[lm.xxhash.xxh64_intdigest(w, seed=lm.SEED)] for _, text in docs for w in [*text.encode().split(), lm.END]]
    assert tokens.dtype == np.uint32 and tokens.tolist() == hashes and sizes.sum() == len(tokens)
    for few in (np.zeros(0, np.uint32), np.array([2**32 - 1, 7], np.uint32)):
        assert (lm._unpacked(lm._packed(few)) == few).all()


def test_scores_odd_rows(odd_docs, no_docs):
    got = lm.score(odd_docs).collect()
    assert len(got) == 12 and all(r.score < 0 and r.n_tokens >= 1 for r in got)
    assert lm.score(no_docs).count() == 0
