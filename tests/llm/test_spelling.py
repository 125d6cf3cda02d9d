import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from ludoshelf.llm import spelling as sp
from ludoshelf.llm.common import stage


def edits(a, b):
    """Edit distance by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def by_hand(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and edits(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    form = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: f if f and words[f] >= 10 * words[w] else None for w, f in form.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def spelled(rnd, alphabet, words):
    """A word with some random edits."""
    word = rnd.choice(words)
    for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
        k = rnd.randrange(len(word))
        word = rnd.choice([word[:k] + word[k + 1 :], word[:k] + rnd.choice(alphabet) + word[k:], word[:k] + rnd.choice(alphabet) + word[k + 1 :]])
    return word


def corpus(seed, alphabet="abcdeéÿ×", n_words=12, n_docs=60):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices(alphabet, k=rnd.randrange(6, 12))) for _ in range(n_words)]
    words += [words[0] + "a", words[0] + "ab", words[0] + "abc"]
    likely = [words[0]] * 40 + words
    return [(k, rnd.choice([" ", ", ", "1"]).join(spelled(rnd, alphabet, likely).capitalize() for _ in range(rnd.randrange(80)))) for k in range(n_docs)]


@pytest.mark.parametrize(("seed", "branch"), [(1, sp.BRANCH), (2, 30), (3, 5)])
def test_equals_comparing_all_words(make_docs, seed, branch):
    docs = [*corpus(seed), (None, "wordswithoutid wordswithoutid Wordswithoutid"), (7, None), (8, "")]
    got = sp.variants(make_docs(docs), branch).collect()
    want = by_hand(docs)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r.form for r in got) and any(r.n_near > 2 for r in got)


def test_anagrams_share_a_leaf_and_are_cut_into_blocks(spark):
    """All words have one vector, so no number of levels parts them."""
    rnd = random.Random(5)
    letters = list("aabcdefgh")
    words = sorted({"".join(rnd.sample(letters, len(letters))) for _ in range(300)})
    words += sorted({w[:k] + "m" + w[k + 1 :] for w in words[:40] for k in range(2)})  # a and m are in one group
    table = spark.createDataFrame([(w, k + 2) for k, w in enumerate(words)], "word string, n long")
    assert sp.key_depth(table, 50) == sp.GROUPS
    got = {(r.word, r.near): r.near_n for r in sp.near_pairs(table, stage(spark), 50).collect()}
    number = {w: k + 2 for k, w in enumerate(words)}
    assert got == {(a, b): number[b] for a in words for b in words if edits(a, b) == 1}


def test_chains_of_forms(make_docs):
    texts = ["abcdefgh " * 2000 + "abcdefg " * 200 + "abcdefgx " * 20 + "abcdefgxy " * 2, "lonelyword lonelyword"]
    got = {r.word: r for r in sp.variants(make_docs([(k, t) for k, t in enumerate(texts)])).collect()}
    assert got["abcdefgxy"].form == "abcdefgx" and got["abcdefgxy"].root == "abcdefgh"
    assert tuple(got["lonelyword"])[1:] == (None, "lonelyword", 2, 0, None)


def test_one_apart_and_budget():
    rnd = random.Random(9)
    for _ in range(3000):
        a, b = ("".join(rnd.choices("ab", k=rnd.randrange(8))) for _ in range(2))
        assert sp.one_apart(a, b) == (edits(a, b) == 1)
    counts = (2, 0, 1)
    reached = dict(sp.within_budget(counts))
    for other in [(x, y, z) for x in range(5) for y in range(4) for z in range(4)]:
        changes = [o - c for o, c in zip(other, counts, strict=True) if o != c]
        want = {(): sp.SAME, (-1,): sp.SHORTER, (-1, 1): sp.CHANGED}.get(tuple(changes))
        assert reached.get(other) == want


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert {tuple(r) for r in sp.variants(odd_docs).collect()} == by_hand(rows)
    assert sp.variants(no_docs).count() == 0
