import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ludoshelf.llm import alignment as al

ODD = ["", " ", "  two  spaces ", "naïve café", "▁ marked", "<0x41> <|endoftext|> </s>", "日本語 and 😀😀 emoji", "\x00\x01  ", "a\n\n\tb", "x" * 300, " " * 1200 + "end", "ﬁ ² ﻿", "don't I'LL"]


@pytest.fixture(scope="module")
def pair():
    return al.Pair(al.BYTE_PATH, al.PIECE_PATH)


def by_hand(texts):
    """Rows of the query by comparing all byte ranges, with the libraries and files as they are described."""
    import json

    import sentencepiece
    import tokenizers

    exact = tokenizers.Tokenizer.from_file(al.BYTE_PATH)
    exact.encode_special_tokens = True
    letters = al.byte_letters()
    entries = {v: bytes(letters[c] for c in k) for k, v in json.load(open(al.BYTE_PATH))["model"]["vocab"].items() if k != "<|endoftext|>"}
    sp = sentencepiece.SentencePieceProcessor(model_file=al.PIECE_PATH)

    def bytes_of(k):
        piece = sp.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(k) else piece.replace("▁", " ").encode()

    rows, held, links_of = [], Counter(), []
    for text in texts:
        a, b = [], []
        if text:
            a, b = exact.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            if b"".join(entries[k] for k in a) != (" " + text).encode() or b"".join(map(bytes_of, b)) != (" " + text).encode():
                a, b = [], []
        ends_a, ends_b = np.cumsum([len(entries[k]) for k in a]), np.cumsum([len(bytes_of(k)) for k in b])
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = defaultdict(lambda: ([], []))
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for k, end in zip(ids, ends, strict=True):
                groups[bisect.bisect_left(common, end)][side].append(k)
        links = [(x, y) for g in groups.values() for x in g[0] for y in g[1]]
        held.update(set(links))
        written = ";".join(",".join(map(str, groups[g][0])) + "|" + ",".join(map(str, groups[g][1])) for g in sorted(groups))
        rows.append([len(a), len(b), len(groups), len(links), hashlib.sha256(written.encode()).hexdigest() if a else ""])
        links_of.append(links)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(*r[:4], sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), r[4]) for r, links in zip(rows, links_of, strict=True)]


def mixed_texts(n, seed):
    rnd = random.Random(seed)
    words = ["the", "Überraschung", "déjà", "tokenization", "1234567", "foo_bar", "naïve", "\n", "\t\t", "...", "日本", "don't", "x=1;", "antidisestablishmentarianism", "😀"]
    return ["".join(rnd.choice(words) + rnd.choice(["", " ", "  ", "-"]) for _ in range(rnd.randrange(1, 60))) for _ in range(n)] + ODD + [None]


@pytest.mark.parametrize("sent", [0, 3, al.SENT])
def test_equals_comparing_all_ranges(make_docs, sent):
    texts = mixed_texts(40, 2)
    got = {r.doc_id: tuple(r)[1:] for r in al.align_tokenizers(make_docs(list(enumerate(texts))), sent=sent).collect()}
    assert [got[k] for k in range(len(texts))] == by_hand(texts)


def test_gallop_is_the_first_place_not_below():
    rnd = random.Random(1)
    for n in (0, 1, 2, 50, 999):
        long = np.array(sorted(rnd.sample(range(3000), n)), np.int64)
        short = np.array(sorted(rnd.sample(range(-5, 3010), min(n, 40))), np.int64)
        for start in (np.zeros(len(short), np.int64), np.arange(len(short)), np.array([rnd.randrange(-9, 4000) for _ in short], np.int64)):
            if n:
                assert al.gallop(short, long, start).tolist() == np.searchsorted(long, short).tolist()


def test_common_ends_of_several_lists():
    rnd = random.Random(4)
    sizes = [(3, 40), (40, 3), (0, 0), (1, 1), (17, 17)]
    lists, base = [], 0
    for x, y in sizes:
        end = base + 100
        lists.append([sorted({*rnd.sample(range(base + 1, end), max(n - 1, 0)), *([end] if n else [])}) for n in (x, y)])
        base = end
    a, b = ([v for pair in lists for v in pair[side]] for side in (0, 1))
    a_of, b_of = (np.cumsum([0] + [len(pair[side]) for pair in lists]) for side in (0, 1))
    at_a, at_b = al.common_ends(np.array(a), np.array(b), a_of, b_of)
    want = sorted(set(a) & set(b))
    assert [a[k] for k in at_a] == want and [b[k] for k in at_b] == want


def test_crowded_groups_are_counted_first(monkeypatch):
    rnd = random.Random(6)
    ids_a, ids_b = (np.array([rnd.randrange(9) for _ in range(n)], np.int64) for n in (90, 70))
    first_a, first_b = np.array([0, 1, 50]), np.array([0, 30, 31])
    sizes = np.diff([0, 1, 50, 90]), np.diff([0, 30, 31, 70])
    want = Counter()
    for g, text in enumerate((0, 0, 1)):
        for x in ids_a[first_a[g] : first_a[g] + sizes[0][g]]:
            want.update((text, int(x) << al.SHIFT | int(y)) for y in ids_b[first_b[g] : first_b[g] + sizes[1][g]])
    for dense in (0, 40, 10**9):
        monkeypatch.setattr(al, "DENSE", dense)
        of, key, n = al.linked_pairs(ids_a, ids_b, first_a, sizes[0], first_b, sizes[1], np.array([0, 0, 1]))
        assert {(int(o), int(k)): int(c) for o, k, c in zip(of, key, n, strict=True)} == want


def test_both_libraries_agree_on_the_fast_texts(pair):
    rnd = random.Random(8)
    alphabet = [chr(c) for c in range(0x250)]
    texts = ["".join(rnd.choices(alphabet, k=300)) for _ in range(60)] + ["".join(rnd.choice(alphabet) * rnd.randrange(1, 9) for _ in range(60)) for _ in range(60)]
    texts += ["".join(rnd.choices("  \n\t\r\x0b\x85\xa0\x1c'stlrevdm019.,azÀ", k=200)) for _ in range(100)]
    assert not any(al.SLOW.search(t) for t in texts)
    assert [pair.fast.encode_ordinary(t) for t in texts] == [pair.exact.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_runs(make_docs):
    got = al.align_tokenizers(make_docs([(1, " " * 300_000), (2, "a" * 300_000), (3, "ab1" * 100_000)])).collect()
    assert all(r.n_groups > 0 and r.n_links > 0 for r in got)


def test_odd_rows(odd_docs, no_docs):
    got = al.align_tokenizers(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id in (2, 3):
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "")
        if r.doc_id == 1:
            assert r.n_best == r.n_links > 0
    assert al.align_tokenizers(no_docs).count() == 0
