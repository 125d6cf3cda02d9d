"""Alignment of two tokenizers by the byte offsets at which tokens of both end.

The shorter list of ends drives a galloping search in the longer one: from where its rank would put it, a value's place is bracketed by steps that double
and then found by halving. The ends found in both cut a text into groups of tokens; differences of ranks are the numbers of tokens in a group, so
links are counted and enumerated without a comparison of ranges. The lists of many texts are laid end to end and searched at once.

Corpus-wide counts of linked id pairs are an aggregation of each text's distinct pairs. They go back to the texts in two ways: the most
frequent pairs, a bounded number, are sent to the tasks, so what stands in most texts is never shuffled; all others are joined by the pair.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import stage
from ludoshelf.sources.staging import Staging

BYTE_PATH = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: The pattern that cuts a text before byte-level merges, and the printable bytes that stand for themselves in the vocabulary file.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = ((33, 126), (161, 172), (174, 255))
#: Texts with these go through the file's own library: characters whose class may depend on a Unicode version, and runs that exhaust the faster one's matcher.
SLOW = re.compile("[^\x00-ɏ]|\\s{1000}")
BATCH_BYTES = 1 << 20
DENSE = 256  # links of a group from which its ids are counted before they are paired
SHIFT = 20  # bits of an id
SENT = 200_000  # pair counts that are sent to every task (17 bytes each)


def byte_table(path: str) -> dict[str, int]:
    """Ids of a byte-level vocabulary file by their entries as written there, special tokens left out."""
    described = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {token["content"] for token in described.get("added_tokens", ())}
    return {entry: number for entry, number in described["model"]["vocab"].items() if entry not in special}


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte: printable ones themselves, the others in order from 256 on."""
    plain = [b for first, last in PRINTABLE for b in range(first, last + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Both tokenizers of a task: ids of a text and the bytes of every id."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece
        import tiktoken
        import tokenizers

        letters, entries = byte_letters(), byte_table(byte_path)
        ranks = {bytes(letters[c] for c in entry): number for entry, number in entries.items()}
        self.exact = tokenizers.Tokenizer.from_file(byte_path)
        self.exact.encode_special_tokens = True
        self.fast = tiktoken.Encoding("bytes", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.a_bytes[number] = token
        self.b_bytes = [self._piece(k) for k in range(self.pieces.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) >> SHIFT:
            raise ValueError(f"ids of more than {SHIFT} bits")
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    def _piece(self, k: int) -> bytes:
        piece = self.pieces.id_to_piece(k)
        if self.pieces.is_byte(k):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self.pieces.is_control(k) or self.pieces.is_unknown(k) else piece.replace(MARK, " ").encode("utf-8")

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids by the byte vocabulary of a space and the text, and by the pieces; none if either does not spell these bytes."""
        if not text:
            return [], []
        spaced = " " + text
        data = spaced.encode("utf-8")
        a = self.exact.encode(spaced, add_special_tokens=False).ids if SLOW.search(text) else self.fast.encode_ordinary(spaced)
        if b"".join([self.a_bytes[k] for k in a]) != data:
            return [], []
        b = self.pieces.encode(text)
        if b"".join([self.b_bytes[k] for k in b]) != data:
            return [], []
        return a, b


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in the ascending ``long`` that is not below it, searched from ``start``.

    Steps double until the value is bracketed, then the bracket is halved; all values take a step at a time.
    """
    n = len(long)
    if n == 0 or len(short) == 0:
        return np.zeros(len(short), np.int64)
    at = np.clip(start, 0, n - 1)
    up = long[at] < short
    low, high = np.where(up, at, -1), np.where(up, n, at)  # long[low] < value <= long[high], where these exist
    step, left = 1, np.arange(len(short))
    while len(left):
        right = up[left]
        probe = np.where(right, at[left] + step, at[left] - step)
        inside = (probe >= 0) & (probe < n)
        below = long[np.clip(probe, 0, n - 1)] < short[left]
        low[left[inside & below]] = probe[inside & below]
        high[left[inside & ~below]] = probe[inside & ~below]
        left = left[inside & (below == right)]
        step *= 2
    left = np.flatnonzero(high - low > 1)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        below = long[middle] < short[left]
        low[left[below]] = middle[below]
        high[left[~below]] = middle[~below]
        left = left[high[left] - low[left] > 1]
    return high


def common_ends(a: np.ndarray, b: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both hold. Each is several ascending lists end to end; ``a_of`` and ``b_of`` are their
    bounds (one more than lists). The same list must hold larger values than those before it, and the shorter of two lists is searched in the longer.
    """
    in_a, in_b = [], []
    a_shorter = np.diff(a_of) <= np.diff(b_of)
    for short, long, s_of, l_of, chosen, in_s, in_l in ((a, b, a_of, b_of, a_shorter, in_a, in_b), (b, a, b_of, a_of, ~a_shorter, in_b, in_a)):
        sizes = np.diff(s_of)
        list_of = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.arange(len(short)) - s_of[list_of]
        driving = np.flatnonzero(chosen[list_of])
        lists = list_of[driving]
        start = l_of[lists] + rank[driving] * np.diff(l_of)[lists] // np.maximum(sizes[lists], 1)
        found = gallop(short[driving], long, start)
        hit = found < len(long)
        hit[hit] = long[found[hit]] == short[driving][hit]
        in_s.append(driving[hit])
        in_l.append(found[hit])
    at_a, at_b = np.concatenate(in_a), np.concatenate(in_b)
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, first_a: np.ndarray, n_a: np.ndarray, first_b: np.ndarray, n_b: np.ndarray, text: np.ndarray):
    """Text, pair of ids and times linked, by text and pair; the groups are given by their first tokens and sizes. Crowded groups are counted by id first."""
    many = n_a * n_b
    dense = many > DENSE
    fa, fb, nb, of = first_a[~dense], first_b[~dense], n_b[~dense], text[~dense]
    size = many[~dense]
    group = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    keys = [of[group] << (2 * SHIFT) | ids_a[fa[group] + inner // nb[group]] << SHIFT | ids_b[fb[group] + inner % nb[group]]]
    times = [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(dense):
        left, left_n = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        right, right_n = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        keys.append((text[g] << (2 * SHIFT) | left[:, None] << SHIFT | right[None, :]).ravel())
        times.append((left_n[:, None] * right_n[None, :]).ravel())
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    return key >> (2 * SHIFT), key & ((1 << (2 * SHIFT)) - 1), np.add.reduceat(n, first) if len(first) else n


class Spelled:
    """Decimal ids with what follows them in the text of a grouping."""

    def __init__(self, a: int, b: int) -> None:
        self.a, self.a_last = (np.array([f"{k}{c}" for k in range(a)], object) for c in ",|")
        self.b, self.b_last = (np.array([f"{k}{c}" for k in range(b)], object) for c in ",;")


def align(encoded: list[tuple[list[int], list[int]]], pair: Pair, spelled: Spelled) -> tuple:
    """Per text: n_a, n_b, n_groups, n_links, the digest of the grouping, and the offsets, pairs and times of its linked pairs."""
    texts = len(encoded)
    a_of, b_of = (np.concatenate([[0], np.cumsum([len(e[side]) for e in encoded])]).astype(np.int64) for side in (0, 1))
    ids_a, ids_b = (np.fromiter((k for e in encoded for k in e[side]), np.int64, of[-1]) for side, of in ((0, a_of), (1, b_of)))
    # Both sides of a text have the same bytes, so ends may run on over all texts.
    at_a, at_b = common_ends(np.cumsum(pair.a_sizes[ids_a]), np.cumsum(pair.b_sizes[ids_b]), a_of, b_of)
    first_a, first_b = (np.concatenate([[0], at[:-1] + 1])[: len(at)] for at in (at_a, at_b))
    n_a, n_b = at_a + 1 - first_a, at_b + 1 - first_b
    text = np.searchsorted(a_of, at_a, side="right") - 1
    bounds = np.searchsorted(text, np.arange(texts + 1))
    links = np.concatenate([[0], np.cumsum(n_a * n_b)])

    pieces = np.empty(len(ids_a) + len(ids_b), object)
    place_a = np.arange(len(ids_a)) + np.repeat(first_b, n_a)
    place_b = np.arange(len(ids_b)) + np.repeat(at_a + 1, n_b)
    pieces[place_a], pieces[place_b] = spelled.a[ids_a], spelled.b[ids_b]
    pieces[place_a[at_a]], pieces[place_b[at_b]] = spelled.a_last[ids_a[at_a]], spelled.b_last[ids_b[at_b]]
    ends = a_of + b_of
    digests = ["" if s == e else hashlib.sha256("".join(pieces[s:e])[:-1].encode()).hexdigest() for s, e in zip(ends[:-1], ends[1:], strict=True)]

    of, pairs, times = linked_pairs(ids_a, ids_b, first_a, n_a, first_b, n_b, text)
    offsets = np.searchsorted(of, np.arange(texts + 1))
    return np.diff(a_of), np.diff(b_of), np.diff(bounds), np.diff(links[bounds]), digests, offsets, pairs, times


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about a fixed number of characters, one text at least."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if k > start and size + len(text or "") > BATCH_BYTES:
            yield start, k
            start, size = k, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def groupings(docs: DataFrame, byte_path: str = BYTE_PATH, piece_path: str = PIECE_PATH) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the distinct linked pairs (a << 20 | b) with their times, per row of ``docs`` (doc_id, text)."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches):
        pair = Pair(byte_path, piece_path)
        spelled = Spelled(len(pair.a_bytes), len(pair.b_bytes))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _batches(texts):
                encoded = [pair.encode(text) for text in texts[start:end]]
                *numbers, digests, offsets, pairs, times = align(encoded, pair, spelled)
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64())) for values in (pairs, times)]
                columns = [batch.column(0).slice(start, end - start), *[pa.array(n, pa.int64()) for n in numbers], pa.array(digests, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return narrow.mapInArrow(run, kinds)


def pair_counts(aligned: DataFrame, staged: Staging) -> DataFrame:
    """``pair``, ``n`` (texts that hold it linked) and ``best`` (no pair of the same left id has a higher n)."""
    counts = staged(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "alignment_counts")
    left = counts.withColumn("a", F.expr(f"shiftright(pair, {SHIFT})"))
    most = left.groupBy("a").agg(F.max("n").alias("most"))  # at most a row for each id of the vocabulary
    return staged(left.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment_best")


def align_tokenizers(docs: DataFrame, byte_path: str = BYTE_PATH, piece_path: str = PIECE_PATH, sent: int = SENT, staged: Staging | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row of ``docs`` (doc_id, text).

    A is the byte-level vocabulary over a space and the text, B the pieces over the text (which adds the space itself). A link is a pair of token
    occurrences of one group. The count of a pair of ids is the number of rows that hold it linked; n_best are the links whose count is the highest
    of their A id, count_sum is the sum of counts over links. Rows whose text is null or empty, or whose tokens do not spell the
    space and the text, have zeros and the digest ''. Each row counts, repeated ones and those with equal or null doc_id too; other columns are ignored.
    ``sent`` pairs of the highest counts are sent to the tasks; it changes no result.
    """
    staged = staged or stage(docs.sparkSession)
    aligned = staged(groupings(docs, byte_path, piece_path).withColumn("row", F.monotonically_increasing_id()), "alignment_rows")
    stats = pair_counts(aligned, staged)
    frequent = staged(stats.orderBy(F.desc("n"), "pair").limit(sent), "alignment_frequent")
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    near = links.join(F.broadcast(frequent), "pair")
    far = links.join(F.broadcast(frequent.select("pair")), "pair", "left_anti").hint("merge").join(stats, "pair")
    parts = [part.select("row", F.expr("if(best, times, 0L)").alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")) for part in (near, far)]
    sums = parts[0].union(parts[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (
        aligned.drop("pairs", "times")
        .join(sums.hint("merge"), "row", "left")
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
    )
