"""Spelling variants: words one inserted, deleted or replaced character apart, found by a trie of letter-group counts.

Every character belongs to a group; a word's vector holds how many of its characters each group has. The trie's levels are the groups in turn, its branches
their counts, its leaves the words of one vector. One edit adds at most one to one count (surplus) and takes at most one from another
(deficit), so a depth-first search with a budget of one each reaches the leaves of all near words; what it reaches is
verified. Of two near words with different vectors only the one that has more at the first level where they differ looks for the other, so a
search spends its deficit before its surplus. Inside a leaf only words that share a half with the sought one are looked at.

The trie is never in one place: the first levels are a key by which words are dealt, and a word visits the keys that its budget reaches. How many levels
make the key follows from the number of words, so that the tasks hold a bounded number; a key with more words all the same is cut into
blocks, and its visitors go to all of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import ROWS_AT_ONCE, stage
from ludoshelf.sources.staging import Staging

RUN = re.compile("[a-zÀ-ÿ]+")  # on texts whose A-Z are in lower case
EVERY = 31
SHORTEST = 7
LEAST = 2
TIMES = 10
GROUPS = 12
KEPT_WORDS = 200_000  # different words that a task adds up before it hands them on
BRANCH = 50_000  # words of a key that are searched together, and visitors that are held against them
SENT = 200_000  # keys with their numbers of blocks that are sent to every task; more are joined by a shuffle


def misspelled(doc_id: int | None, text: str | None) -> Iterator[tuple[str, int]]:
    """The words of a text, as they count: (word, occurrences). Some lose a character by a rule of their checksum; a null doc_id is written as nothing."""
    lowered = (text or "").encode("utf-8", "replace").lower().decode("utf-8")
    prefix = b"%d:" % doc_id if doc_id is not None else b":"
    for word, n in Counter(RUN.findall(lowered)).items():
        if len(word) >= SHORTEST:
            h = zlib.crc32(prefix + word.encode("utf-8"))
            if h % EVERY == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
                if len(word) < SHORTEST:
                    continue
            yield word, n


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, the occurrences in all texts of ``docs`` (doc_id, text). Tasks add up what they meet before it is shuffled."""

    def run(batches):
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in misspelled(doc_id, text):
                    counts[word] += n
                if len(counts) > KEPT_WORDS:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())})

    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {LEAST}")


def vector(word: str) -> tuple[int, ...]:
    """How many characters of a word are in each group. A character's group goes by its number, so neighbours in the alphabet are apart."""
    counts = [0] * GROUPS
    for c in word:
        counts[ord(c) % GROUPS] += 1
    return tuple(counts)


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


#: What a search has spent on its way: nothing, the deficit, or both.
SAME, SHORTER, CHANGED = range(3)


def within_budget(counts: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
    """The prefixes of vectors that a search for ``counts`` may pass, with what it has spent there."""
    yield counts, SAME
    for i, c in enumerate(counts):
        if c:
            less = (*counts[:i], c - 1, *counts[i + 1 :])
            yield less, SHORTER
            for j in range(i + 1, len(counts)):
                yield (*less[:j], less[j] + 1, *less[j + 1 :]), CHANGED


class Leaf:
    """Words of one vector, by their halves: an edit leaves the first half or the last half of the shorter word as it is."""

    def __init__(self) -> None:
        self.halves: dict[tuple[int, bool, str], list[tuple[str, int]]] = {}

    def add(self, word: str, n: int) -> None:
        # A word is sought by words of its own length and of one more or less, whose shorter half is another cut.
        for size in {len(word) // 2, (len(word) - 1) // 2}:
            self.halves.setdefault((len(word), True, word[:size]), []).append((word, n))
            self.halves.setdefault((len(word), False, word[len(word) - size :]), []).append((word, n))

    def near(self, word: str, spent: int) -> list[tuple[str, int]]:
        """Words of this leaf near to ``word``; of two with the same vector only the greater is found."""
        other = len(word) - (spent == SHORTER)
        size = other // 2
        first = self.halves.get((other, True, word[:size]), ())
        last = self.halves.get((other, False, word[len(word) - size :]), ())
        return [(x, n) for x, n in {*first, *last} if (spent != SAME or x > word) and one_apart(word, x)]


class Trie:
    """Words by the counts of the letter groups from level ``depth`` on."""

    def __init__(self, depth: int, words: Iterator[tuple[str, int]]) -> None:
        self.depth, self.root = depth, {}
        for word, n in words:
            counts = vector(word)[depth:]
            node = self.root
            for c in counts[:-1]:
                node = node.setdefault(c, {})
            if counts:
                node = node.setdefault(counts[-1], Leaf())
            elif not node:
                node = self.root = Leaf()
            node.add(word, n)

    def leaves(self, counts: tuple[int, ...], spent: int) -> list[tuple[Leaf, int]]:
        """The leaves that a search reaches from the root, where it has spent ``spent``, and what it has spent there."""
        if isinstance(self.root, Leaf):
            return [(self.root, spent)]
        if not self.root:
            return []
        out, last = [], len(counts) - 1
        stack = [(self.root, 0, spent)]
        while stack:
            node, level, state = stack.pop()
            c = counts[level]
            steps = [(c, state)]
            if state == SAME:
                steps.append((c - 1, SHORTER))
            elif state == SHORTER:
                steps.append((c + 1, CHANGED))
            for count, after in steps:
                child = node.get(count)
                if child is not None:
                    if level == last:
                        out.append((child, after))
                    else:
                        stack.append((child, level + 1, after))
        return out


def key_depth(words: DataFrame, branch: int) -> int:
    """The least number of levels at which no prefix of a vector has more than ``branch`` words; all levels if there is none.

    One number a level comes to the driver.
    """

    def run(batches):
        for batch in batches:
            seen = Counter(vector(word) for word in batch.column(0).to_pylist())
            yield pa.RecordBatch.from_pydict({"counts": [list(v) for v in seen], "n": list(seen.values())}, schema=pa.schema([("counts", pa.list_(pa.int32())), ("n", pa.int64())]))

    vectors = words.select("word").mapInArrow(run, "counts array<int>, n long").groupBy("counts").agg(F.sum("n").alias("n"))
    prefixes = vectors.select("n", F.explode(F.expr(f"transform(sequence(0, {GROUPS}), d -> struct(d as depth, slice(counts, 1, d) as prefix))")).alias("p"))
    most = prefixes.groupBy("p.depth", "p.prefix").agg(F.sum("n").alias("n")).groupBy("depth").agg(F.max("n").alias("n")).collect()
    return min((row.depth for row in most if row.n <= branch), default=GROUPS)


def near_pairs(words: DataFrame, staged: Staging, branch: int = BRANCH) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for all ordered pairs of near words of ``words`` (word, n; words distinct and not null)."""
    depth = key_depth(words, branch)

    def visits(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                prefixes, states, of = [], [], []
                for k, word in enumerate(part.column(0).to_pylist()):
                    for prefix, spent in within_budget(vector(word)[:depth]):
                        prefixes.append(",".join(map(str, prefix)))
                        states.append(spent)
                        of.append(k)
                columns = [pa.array(prefixes, pa.string()), *[c.take(pa.array(of, pa.int32())) for c in part.columns], pa.array(states, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "word", "n", "spent"])

    visiting = staged(words.select("word", "n").mapInArrow(visits, "prefix string, word string, n long, spent int"), "spelling_visits")
    own = F.col("spent") == SAME
    # Visits to keys without words end here. Keys with many words or visitors are cut on both sides; each word block meets each visitor block.
    calls = visiting.groupBy("prefix").agg(F.count_if(own).alias("words"), F.count("*").alias("visitors")).where("words > 0")
    blocks = calls.select("prefix", F.ceil(F.col("words") / branch).alias("rows"), F.ceil(F.col("visitors") / branch).alias("columns"))
    blocks = staged(blocks, "spelling_blocks")
    blocks = F.broadcast(blocks) if blocks.count() <= SENT else blocks.hint("merge")
    block = "cast(pmod(xxhash64(word), {}) as int)"
    here = visiting.where(own).join(blocks, "prefix").select(
        "prefix", F.expr(block.format("rows")).alias("row"), F.explode(F.expr("sequence(0, cast(columns as int) - 1)")).alias("column"), "word", "n"
    )
    there = visiting.join(blocks, "prefix").select(
        "prefix", F.explode(F.expr("sequence(0, cast(rows as int) - 1)")).alias("row"), F.expr(block.format("columns")).alias("column"), "word", "n", "spent"
    )
    # Both sides come from one table; other names keep them apart.
    there = there.toDF("to_prefix", "to_row", "to_column", "asked", "asked_n", "spent")

    def search(key, held, asked):
        def rows(table, *names):
            return zip(*(table.column(c).to_pylist() for c in names), strict=True)

        trie = Trie(depth, rows(held, "word", "n"))
        known, left, left_n, right, right_n = {}, [], [], [], []
        for word, n, spent in rows(asked, "asked", "asked_n", "spent"):
            budget = (vector(word)[depth:], spent)
            leaves = known.get(budget)
            if leaves is None:
                leaves = known[budget] = trie.leaves(*budget)
            for leaf, state in leaves:
                for near, near_n in leaf.near(word, state):
                    left.append(word)
                    left_n.append(n)
                    right.append(near)
                    right_n.append(near_n)
        kinds = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
        return pa.Table.from_pydict({"word": left + right, "near": right + left, "near_n": right_n + left_n}, schema=kinds)

    return here.groupBy("prefix", "row", "column").cogroup(there.groupBy("to_prefix", "to_row", "to_column")).applyInArrow(search, "word string, near string, near_n long")


def roots(forms: DataFrame, staged: Staging) -> DataFrame:
    """``word`` and ``root``, the end of the chain of forms from it, for every row of ``forms`` (word, form; not null).

    A form occurs at least ten times as often as its word, so chains are short; every round doubles the steps taken.
    """
    linked = staged(forms.select("word", F.col("form").alias("root")), "spelling_roots_0")
    step = 0
    while True:
        step += 1
        onward = linked.select(F.col("word").alias("root"), F.col("root").alias("_next")).hint("merge")
        moved = linked.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = staged(moved, f"spelling_roots_{step}")
        linked = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return linked


def variants(docs: DataFrame, branch: int = BRANCH, staged: Staging | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of the words of ``docs`` (doc_id, text).

    Words are runs of letters (A-Z in lower case, other letters as they are) of at least seven characters that occur at least twice in all texts; a run loses a
    character where its checksum says so. n_near counts the words one edit away. The form is the most frequent of them (ties: the least by code
    points) if it occurs at least ten times as often, else null, and form_n its occurrences; root is the last of the chain of forms, or
    the word itself.

    Null texts have no words. A null doc_id is written as nothing before the colon of the checksum. Repeated rows count each time; other columns are
    ignored. An empty table gives an empty one. ``branch`` bounds the words and visitors of one search; it changes no result.
    """
    staged = staged or stage(docs.sparkSession)
    words = staged(word_counts(docs), "spelling_words")
    pairs = near_pairs(words, staged, branch)
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    found = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    per_word = words.join(found.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")
    enough = F.expr(f"-best.minus_n >= {TIMES} * n")
    per_word = per_word.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus_n")).alias("form_n"))
    per_word = staged(per_word, "spelling_forms")
    ends = roots(per_word.where("form is not null"), staged)
    return per_word.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
