"""Language-model scores of documents.

Documents are read once into batches of tokens. Every batch asks for the training counts of its own distinct tokens and token
pairs; the requests are dealt to shards by hash, so no token, however common, meets in one task more than once a
batch. A shard adds up the counts of all batches and answers each. From its answers a batch builds its slice of
the model, an Elias-Fano trie with quantised smoothed probabilities, and scores its documents on it. A slice is bounded
by the batch, whatever the corpus holds.

The model interpolates: P(w|v) = (1 - b(v)) c(vw) / c(v) + b(v) P(w), with P(w) = (c(w) + 1) / (N + V + 1). The weight of
the shorter history is b(v) = g + (1 - g) k / (c(v) + k), where g is the share of training pairs seen once (Good-Turing's
share of unseen ones). Each P(.|v) adds up to one before quantisation.
"""

from __future__ import annotations

import zlib
from array import array
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import ROWS_AT_ONCE, stage
from ludoshelf.llm.trie import Trie
from ludoshelf.sources.staging import Staging

FOLDS, HELD_OUT = 7, 2
BATCH_TOKENS = 1_250_000
SHARD_TOKENS = 1_500_000  # tokens of the corpus for each shard of requests
PAIRS_AT_ONCE = 1 << 17
SEED = 42
END = b"\n"  # no word holds a line feed
K = 5.0

BATCHES = "batch long, doc_ids array<long>, held array<boolean>, sizes array<int>, n long, vocabulary binary, counts binary, tokens binary"
REQUESTS = "shard int, batch long, keys1 binary, counts1 binary, keys2 binary, counts2 binary"
ANSWERS = "batch long, shard int, counts1 binary, counts2 binary, tokens long, types long, once long"


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; one without an id is not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def _compact(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{max(1, len(raw) // max(n, 1))}").astype(np.int64)


def _packed(tokens: np.ndarray) -> bytes:
    """32-bit ids, compressed byte by byte of their width: a batch is a row, and large rows are copied whole many times on their way."""
    return zlib.compress(tokens.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def batches(docs: DataFrame, most: int = BATCH_TOKENS) -> DataFrame:
    """Token batches: ids into the batch's vocabulary, which is its words' hashes in order, with their training counts."""

    def run(incoming):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids, tokens, doc_ids, sizes = _Ids(), array("I"), [], []

        def close():
            nonlocal ids, tokens, doc_ids, sizes, made
            hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), ids), np.uint64, len(ids))
            vocabulary, place = np.unique(hashes, return_inverse=True)
            local = place.astype(np.uint32)[np.frombuffer(tokens, np.uint32)]
            held = [held_out(d) for d in doc_ids]
            train = ~np.repeat(np.array(held, bool), sizes)
            counts = np.bincount(local[train], minlength=len(vocabulary))
            row = [(part << 32) + made, doc_ids, held, sizes, len(local), vocabulary.tobytes(), _compact(counts), _packed(local)]
            made += 1
            ids, tokens, doc_ids, sizes = _Ids(), array("I"), [], []
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            names = [x.split(" ")[0] for x in BATCHES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names=names)

        for batch in incoming:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(at, ROWS_AT_ONCE)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    words = (text or "").encode("utf-8", "replace").lower().split()
                    words.append(END)
                    tokens.extend(map(ids.__getitem__, words))
                    doc_ids.append(doc_id)
                    sizes.append(len(words))
                    if len(tokens) >= most:
                        yield close()
        if doc_ids:
            yield close()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, BATCHES)


def _pairs(vocabulary: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a batch in the order of their 64-bit keys: keys, contexts, tokens, and each token's pair.

    A document's first token stands behind the end mark.
    """
    end = np.searchsorted(vocabulary, np.uint64(xxhash.xxh64_intdigest(END, seed=SEED)))
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = end
    before *= len(vocabulary)
    before += tokens
    code, inverse = np.unique(before, return_inverse=True)
    del before
    inverse = inverse.astype(np.int32)  # a batch has fewer than 2^31 tokens
    context, token = (code // len(vocabulary)).astype(np.int32), (code % len(vocabulary)).astype(np.int32)
    del code
    keys = vocabulary[context] * np.uint64(0x9E3779B97F4A7C15)
    keys ^= (keys >> np.uint64(31)) ^ vocabulary[token]
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(27)
    keys *= np.uint64(0x94D049BB133111EB)
    order = np.argsort(keys, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return keys[order], context[order], token[order], place[inverse]


def _read(batch: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(batch["vocabulary"], np.uint64), _unpacked(batch["tokens"]), np.array(batch["sizes"], np.int64)


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards begin in sorted keys: shards are equal ranges of 64-bit keys."""
    edges = np.array([(s << 64) // shards for s in range(shards)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def requests(batched: DataFrame, shards: int) -> DataFrame:
    """What each batch asks of each shard: sorted keys with the batch's training counts, for tokens and pairs."""
    names = [x.split(" ")[0] for x in REQUESTS.split(", ")]

    def run(incoming):
        for arrow in incoming:
            for i in range(arrow.num_rows):
                batch = arrow.slice(i, 1).to_pylist()[0]
                vocabulary, tokens, sizes = _read(batch)
                keys, _, _, pair_of = _pairs(vocabulary, tokens, sizes)
                train = ~np.repeat(np.array(batch["held"], bool), sizes)
                counts = np.bincount(pair_of[train], minlength=len(keys))
                own = _counts(batch["counts"], len(vocabulary))
                one, two = _cuts(vocabulary, shards), _cuts(keys, shards)
                asked = np.flatnonzero((np.diff(one) > 0) | (np.diff(two) > 0))  # never more shards than the batch has keys
                kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                for s in asked.tolist():
                    a, b, c, d = one[s], one[s + 1], two[s], two[s + 1]
                    row = [s, batch["batch"], vocabulary[a:b].tobytes(), _compact(own[a:b]), keys[c:d].tobytes(), _compact(counts[c:d])]
                    yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names=names)

    return batched.select("batch", "held", "sizes", "vocabulary", "counts", "tokens").mapInArrow(run, REQUESTS)


def _sum(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Total counts of the distinct keys of all batches, and each batch's answer."""
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
    return total, np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1])


def answers(asked: DataFrame) -> DataFrame:
    """Each shard's counts over all batches, sent back to the batches that asked, with the shard's totals in its first row."""
    names = [x.split(" ")[0] for x in ANSWERS.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        got, totals = [], []
        for level in "12":
            keys = [np.frombuffer(k, np.uint64) for k in rows["keys" + level]]
            total, back = _sum(keys, [_counts(c, len(k)) for c, k in zip(rows["counts" + level], keys, strict=True)])
            totals.append(total)
            got.append([_compact(x) for x in back])
        n = len(rows["batch"])
        first = [int(totals[0].sum()), int((totals[0] > 0).sum()), int((totals[1] == 1).sum())]
        columns = [rows["batch"], rows["shard"], *got, *[[x] + [0] * (n - 1) for x in first]]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    return asked.groupBy("shard").applyInArrow(run, ANSWERS)


def model_slice(size: int, counts: np.ndarray, context: np.ndarray, token: np.ndarray, pairs: np.ndarray, n: int, types: int, once: int) -> tuple[Trie, Trie]:
    """The trie of a batch with log10 probabilities, and one of a single level with the log10 weights of the shorter history.

    The codebooks follow from the model's totals alone: no probability is below 1 / (N + V + 1), nor a weight below that of a history seen N times.
    """
    single = np.log10((counts + 1) / (n + types + 1))
    share = min(once / n, 1.0) if n else 1.0
    weight = share + (1 - share) * K / (counts + K)
    seen = np.flatnonzero(pairs > 0)
    seen = seen[np.lexsort((token[seen], context[seen]))]
    v, w = context[seen], token[seen]
    value = np.log10((1 - weight[v]) * pairs[seen] / np.maximum(counts[v], 1) + weight[v] * 10.0 ** single[w])
    books = [np.linspace(np.log10(least), 0.0, 256) for least in (1 / (n + types + 1), share + (1 - share) * K / (n + K))]
    return Trie(size, [(v, w, value)], single, books[0]), Trie(size, [], np.log10(weight), books[1])


def score(docs: DataFrame, staged: Staging | None = None) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score and score.

    Documents with crc32(doc_id) mod 7 = 2 are kept from training. A null or empty text is the end mark alone. A null doc_id trains.
    Repeated rows count as often as they stand; other columns are ignored; texts are read whole. Words and pairs are known by
    64-bit hashes.
    """
    staged = staged or stage(docs.sparkSession)
    batched = staged(batches(docs), "lm_batches")
    tokens = batched.agg(F.sum("n")).first()[0] or 0
    asked = requests(batched, -(-tokens // SHARD_TOKENS) or 1)
    answered = staged(answers(asked), "lm_answers")
    n, types, once = (x or 0 for x in answered.agg(F.sum("tokens"), F.sum("types"), F.sum("once")).first())

    def run(mine: pa.Table, back: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for batch in mine.to_pylist():
            shard_of = back.column("shard").to_numpy()
            by_shard = np.argsort(shard_of)
            vocabulary, local, sizes = _read(batch)
            keys, context, token, pair_of = _pairs(vocabulary, local, sizes)
            parts = [[], []]
            shards = -(-tokens // SHARD_TOKENS) or 1
            for level, of in ((0, vocabulary), (1, keys)):
                cuts = _cuts(of, shards)
                parts[level] = np.zeros(len(of), np.int64)
                answer = back.column(f"counts{level + 1}")
                for row in by_shard:  # one answer at a time
                    start, end = (int(cuts[shard_of[row] + k]) for k in (0, 1))
                    parts[level][start:end] = _counts(answer[int(row)].as_py(), end - start)
            counts, pairs = parts
            del keys, parts
            trie, shorter = model_slice(len(vocabulary), counts, context, token, pairs, n, types, once)
            value = np.empty(len(pairs))
            for at in range(0, len(pairs), PAIRS_AT_ONCE):
                v, w = context[at : at + PAIRS_AT_ONCE], token[at : at + PAIRS_AT_ONCE]
                node = trie.child(0, v, w)
                alone = trie.values[0].get(w) + np.where(counts[v] > 0, shorter.values[0].get(v), 0.0)
                value[at : at + PAIRS_AT_ONCE] = np.where(node >= 0, trie.values[1].get(np.maximum(node, 0)), alone) if len(trie.values[1].codes) else alone
            del trie, shorter, pairs, context, token
            starts = np.cumsum(sizes) - sizes
            base = np.log10((counts + 1) / (n + types + 1))
            columns = [batch["doc_ids"], batch["held"], sizes, *(np.add.reduceat(of[at], starts) for of, at in (((counts > 0).astype(np.int64), local), (base, local), (value, pair_of)))]
            for to, values in zip(out, columns, strict=True):
                to.extend(values)
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
        return pa.table([pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)], names=names)

    needed = batched.select("batch", "doc_ids", "held", "sizes", "vocabulary", "tokens")
    scored = needed.groupBy("batch").cogroup(answered.select("batch", "shard", "counts1", "counts2").groupBy("batch")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
