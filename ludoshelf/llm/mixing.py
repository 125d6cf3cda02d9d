"""Mixing sources to target weights.

The words of a source, document after document, are packed into blocks of fixed length. Each output shard draws how
many of its slots every source gets (multinomial, seeded by the shard). The slots of a source are numbered through
all shards; slot ``k`` takes block ``permutation(k mod blocks)`` of pass ``k div blocks``, a seeded permutation of
the indices that needs no table. Blocks are joined by (source, index).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludoshelf.llm.common import running_total, sizes, stage
from ludoshelf.sources.staging import Staging

#: Rows of a chunk of a source, about; only the grouping of the running totals depends on it.
CHUNK_ROWS = 10_000
#: More sources than this raise an error: their targets are held by every task.
MAX_SOURCES = 100_000
SLOT_BATCH = 65_536


@dataclass
class Mix:
    """``documents``: a row per document. ``slots``: shard, source_no, block of every output slot.
    ``pieces``: which words of which document stand in a block (source_no, block, doc_id, at, words).
    ``sources``: source, source_no, source_size, target, blocks, slots."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame
    sources: DataFrame

    def contents(self) -> DataFrame:
        """The output: for every slot of a shard the pieces of its block, joined by index."""
        return self.slots.join(self.pieces, ["source_no", "block"])


def permuted(index: np.ndarray, size: int, *key: int) -> np.ndarray:
    """The images of ``index`` under a pseudorandom permutation of range(size): a Feistel network, walked
    until the image is inside the range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.Generator(np.random.Philox(np.random.SeedSequence(key))).integers(0, 2**63, 4, dtype=np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def source_targets(sized: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Per source: source_no (by code point, null last), source_size and target.

    Weights repeat in the order of sources. A target stops at ``cap`` times the source's size and the excess goes
    to the others by weight: a common level, at which min(weight * level, cap * size) adds up to all sizes.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    filled = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(cap))
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    fits = filled.withColumn("level", level)
    fits = fits.withColumn("level", F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level")))
    fits = fits.withColumn("level", F.coalesce(F.max("level").over(everything), F.lit(0.0)))
    return fits.select("source", F.col("source_no").cast("long"), "source_size", F.least(F.col("weight") * F.col("level"), "most").alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: float = 3,
    block_words: int = 64,
    shard_slots: int = 65_536,
    seed: int = 20,
    staged: Staging | None = None,
) -> Mix:
    """Mix ``docs`` (doc_id, source, text) to the weights.

    The slots of a source are round(target * blocks / size), so no block is drawn more than ``cap`` times (up to
    rounding up). Multinomial draws differ from that number; draws over a source's number pass, in their order, to
    sources that are short, so every shard keeps its length and every source comes near its target. A null or empty
    text has size 0 and is never taken; a null source is a source, the last one. Documents of one source are packed
    in the order of hashed doc_id; rows alike in doc_id and size may stand for each other. Other columns are ignored. Reruns agree.
    """
    spark = docs.sparkSession
    staged = staged or stage(spark)
    sized = staged(sizes(docs), "mix_sizes")
    sources = staged(source_targets(sized, weights, cap), "mix_targets")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    drawn = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumns({"blocks": blocks, "slots": drawn})
    known = sources.orderBy("source_no").limit(MAX_SOURCES + 1).select("blocks", "slots").collect()
    if len(known) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    n_blocks, quota = (np.array([r[i] for r in known], np.int64) for i in (0, 1))
    slots = _slots(spark, n_blocks, quota, shard_slots, seed, staged)

    n_rows = sized.count()
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(n_rows // CHUNK_ROWS + 1))
    numbered = sized.withColumn("chunk", chunk).join(sources.select("source", "source_no", "source_size", "target"), sized.source.eqNullSafe(sources.source)).drop("source")
    placed = running_total(numbered.where("size > 0"), ["source_no"], "chunk", [F.xxhash64("doc_id"), F.col("doc_id"), F.col("size")], "size", "at")
    first, last = F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")
    pieces = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest("at", F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.withColumn("words", end - begin)
    # The planner has no true size of the slots, so it must not choose to broadcast them.
    times = slots.groupBy("source_no", "block").agg(F.count("*").alias("times")).hint("merge")
    taken = (
        pieces.join(times, ["source_no", "block"], "left")
        .groupBy("source_no", "at", "doc_id", "size", "source_size", "target")
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    )
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    empty = numbered.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    documents = taken.select(*columns).unionByName(empty.select(*columns))
    out = pieces.select("source_no", "block", "doc_id", (begin - F.col("at")).alias("at"), "words")
    return Mix(documents, slots, out, sources)


def _slots(spark, n_blocks: np.ndarray, quota: np.ndarray, shard_slots: int, seed: int, staged: Staging) -> DataFrame:
    """shard, source_no and block of all slots."""
    total = int(quota.sum())
    shares = quota / max(total, 1)

    def draw(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rng = np.random.Generator(np.random.Philox(np.random.SeedSequence((seed, shard))))
                n = rng.multinomial(min(shard_slots, total - shard * shard_slots), shares / shares.sum())
                got = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got), shard)), pa.array(got.astype(np.int64)), pa.array(n[got].astype(np.int64))], names=["shard", "source_no", "n"]
                )

    shards = spark.range(-(-total // shard_slots))
    draws = staged(shards.mapInArrow(draw, "shard long, source_no long, n long"), "mix_draws")
    got = np.zeros(len(quota), np.int64)
    for row in draws.groupBy("source_no").agg(F.sum("n").alias("n")).collect():  # a row per source, at most MAX_SOURCES
        got[row.source_no] = row.n
    over, short = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over_at, short_at = np.cumsum(over) - over, np.cumsum(short) - short
    numbered = running_total(draws.withColumn("chunk", F.expr("shard div 1000")), ["source_no"], "chunk", [F.col("shard")], "n", "k")

    def place(batches):
        for batch in batches:
            for shard, source, k, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for at in range(k, k + n, SLOT_BATCH):
                    ks = np.arange(at, min(at + SLOT_BATCH, k + n))
                    owner = np.full(len(ks), source)
                    extra = ks >= quota[source]
                    order = over_at[source] + ks[extra] - quota[source]
                    owner[extra] = np.searchsorted(np.cumsum(short), order, "right")
                    ks[extra] = got[owner[extra]] + order - short_at[owner[extra]]
                    block = np.empty_like(ks)
                    for s in np.unique(owner):
                        mine = owner == s
                        for turn in np.unique(ks[mine] // n_blocks[s]):
                            these = mine & (ks // max(n_blocks[s], 1) == turn)
                            block[these] = permuted(ks[these] % n_blocks[s], int(n_blocks[s]), seed, int(s), int(turn))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ks), shard)), pa.array(owner), pa.array(block)], names=["shard", "source_no", "block"]
                    )

    return numbered.select("shard", "source_no", "k", "n").mapInArrow(place, "shard long, source_no long, block long")
