"""Shared helpers: Arrow row maps, word counts, running totals and connected components."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ludoshelf.sources.staging import Staging

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_AT_ONCE = 256

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def map_rows(df: DataFrame, setup: Callable[[], Callable], schema: str) -> DataFrame:
    """One output row per input row. ``setup()`` runs once per task and returns the function of a row's values."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        one = setup()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = [one(*row) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind.type) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds
                )

    return df.mapInArrow(run, schema)


def count_words(texts: pa.StringArray) -> np.ndarray:
    """Words of each text, counted on the UTF-8 bytes (white space bytes stand only for themselves); 0 for null."""
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(len(texts), np.int64)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = ends[:-1][np.diff(ends) > 0]
    first[starts] = ~space[starts]
    total = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])
    counts = np.diff(total[ends])
    if texts.null_count:
        counts[np.asarray(texts.is_null())] = 0
    return counts


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and ``size``, the number of words of the text."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count_words(batch.column(2)))], names=["doc_id", "source", "size"]
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, source string, size long")


def running_total(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before a row, per key in the order of (chunk, order).

    A key is never sorted in one task: rows are summed inside their chunk, and the chunks' totals are summed apart.
    The keys must not be null.
    """
    before = (Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_total"))
    over_chunks = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(*before)
    base = totals.select(*keys, chunk, F.coalesce(F.sum("_total").over(over_chunks), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(*before)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(base, [*keys, chunk])
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .drop("_base", "_inside")
    )


def stage(spark: SparkSession) -> Staging:
    """Written tables of one run, below the cluster's shared folder."""
    return Staging(spark)


def components(edges: DataFrame, staged: Staging, name: str = "components") -> DataFrame:
    """``node`` and ``root``, the least node reachable from it, for every node of ``edges`` (``a``, ``b``; not null).

    Every round hooks each node to its least neighbour, follows the pointers to their ends by doubling, and
    replaces the edges by those between the ends. Edges that became loops go, so the tables shrink; what a
    round found is a written table, not a longer plan. A hub's edges meet only in a minimum, which is taken
    before the shuffle. Rounds and doublings are logarithmic for chains and stars alike.
    """
    edges = edges.select("a", "b").where("a != b")
    roots: DataFrame | None = None
    step = 0
    while True:
        edges = staged(edges, f"{name}_edges_{step}")
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        links = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        links = staged(links.select("node", F.least("node", "least").alias("root")), f"{name}_links_{step}_0")
        hop = 0
        while True:
            up = links.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            hop += 1
            longer = links.join(up, "root").select("node", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("_moved"))
            longer = staged(longer, f"{name}_links_{step}_{hop}")
            links = longer.drop("_moved")
            if longer.where("_moved").isEmpty():
                break
        if roots is None:
            roots = links
        else:
            moved = roots.join(links.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left")
            roots = staged(moved.select("node", F.coalesce("_new", "root").alias("root")), f"{name}_roots_{step}")
        ends = links.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = links.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = (
            edges.join(ends, "a")
            .join(other, "b")
            .where("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        step += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
