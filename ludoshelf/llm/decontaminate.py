"""Benchmark decontamination by SimHash over item-sized windows.

A window of a document is as long as a benchmark item. Items and windows get 64-bit SimHash fingerprints over word shingles; the
fingerprint is cut into radius + 1 blocks, so two that differ in at most ``radius`` bits agree in some block (multi-index
Hamming search). Candidates of that radius, and each window with the item it was placed for, are verified by their exact weighted
shingle similarity: prints of a text that repeats a few words may differ in more bits.

To reach similarity t with an item of m shingles, a window must hold t of m, so it holds one of any floor(m(1-t)) + 1 of them: those
anchors of each item are looked up in the documents. Where a document holds an anchor, all places of the item's shingles in it are
marked, and of all windows the one that shares most with the item is found from the marks, however its words are moved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import stage
from ludoshelf.llm.line_dedup import once, same_row, text_key
from ludoshelf.sources.staging import Staging

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case: case and punctuation don't hide a copy."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words, in order."""
    each = ", ".join(f"get({words}, i + {k})" for k in range(length))
    return F.expr(f"if(size({words}) < {length}, cast(array() as array<bigint>), transform(sequence(0, size({words}) - {length}), i -> xxhash64({each})))")


def fingerprint(rows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """``keys`` and ``print`` for rows with an array of shingle hashes, one row per key: a bit is set if over half the hashes have it.

    Bits k and k + 32 are summed side by side in one long, so 32 sums do for 64 bits.
    """
    sums = [F.sum(F.expr(f"shiftrightunsigned(h, {k}) & 4294967297L")).alias(f"s{k}") for k in range(32)]
    counted = rows.select(*keys, F.explode(shingles).alias("h")).groupBy(*keys).agg(F.count("*").alias("m"), *sums)
    low = " | ".join(f"if(2 * (s{k} & 4294967295L) > m, shiftleft(1L, {k}), 0L)" for k in range(32))
    high = " | ".join(f"if(2 * shiftrightunsigned(s{k}, 32) > m, shiftleft(1L, {k + 32}), 0L)" for k in range(32))
    return counted.select(*keys, F.expr(f"({low}) | ({high})").alias("print"))


def blocks(radius: int) -> Column:
    """(number, bits) of radius + 1 blocks of a fingerprint ``print``, as an array."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    parts = [f"named_struct('block', {k}, 'bits', shiftrightunsigned(print, {a}) & {(1 << (b - a)) - 1}L)" for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return F.expr(f"array({', '.join(parts)})")


def shingle_weights(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, the number of shingles ``m``, and each distinct shingle ``h`` with how often it stands."""
    return rows.select(*keys, F.size("shingles").alias("m"), F.explode("shingles").alias("h")).groupBy(*keys, "m", "h").agg(F.count("*").alias("weight"))


def best_windows(marks: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """``keys``, start, ``size`` in shingles: of each document's windows the first of those that share most with an item, if similar enough.

    ``marks`` has a row per place ``i`` where a document of ``total`` words holds a shingle ``h`` of an item (n words, m shingles, h with
    ``weight``). A place counts in a window if fewer than ``weight`` places of its shingle stand before it there. What a window shares
    can only rise at a place that comes in at its end, so only windows that end in one, and the first of all, can be the first of the best.
    """
    kept = [*keys, "total", "n", "m"]
    placed = marks.groupBy(*kept, "h", "weight").agg(F.sort_array(F.collect_list("i")).alias("at"))
    placed = placed.select(*kept, F.explode(F.expr("transform(at, (x, k) -> named_struct('i', x, 'before', coalesce(get(at, k - cast(weight as int)), -1)))")).alias("hit"))
    found = placed.groupBy(*kept).agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    found = found.withColumn("size", F.expr(f"least(n, total) - least(n, {SHINGLE}) + 1"))
    found = found.withColumn("need", F.expr(f"cast(ceil({similarity / (1 + similarity)!r}D * (m + size) - 1e-9D) as int)")).where("size(hits) >= need")
    ends = "filter(sequence(need - 1, size(hits) - 1), k -> hits[k].i - hits[k - need + 1].i < size)"
    start = "greatest(hits[k].i - size + 1, 0)"
    inside = f"filter(slice(hits, greatest(k - size + 2, 1), least(k + 1, size)), x -> x.i > hits[k].i - size and x.before < {start})"
    best = once(F.expr(f"array_max(transform({ends}, k -> named_struct('shared', size({inside}), 'back', -{start})))"))
    found = found.select(*keys, "n", "m", "size", best.alias("best"))
    return found.where(F.expr(f"best.shared / (m + size - best.shared) >= {similarity!r}D")).select(*keys, "n", "size", F.expr("-best.back").alias("start"))


def contaminations(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, staged: Staging | None = None
) -> DataFrame:
    """doc_id, item_id, start, n_words and similarity: the best window of each document for each item that it holds.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored. start counts words from 0; of equally
    similar windows it is the first. Similarity is the weighted Jaccard of shingles of five words, each weighing as often as it stands
    (all words make one shingle of an item with fewer). A document shorter than an item is one window. Null, empty and wordless texts
    hold nothing and are held nowhere. Rows alike in doc_id and text are one document and appear once; likewise items. Texts are read
    whole, and no window of them is left out.
    """
    spark = docs.sparkSession
    staged = staged or stage(spark)
    doc, item = ["doc_id", "k1", "k2"], ["item_id", "item_key"]

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), once(words_of(F.col("text").cast("string"))).alias("w")).where("size(w) > 0").distinct()
    items = staged(items.select("item_id", F.size("w").alias("n"), F.xxhash64("w").alias("item_key"), "w"), "bench_words")
    short = sorted(r.n for r in items.where(f"n < {SHINGLE}").select("n").distinct().collect())  # at most four lengths
    lengths = [*short, SHINGLE]
    by_length = F.coalesce(*[F.when(F.least("n", F.lit(SHINGLE)) == k, shingles_of("w", k)) for k in lengths])
    items = staged(items.select(*item, "n", by_length.alias("shingles")), "bench_items")
    held = staged(shingle_weights(items, *item, "n"), "bench_shingles")
    rank = F.expr("row_number() over (partition by item_id, item_key order by xxhash64(h), h)")
    anchors = held.withColumn("rank", rank).where(F.col("rank") <= F.floor(F.col("m") * (1 - similarity) + 1e-9) + 1)
    anchors = staged(anchors.groupBy("h").agg(F.collect_set(F.struct(*item)).alias("items")), "bench_anchors")

    text = F.col("text").cast("string")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(text), text.alias("text"))
    worded = read.select(*doc, once(words_of(F.col("text"))).alias("w"))
    found = [worded.select(*doc, F.explode(shingles_of("w", k)).alias("h")) for k in lengths]
    hits = reduce(DataFrame.union, found).join(anchors, "h").select(*doc, "items")
    spots = hits.groupBy(*doc).agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    spots = staged(spots, "bench_spots")

    near = read.alias("d").join(spots.alias("s"), same_row("d", "s")).select("d.doc_id", "d.k1", "d.k2", "d.text", "s.items")
    near = near.dropDuplicates(doc).select(*doc, "items", once(words_of(F.col("text"))).alias("w"))
    near = staged(near.select(*doc, "items", F.size("w").alias("total"), *[shingles_of("w", k).alias(f"s{k}") for k in lengths]), "bench_near")
    holders = held.groupBy("h").agg(F.collect_list(F.struct(*item, "n", "m", "weight")).alias("holders"))
    marks = reduce(DataFrame.union, [near.select(*doc, "items", "total", F.posexplode(f"s{k}").alias("i", "h")) for k in lengths]).join(holders, "h")
    of_doc = "filter(holders, x -> array_contains(items, named_struct('item_id', x.item_id, 'item_key', x.item_key)))"
    marks = marks.select(*doc, "total", "i", "h", F.explode(F.expr(of_doc)).alias("x")).select(*doc, "total", "i", "h", "x.*")
    best = best_windows(marks, [*doc, *item], similarity)

    cut = " ".join(f"when least(n, {SHINGLE}) = {k} then slice(s{k}, start + 1, size)" for k in lengths)
    near = near.alias("d").join(best.alias("s"), same_row("d", "s")).select("d.*", *[f"s.{c}" for c in (*item, "n", "size", "start")])
    near = near.select(*doc, *item, "n", "start", F.expr("cast(least(n, total) as long)").alias("n_words"), F.expr(f"case {cut} end").alias("shingles"))
    near = staged(near.withColumns({"c1": F.xxhash64("shingles"), "c2": F.xxhash64(F.lit(1), "shingles")}), "bench_windows")
    content = ["n", "c1", "c2"]
    windows = staged(near.groupBy(*content).agg(F.any_value("shingles").alias("shingles")), "bench_contents")

    item_blocks = fingerprint(items, [*item, "n"], "shingles").withColumn("b", F.explode(blocks(radius)))
    window_blocks = fingerprint(windows, content, "shingles").withColumn("b", F.explode(blocks(radius)))
    pairs = (
        window_blocks.select(*content, "b", F.col("print").alias("other"))
        .join(item_blocks, ["n", "b"])
        .where(F.expr(f"bit_count(print ^ other) <= {radius}"))
        .select(*content, *item)
    )
    pairs = staged(pairs.union(near.select(*content, *item)).distinct(), "bench_pairs")

    of_window = shingle_weights(windows, *content)
    of_item = held.drop("n").withColumnsRenamed({"m": "m2", "weight": "weight2"})
    same_item = F.expr("p.item_id <=> i.item_id and p.item_key = i.item_key and p.h = i.h")
    shared = (
        pairs.join(of_window, content).alias("p")
        .join(of_item.alias("i"), same_item)
        .select(*content, "p.item_id", "p.item_key", "m", "m2", F.least("weight", "weight2").alias("both"))
        .groupBy(*content, *item, "m", "m2")
        .agg(F.sum("both").alias("shared"))
        .withColumn("similarity", F.col("shared") / (F.col("m") + F.col("m2") - F.col("shared")))
        .where(F.col("similarity") >= similarity)
        .drop(*item[1:], "m", "m2")
    )
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start")))
    matched = near.drop("shingles", *item).join(staged(shared, "bench_matches"), content)
    out = matched.groupBy(*doc, "item_id").agg(best.alias("best"))
    return out.select("doc_id", "item_id", F.col("best.start").cast("long").alias("start"), "best.n_words", "best.similarity", "k1", "k2")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, as they are, that hold no item."""
    held = contaminations(docs, benchmark, **options).select("doc_id", "k1", "k2").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text").cast("string")))
    return rows.alias("d").join(held.alias("h"), same_row("d", "h"), "left_anti").select("row.*")
