"""Document fingerprints: SimHash of weighted terms, and permuted block tables that find near ones.

Terms are the lower-cased words of a text. A term votes with its weight on every bit of its hash: for the bit if it is
set, against it if not; the fingerprint has the bits whose votes are for. The weight is the occurrences times a step that
rises by one with every halving of the share of texts that hold the term, so words that stand in most texts hardly count. All weights
are whole numbers: a fingerprint depends on the text and the corpus, not on the order of sums. Two votes are counted in one long (the low and the
high half of the hash), so a fingerprint of 128 bits is 64 sums of an ordinary aggregation.

Near fingerprints: the bits are cut into blocks. Of two fingerprints at most ``radius`` bits apart all but ``radius`` blocks are equal,
so for every choice of that many blocks there is a table whose keys have them in front; pairs within the radius meet in at
least one table, and their distance is counted.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludoshelf.llm.common import stage
from ludoshelf.llm.simhash import link_components
from ludoshelf.sources.staging import Staging

LONGS = 2
PRINT = [f"f{k}" for k in range(LONGS)]
STEPS = 10  # terms in less than 2^-STEPS of the texts all have the highest weight
RADIUS = 4
BLOCKS = 6
KEY = ["id", "k1", "k2"]
SPACES = "[\\x20\\x09-\\x0D]+"
LANES = 4294967297  # the lowest bit of both halves of a long
COPIES = 100_000  # identical rows that are dealt out at once
SENT = 500_000  # weights that are sent to every task at most (16 bytes each); more are joined by a shuffle


def terms(text: Column) -> Column:
    """Lower-cased words, with repeats; blank ends may leave an empty string."""
    return F.split(F.lower(text), SPACES)


def classes(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a key that has no nulls: id, k1, k2. Rows alike in doc_id and text share it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("k1"),
        F.xxhash64(F.lit(1), "text", F.col("doc_id").isNull()).alias("k2"),
    )


def weights(texts: DataFrame, steps: int = STEPS) -> DataFrame:
    """``term`` (hash) and ``weight`` of terms in at least 2^-``steps`` of the rows of ``texts`` (text), from counts over all rows.

    All others weigh steps + 1. There are at most 2^steps times as many rows as a text has different terms on average.
    """
    held = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("word")).where("word != ''")
    counts = held.groupBy(F.xxhash64("word").alias("term")).agg(F.count("*").alias("n"))
    total = texts.count()
    share = F.floor(F.log2(total / F.col("n"))).cast("long")
    return counts.where(F.col("n") * (1 << steps) >= total).select("term", (share + 1).alias("weight"))


def fingerprints(texts: DataFrame, weighted: DataFrame, keys: list[str], steps: int = STEPS) -> DataFrame:
    """``keys`` (no nulls) and the fingerprint (``f0``, ``f1``) of every row of ``texts`` (the keys and text); zero without a term.

    A text's votes are added where its words are, so one row per text and task is shuffled, or none if the rows are dealt by the keys.
    ``weighted`` is sent to the tasks if it has few rows; they are counted first.
    """
    if weighted.count() <= SENT:
        weighted = F.broadcast(weighted)
    words = texts.select(*keys, F.explode(terms(F.col("text"))).alias("word"))
    hashed = words.select(*keys, F.xxhash64("word").alias("term"), F.xxhash64(F.lit(1), "word").alias("term_1"), (F.col("word") == "").alias("blank"))
    voting = hashed.join(weighted, "term", "left").withColumn("w", F.expr(f"if(blank, 0L, coalesce(weight, {steps + 1}L))"))
    lanes = [F.sum(F.expr(f"w * (shiftrightunsigned({h}, {b}) & {LANES})")).alias(f"s{k}_{b}") for k, h in enumerate(("term", "term_1")) for b in range(32)]
    sums = voting.groupBy(*keys).agg(F.sum("w").alias("votes"), *lanes)

    def bits(k: int) -> Column:
        low = [f"if(2 * (s{k}_{b} & 4294967295) > votes, {1 << b}L, 0L)" for b in range(32)]
        high = [f"if(2 * shiftrightunsigned(s{k}_{b}, 32) > votes, shiftleft(1L, {b + 32}), 0L)" for b in range(32)]
        return F.expr(" | ".join(low + high)).alias(PRINT[k])

    return sums.select(*keys, *[bits(k) for k in range(LONGS)])


def distance(a: str, b: str) -> str:
    """SQL of the number of bits in which the fingerprints with column prefixes ``a`` and ``b`` differ."""
    return "(" + " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in PRINT) + ")"


def block_keys(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``prints`` (f0, f1 and any other columns) once for every table, with ``key``: the table's number and its front blocks.

    Any two fingerprints at most ``radius`` bits apart share a key.
    """
    if not 0 <= radius < blocks:
        raise ValueError("a table needs at least one whole block: the radius must be below the number of blocks")
    bits = 64 * LONGS
    edges = [bits * k // blocks for k in range(blocks + 1)]

    def block(k: int) -> str:
        """The parts of block k in each long, as masked longs."""
        parts = []
        for n, c in enumerate(PRINT):
            first, last = max(edges[k] - 64 * n, 0), min(edges[k + 1] - 64 * n, 64)
            if first < last:
                mask = ((1 << (last - first)) - 1) << first
                parts.append(f"{c} & {mask - (1 << 64) if mask >> 63 else mask}L" if mask != 1 << 63 else f"{c} & shiftleft(1L, 63)")
        return ", ".join(parts)

    tables = [f"xxhash64({n}, {', '.join(block(k) for k in front)})" for n, front in enumerate(combinations(range(blocks), blocks - radius))]
    return prints.withColumn("key", F.explode(F.expr(f"array({', '.join(tables)})")))


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query``, ``found`` and ``bits``: for every row of ``queries`` (query, f0, f1) the rows of ``prints`` (found, f0, f1) at most ``radius`` bits away.

    Each pair once, itself included where it stands in both. Repeated fingerprints should be one row of ``prints``. Rows with null fingerprints find nothing.
    """
    index = block_keys(prints.select("found", *PRINT), radius, blocks).withColumnsRenamed({c: f"p_{c}" for c in PRINT})
    asked = block_keys(queries.select("query", *PRINT), radius, blocks).withColumnsRenamed({c: f"q_{c}" for c in PRINT})
    pairs = asked.join(index, "key").withColumn("bits", F.expr(distance("q_", "p_"))).where(f"bits <= {radius}")
    return pairs.select("query", "found", F.col("bits").cast("int").alias("bits")).distinct()


def groups(prints: DataFrame, staged: Staging, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``node`` and ``root`` of those distinct fingerprints (node, f0, f1) that chains of at most ``radius`` bits link with others."""
    near = block_keys(prints.select("node", *PRINT), radius, blocks).select("key", "node", *PRINT)
    return link_components(near, lambda a, b: f"{distance(f'{a}_', f'{b}_')} <= {radius}", staged)


def followers(rows: DataFrame, staged: Staging) -> DataFrame:
    """Every class (id, k1, k2, none, copies, n_chars) with the key of the one after it: next_id, next_k1, next_k2.

    The order is descending doc_id, then k1, k2; null doc_ids come last, and after the last comes the first. Rows are dealt by ranges of this
    order and looked at inside a range; a range's first class is all that the range before it needs.
    """
    order = ["none", F.desc("id"), "k1", "k2"]
    dealt = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "fingerprint_order")
    place = "struct(none, -id, k1, k2)"
    firsts = dealt.groupBy("part").agg(F.min_by(F.struct(*KEY), F.expr(place)).alias("first"))
    heads = firsts.select((F.col("part")).alias("head_part"), "first")
    over = Window.orderBy("head_part")  # a row a range
    all_heads = Window.orderBy("head_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(F.col("head_part").alias("part"), F.coalesce(F.lead("first").over(over), F.first("first").over(all_heads)).alias("after"))
    inside = Window.partitionBy("part").orderBy(*order)
    with_next = dealt.withColumn("next", F.lead(F.struct(*KEY)).over(inside)).join(F.broadcast(after), "part")
    return with_next.withColumn("next", F.coalesce("next", "after")).select(
        *KEY, "none", "copies", "n_chars", *[F.col(f"next.{k}").alias(f"next_{k}") for k in KEY]
    )


def edit_likeness(docs: DataFrame, staged: Staging | None = None, radius: int = RADIUS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (32 hexadecimal digits), near_edited, near_next and group_id
    for every row of ``docs`` (doc_id, text).

    The edited text is the text with its last third (floor of the code points) replaced by the first as many code points of the next document, or all it
    has. The likeness of two fingerprints is the share of equal bits. group_id is the least doc_id that links of at most ``radius`` bits
    lead to, itself included.

    Null, empty and blank texts have the fingerprint zero; null texts count as empty. Rows alike in doc_id and text follow one another: all but the
    last are edited with their own text. Documents with equal doc_id are ordered by hashes of their texts; a null doc_id comes last, and a
    group_id is null only if all doc_ids of the group are. Other columns are ignored. An empty table gives an empty one.
    """
    staged = staged or stage(docs.sparkSession)
    rows = classes(docs)
    counted = rows.groupBy(*KEY, F.col("doc_id").isNull().alias("none"), F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("copies"))
    ordered = staged(followers(staged(counted, "fingerprint_classes"), staged), "fingerprint_followers")
    weighted = staged(weights(rows), "fingerprint_weights")

    one_each = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    # What a document gives to the one before it; both joins read the same shuffled texts.
    wanted = ordered.select(*[F.col(f"next_{k}").alias(k) for k in KEY], *[F.col(k).alias(f"for_{k}") for k in KEY], (F.col("n_chars") / 3).cast("long").alias("need"))
    given = one_each.hint("merge").join(wanted, KEY).select(*[F.col(f"for_{k}").alias(k) for k in KEY], F.expr("substring(text, 1, cast(need as int))").alias("given"))
    both = one_each.hint("merge").join(ordered.select(*KEY, "n_chars", "copies"), KEY).join(given.hint("merge"), KEY)
    cut = "cast(n_chars div 3 as int)"
    kept = f"substring(text, 1, cast(n_chars as int) - {cut})"
    versions = F.expr(f"stack(3, 0, text, 1, concat({kept}, given), 2, if(copies > 1, concat({kept}, substring(text, 1, {cut})), null)) as (version, text)")
    edited = both.select(*KEY, versions).where("text is not null")
    edited = edited.select(*KEY, "version", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text")
    printed = fingerprints(edited, weighted, [*KEY, "version", "sha"])
    wide = printed.groupBy(*KEY).agg(*[F.max(F.expr(f"if(version = {v}, {c}, null)")).alias(f"v{v}_{c}") for v in range(3) for c in (*PRINT, "sha")])
    prints = staged(wide, "fingerprint_prints")

    after = prints.select(*[F.col(k).alias(f"next_{k}") for k in KEY], *[F.col(f"v0_{c}").alias(f"n_{c}") for c in PRINT])
    per_class = ordered.join(prints, KEY).join(after, [f"next_{k}" for k in KEY])
    per_class = per_class.withColumn("node", F.xxhash64(*[f"v0_{c}" for c in PRINT]))
    per_class = staged(per_class, "fingerprint_rows")

    doc_id = F.expr("if(none, null, id)")
    distinct = per_class.groupBy("node", *[F.col(f"v0_{c}").alias(c) for c in PRINT]).agg(F.min(doc_id).alias("least"))
    distinct = staged(distinct, "fingerprint_distinct")
    linked = groups(distinct, staged, radius)
    rooted = distinct.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = staged(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("group_id")).hint("merge"), "root").select("node", "group_id"), "fingerprint_groups")

    # A class of c identical rows: one is followed by the next class, c - 1 by themselves.
    blocks = F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("block")
    block = per_class.join(named, "node").select("*", blocks)
    one = F.explode(F.expr(f"sequence(block * {COPIES}L + 1, least(copies, (block + 1) * {COPIES}L))")).alias("copy")
    dealt = block.select("*", one).withColumn("own", F.expr("copy > 1"))

    def digits(prefix: str) -> Column:
        return F.lower(F.concat(*[F.lpad(F.hex(f"{prefix}{c}"), 16, "0") for c in reversed(PRINT)]))

    def alike(a: str, b: str) -> Column:
        return 1 - F.expr(distance(a, b)) / F.lit(64.0 * LONGS)

    return dealt.select(
        doc_id.alias("doc_id"),
        "n_chars",
        F.expr("if(own, v2_sha, v1_sha)").alias("edited_sha256"),
        digits("v0_").alias("fingerprint"),
        F.when(F.col("own"), digits("v2_")).otherwise(digits("v1_")).alias("edited_fingerprint"),
        F.when(F.col("own"), alike("v0_", "v2_")).otherwise(alike("v0_", "v1_")).alias("near_edited"),
        F.when(F.col("own"), F.lit(1.0)).otherwise(alike("v0_", "n_")).alias("near_next"),
        "group_id",
    )
