"""Near-duplicates by SimHash fingerprints under Golay-code fuzzy hashing.

A fingerprint is cut into three segments of at most 23 bits. The binary Golay code is perfect: every 23-bit word lies within three
bits of exactly one codeword. A segment's near indices are the codewords that it or a word one bit away decodes to (one
or six); two segments at most two bits apart share one. Of at most four wrong bits, the two best of three segments
hold at most two together, so for some pair of segments two linked fingerprints meet in a key made of one segment's own
index and one of the other's near indices. Keys are joined and the Hamming distance is verified.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludoshelf.llm.common import ROWS_AT_ONCE, components, stage
from ludoshelf.llm.line_dedup import text_key
from ludoshelf.sources.staging import Staging

RADIUS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
GENERATOR = 0b101011100011  # fixed value: generator polynomial of the binary Golay code of length 23
HASHES_AT_ONCE = 1 << 16
STARS = 3  # comparisons with heads, before the members of different components are compared


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash of the word shingles of a text, lower-cased in A-Z; a bit is set if over half the hashes have it.

    Fewer words than a shingle make one shingle, no word gives 0. Repeated shingles count each time.
    """
    return int(_majority(_shingles(words_of(text), words), partial(xxhash.xxh64_digest, seed=SEED), 1)[0])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _shingles(split: list[bytes], words: int) -> Iterator[bytes]:
    if len(split) <= words:
        return iter([b" ".join(split)] if split else [])
    return map(b" ".join, zip(*(split[k:] for k in range(words)), strict=False))


def _majority(features: Iterable[bytes], digest: Callable[[bytes], bytes], longs: int) -> np.ndarray:
    """The bits that over half the digests (of 8 * ``longs`` bytes) have set, as signed longs; zeros for no feature."""
    ones, n, features = np.zeros(64 * longs, np.int64), 0, iter(features)
    while part := list(islice(features, HASHES_AT_ONCE)):
        raw = np.frombuffer(b"".join(map(digest, part)), np.uint8).reshape(len(part), -1)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return np.packbits(2 * ones > n).view(">i8")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and ``print``, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                prints = [fingerprint(t, words) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.int64())], names=["doc_id", "print"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, print long")


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    word = word.copy()
    for bit in range(22, 10, -1):
        word ^= ((word >> bit) & 1) * (GENERATOR << (bit - 11))
    return word


def _decoding() -> np.ndarray:
    """For each syndrome the pattern of at most three bits that has it."""
    table = np.zeros(2048, np.int64)
    patterns = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)], np.int64)
    table[_syndrome(patterns)] = patterns
    return table


ERRORS = _decoding()


def indices(segment: np.ndarray, width: int) -> np.ndarray:
    """Per word (row) the index of its own codeword, then those that the words one bit away (in ``width`` bits) decode to."""
    words = np.concatenate([segment[:, None], segment[:, None] ^ (1 << np.arange(width))[None, :]], axis=1)
    return (words ^ ERRORS[_syndrome(words)]) >> 11


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of fingerprints: positions into ``prints`` and keys, each pair once."""
    bits = prints.view(np.uint64) if prints.dtype == np.int64 else prints
    near = []
    for first, width in SEGMENTS:
        segment = ((bits >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        near.append(indices(segment, width))
    of, out = [], []
    rows = np.arange(len(prints))
    for number, (a, b) in enumerate(combinations(range(3), 2)):
        left = near[a] * 4096 + near[b][:, :1]
        right = near[a][:, :1] * 4096 + near[b]
        both = np.concatenate([left, right], axis=1) + (number << 24)
        of.append(np.repeat(rows, both.shape[1]))
        out.append(both.ravel())
    pairs = np.unique(np.concatenate(of) << 32 | np.concatenate(out))
    return pairs >> 32, pairs & 0xFFFFFFFF


def key_rows(prints: DataFrame, name: str = "print") -> DataFrame:
    """``key`` and the column ``name`` (long) for each row of ``prints``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                values, carried = (batch.column(k).slice(at, 4096).to_numpy(zero_copy_only=False) for k in (0, 1))
                of, key = keys(values)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(carried[of])], names=["key", name])

    return prints.select("print", F.col(name).alias("carried")).mapInArrow(run, f"key int, {name} long")


def side(rows: DataFrame, name: str, *but: str) -> DataFrame:
    """``rows`` with ``name`` before the names of its columns, but for some."""
    return rows.withColumnsRenamed({c: f"{name}_{c}" for c in rows.columns if c not in but})


def merged(roots: DataFrame, pairs: DataFrame, staged: Staging, name: str) -> DataFrame:
    """Components (``node``, ``root``) after further links ``a``, ``b``, whose ends may be nodes or roots."""
    for end in ("a", "b"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        pairs = pairs.join(of, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    again = components(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), staged, name)
    through = roots.join(again.select(F.col("node").alias("root"), F.col("root").alias("_final")), "root", "left")
    through = through.select("node", F.coalesce("_final", "root").alias("root"))
    alone = again.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return staged(through.unionByName(alone), f"{name}_roots")


def link_components(near: DataFrame, linked: Callable[[str, str], str], staged: Staging) -> DataFrame:
    """``node`` and ``root`` for those nodes of ``near`` that have links. ``near`` has ``key``, ``node`` and the columns that
    ``linked`` reads; ``linked(a, b)`` is the condition of a link between two rows by the prefixes of their columns.

    First every member of a key is held against one head of the key: links of a star, one row a member. This is repeated with other
    heads in the keys that still hold several components. Only then members of different components are held against each
    other. A crowded group is thereby one component before any pairs are made.
    """
    near = staged(near, "golay_keys")
    carried = [c for c in near.columns if c not in ("key", "node")]

    def by(number: int) -> Column:
        """The order of a round, whose least member is the key's head."""
        return F.xxhash64("node", F.lit(number))

    def star(rows: DataFrame, number: int) -> DataFrame:
        """Links between the members of a key and its head."""
        heads = rows.groupBy("key").agg(*[F.min_by(c, by(number)).alias(f"h_{c}") for c in ("node", *carried)], F.count("*").alias("n"))
        heads = heads.where("n > 1").drop("n").hint("merge")
        pairs = side(rows, "m", "key").join(heads, "key").where(f"h_node != m_node and {linked('h', 'm')}")
        return pairs.select(F.least("h_node", "m_node").alias("a"), F.greatest("h_node", "m_node").alias("b")).distinct()

    rows, roots = near, None
    for number in range(STARS):
        pairs = star(rows, number)
        roots = components(pairs, staged, "golay_star_0") if roots is None else merged(roots, pairs, staged, f"golay_star_{number}")
        named = staged(rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), f"golay_named_{number}")
        mixed = named.groupBy("key").agg(F.min_by("node", by(number)).alias("head"), F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        # The head of a key has been held against all others; a key of two is done, and so is one of a single component.
        mixed = mixed.where("n > 2 and lo != hi").select("key", "head").hint("merge")
        left = staged(named.join(mixed, "key").where("node != head").drop("head"), f"golay_mixed_{number}")
        rows = left.drop("root")
    across = side(left, "a", "key").hint("merge").join(side(left, "b", "key"), "key").where(f"a_root < b_root and {linked('a', 'b')}")
    return merged(roots, across.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), staged, "golay_across")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = RADIUS, staged: Staging | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and n_component of every row of ``docs`` (doc_id, text).

    component_id is the least doc_id that links of at most ``radius`` bits lead to, n_component the rows of the component. Copies share a
    fingerprint and are counted before anything is compared. Null, empty and blank texts have fingerprint zero and link like others. A
    row with null doc_id takes part; its component has the least doc_id that is not null, or null. Other columns are ignored.
    """
    staged = staged or stage(docs.sparkSession)
    printed = staged(fingerprints(docs, words), "simhash")
    distinct = staged(printed.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash_distinct")
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the keys guarantee a radius of at most {RADIUS}")
    near = key_rows(distinct).withColumnRenamed("print", "node")
    linked = link_components(near, lambda a, b: f"bit_count({a}_node ^ {b}_node) <= {radius}", staged).withColumnRenamed("node", "print")
    rooted = distinct.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("n_component")).hint("merge")
    named = staged(rooted.join(groups, "root").select("print", "component_id", "n_component"), "simhash_groups")
    return printed.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "n_component"
    )


#: Whole-text similarity: exact Jaccard of the sets of word shingles. Texts meet in keys that lose no pair, two prints of the sets rule out
#: what merely met, and the rest is verified on the sets. SimHash: angle / pi is at most arccos(2s / (1 + s)) / pi = 0.152 of the bits at a
#: similarity of 0.8, and 3/16 for the smallest sets; the cut lies six standard deviations above. Parity: bit b tells whether an odd number
#: of shingles fell on it, so the bits in which two sets differ are never more than the shingles in which they differ; this cut is exact.
WIDE_LONGS = 4
PARITY_LONGS = 16
SIMILAR = 0.8
SMALL = 32  # shingles of a set whose prints are cut by the wider share
WIDE = [f"w{k}" for k in range(WIDE_LONGS)]
PARITY = [f"p{k}" for k in range(PARITY_LONGS)]
SAMPLE = 5_000  # documents whose shingles are counted
COMMON = 300_000  # shingles that are known as common at most
SETTLED = 0.9  # a round of stars that leaves more of its rows is the last one


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct 64-bit hashes of the word shingles of a text, in order."""
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(s, seed=SEED) for s in _shingles(words_of(text), words)), np.uint64).view(np.int64))


def _mixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Further 64 bits of each hash, by the finaliser of splitmix64."""
    x = hashes.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * number) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_print(shingles: np.ndarray) -> np.ndarray:
    """SimHash of a set of hashes, ``WIDE_LONGS`` signed longs."""
    ones = np.zeros((WIDE_LONGS, 64), np.int64)
    for at in range(0, len(shingles), HASHES_AT_ONCE):
        part = shingles[at : at + HASHES_AT_ONCE]
        for k in range(WIDE_LONGS):
            ones[k] += np.unpackbits(_mixed(part, k + 1).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), axis=1).view(">i8").ravel().astype(np.int64)


def parity_print(shingles: np.ndarray) -> np.ndarray:
    """For each of 64 * ``PARITY_LONGS`` places whether an odd number of hashes fell on it, as signed longs."""
    bits = 64 * PARITY_LONGS
    places = (_mixed(shingles, WIDE_LONGS + 1) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).view(">i8").astype(np.int64)


def shingle_sets(docs: DataFrame, words: int, keys: list[str]) -> DataFrame:
    """The columns ``keys`` (long) of ``docs`` and ``shingles``, the set of its column text."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                sets = [shingle_set(t, words) for t in part.column(len(keys)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], pa.array(sets, pa.list_(pa.int64()))], names=[*keys, "shingles"])

    return docs.select(*keys, F.col("text").cast("string")).mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", shingles array<long>")


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand in several texts of a sample, in order, and their counts. They only order the keys; no result depends on them."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.where(F.expr(f"pmod(xxhash64(cast(text as string)), {every}) = 0")).select(F.lit(0).cast("long").alias("zero"), "text")
    counts = shingle_sets(some, words, ["zero"]).select(F.explode("shingles").alias("h")).groupBy("h").count().where("count > 1")
    found = counts.orderBy(F.desc("count"), "h").limit(COMMON).toArrow()
    hashes, n = (found.column(k).to_numpy().astype(np.int64) for k in ("h", "count"))
    order = np.argsort(hashes)
    return hashes[order], n[order]


def prefix(shingles: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shingles of a set of which it shares one with those of any set of at least ``similarity``, in their order.

    In one order of all shingles, rare ones first, two sets that share ``similarity`` * n of n shingles share one of their first n - similarity * n + 1.
    """
    hashes, counts = common
    n = len(shingles)
    if n == 0:
        return shingles
    known = np.zeros(n, np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
        known = np.where(hashes[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, known))[: n - math.ceil(similarity * n - 1e-9) + 1]]


#: doc_id and text as columns without null, so that a join deals rows as a window over them does.
ROW_KEY = ["id", "no_id", "k1", "k2"]


def row_key(docs: DataFrame) -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), doc_id.isNull().alias("no_id"), *text_key(F.col("text").cast("string"))]


def text_prints(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """doc_id, k1, k2 (the row's key), node (a hash of the set of shingles), n (its size), its two prints and keys."""
    known = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                node, n, prints, keys = [], [], [], []
                for text in part.column(3).to_pylist():
                    hashes = shingle_set(text, words)
                    prints.append(np.concatenate([wide_print(hashes), parity_print(hashes)]))
                    node.append(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=SEED)).astype(np.int64))
                    n.append(len(hashes))
                    keys.append(prefix(hashes, similarity, known.value))
                columns = [pa.array(node, pa.int64()), pa.array(n, pa.int64()), *[pa.array(c) for c in np.stack(prints).T], pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names=["doc_id", "k1", "k2", "node", "n", *WIDE, *PARITY, "keys"])

    text = F.col("text").cast("string")
    kinds = ", ".join(f"{c} long" for c in (*WIDE, *PARITY))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(text), text).mapInArrow(run, f"doc_id long, k1 long, k2 long, node long, n long, {kinds}, keys array<long>")


def most_bits(share: float) -> int:
    """Bits of a wide print in which two prints may differ that are expected to differ in ``share`` of them: six standard deviations more."""
    bits = 64 * WIDE_LONGS
    return round(bits * share + 6 * math.sqrt(bits * share * (1 - share)))


def similar_components(
    met: DataFrame,
    meets: Callable[[str, str], str],
    prints: DataFrame,
    sets_of: Callable[[DataFrame, str], DataFrame],
    similarity: float,
    staged: Staging,
    name: str,
    roots: DataFrame | None = None,
) -> DataFrame:
    """``node`` and ``root`` for the sets that are linked: pairs with a Jaccard similarity of at least ``similarity`` that share a key and meet in it.

    ``met`` has a row for each key of a set: ``key``, ``node``, ``n`` (the set's size) and what else ``meets(a, b)`` reads, the condition on two members of a
    key by the prefixes of their columns. ``prints`` has the prints of each node; ``sets_of`` makes the shingles of the nodes of a table, which is asked
    only for pairs whose prints agree. ``roots`` are components that are known already.

    Rounds of stars come first: each key's members are held against one head, the member with most keys, then the one with most keys outside the component
    of the first. Rounds go on while they settle keys. Members of different components that still share a key are then held against each other; that
    the prints agree is part of the join's condition, so what merely shares a key becomes no row.
    """
    angle = math.acos(2 * similarity / (1 + similarity)) / math.pi
    most, most_small = most_bits(angle), most_bits(max(angle, 3 / 16))
    prints_of, carried = [*WIDE, *PARITY], [c for c in met.columns if c not in ("key", "node")]

    def prints_agree(a: str, b: str) -> str:
        differ = {kind[0]: " + ".join(f"bit_count({a}_{w} ^ {b}_{w})" for w in kind) for kind in (WIDE, PARITY)}
        parity = f"{differ[PARITY[0]]} <= {(1 - similarity) / (1 + similarity)} * ({a}_n + {b}_n) + 1e-9"
        return f"{parity} and {differ[WIDE[0]]} <= if(least({a}_n, {b}_n) < {SMALL}, {most_small}, {most})"

    def verified(pairs: DataFrame, of: str) -> DataFrame:
        sets = sets_of(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node"), of)
        for end in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}_set")), end)
        both = pairs.select("a", "b", F.expr("size(array_intersect(a_set, b_set))").alias("both"), F.expr("size(a_set) + size(b_set)").alias("sizes"))
        return both.where(f"both >= {similarity} * (sizes - both) - 1e-9").select("a", "b")

    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    def rooted(rows: DataFrame) -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    keys = met.groupBy("node").agg(F.count("*").alias("keys"))
    rows = staged(rooted(met.join(keys, "node")), f"{name}_rows_0")
    left, number = rows.count(), 0
    member, order = F.struct("node", "root", *carried), F.struct(-F.col("keys"), F.xxhash64("node"), "node")
    while left:
        heads = rows.groupBy("key").agg(F.min_by(member, order).alias("h"))
        if number:
            others = rows.join(heads.select("key", F.col("h.root").alias("settled")).hint("merge"), "key").where("root != settled")
            heads = others.groupBy("key").agg(F.min_by(member, order).alias("h"))
        heads = heads.select("key", *[F.col(f"h.{c}").alias(f"h_{c}") for c in ("node", "root", *carried)]).hint("merge")
        pairs = side(rows, "m", "key").join(heads, "key").where(f"h_root != m_root and {meets('h', 'm')}")
        pairs = pairs.select(*ordered("h_node", "m_node")).distinct()
        for end in ("a", "b"):
            pairs = pairs.join(side(prints, end, "node").withColumnRenamed("node", end), end)
        links = verified(staged(pairs.where(prints_agree("a", "b")).select("a", "b"), f"{name}_candidates_{number}"), f"{name}_sets_{number}")
        roots = components(links, staged, f"{name}_star_0") if roots is None else merged(roots, links, staged, f"{name}_star_{number}")
        named = staged(rooted(rows.drop("root")), f"{name}_named_{number}")
        mixed = named.groupBy("key").agg(F.min_by("node", order).alias("head"), F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        # The first round's head has been held against all others; a key of two is done, and so is one of a single component.
        mixed = mixed.where("lo != hi" if number else "n > 2 and lo != hi").select("key", "head").hint("merge")
        rows = named.join(mixed, "key").where("true" if number else "node != head").drop("head")
        number += 1
        rows = staged(rows, f"{name}_rows_{number}")
        before, left = left, rows.count()
        if left > SETTLED * before:
            break
    if roots is None:
        return met.select("node", F.col("node").alias("root"))
    if not left:
        return roots
    seen = side(rows.select("key", "node", "root", *carried).join(prints.select("node", *prints_of), "node"), "a", "key")
    other = seen.withColumnsRenamed({c: f"b{c[1:]}" for c in seen.columns if c != "key"})
    across = seen.hint("merge").join(other, "key").where(f"a_root < b_root and {meets('a', 'b')} and {prints_agree('a', 'b')}")
    across = staged(across.select(*ordered("a_node", "b_node")).distinct(), f"{name}_across_candidates")
    return merged(roots, verified(across, f"{name}_across_sets"), staged, f"{name}_across")


def golay_met(prints: DataFrame, staged: Staging) -> DataFrame:
    """``key``, ``node``, ``n`` and ``print`` of the rows of ``prints`` (node, n, print) that share a Golay key with another one."""
    every = staged(key_rows(prints, "node"), "golay_keys")
    shared = every.groupBy("key").count().where("count > 1").select("key").hint("merge")
    return staged(every.join(shared, "key").join(prints.hint("merge"), "node").select("key", "node", "n", "print"), "golay_met")


def prefix_met(printed: DataFrame, staged: Staging) -> DataFrame:
    """``key``, ``node``, ``pos`` and ``n`` for the keys of each set that another set has, too.

    Most keys stand in one text only. They go before nodes are shuffled; keys that only copies share go after copies have met.
    """
    every = printed.select(F.posexplode("keys").alias("pos", "key"), "node", F.col("n").cast("int").alias("n"))
    shared = staged(every.groupBy("key").count().where("count > 1").select("key"), "text_keys")
    met = staged(every.join(shared, "key").select("key", "node", "pos", "n").distinct(), "text_met")
    return staged(met.join(met.groupBy("key").count().where("count > 1").select("key").hint("merge"), "key"), "text_near")


def representatives(docs: DataFrame, words: int = 5, similarity: float = SIMILAR, staged: Staging | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns), as they are, that are first of their group of near-duplicates.

    Texts are linked if the Jaccard similarity of their sets of shingles of ``words`` words is at least ``similarity``; a set is known by
    its 64-bit hash, like a shingle. The least (doc_id, text key) of a group stays, one row of it; a null doc_id is least. Null,
    empty and blank texts are one group.

    Sets whose 64-bit SimHash differs in at most ``RADIUS`` bits meet in Golay keys and are linked first. At a similarity of 0.8 more bits may
    differ, so sets of different components then meet in shingles, which lose no pair.
    """
    staged = staged or stage(docs.sparkSession)
    printed = staged(text_prints(docs, words, similarity), "text_prints")
    least = F.min(F.struct("doc_id", "k1", "k2")).alias("least")
    classes = staged(printed.groupBy("node").agg(least), "text_classes")
    prints = staged(printed.select("node", F.col("n").cast("int").alias("n"), *WIDE, *PARITY).dropDuplicates(["node"]), "text_set_prints")
    rows = docs.select(F.struct("*").alias("row"), *row_key(docs))

    def sets_of(asked: DataFrame, name: str) -> DataFrame:
        """Sets of the nodes of ``asked``. Their texts' keys are a small table; texts that have none of them are not shuffled as long as Spark broadcasts it."""
        one = staged(classes.join(asked, "node").select("node", "least.*"), f"{name}_of")
        one = one.select("node", F.expr("coalesce(doc_id, 0)").alias("id"), F.expr("doc_id is null").alias("no_id"), "k1", "k2")
        some = docs.select(F.col("text").cast("string").alias("text"), *row_key(docs)).join(one.select("k1"), "k1", "left_semi")
        return staged(shingle_sets(some.join(one, ROW_KEY).select("node", "text"), words, ["node"]).dropDuplicates(["node"]), name)

    sizes = f"least({{a}}_n, {{b}}_n) >= {similarity} * greatest({{a}}_n, {{b}}_n) - 1e-9"

    def prints_near(a: str, b: str) -> str:
        return f"bit_count({a}_print ^ {b}_print) <= {RADIUS} and {sizes.format(a=a, b=b)}"

    def within_reach(a: str, b: str) -> str:
        """At the first key that two similar sets share, no more than the rest of both sets can be common. Pairs for which that is too little
        are not made; they are made at a later key, if at all, where nothing is lost."""
        return f"{sizes.format(a=a, b=b)} and least({a}_n - {a}_pos, {b}_n - {b}_pos) >= {similarity / (1 + similarity)} * ({a}_n + {b}_n) - 1e-9"

    near = golay_met(prints.select("node", "n", F.col(WIDE[0]).alias("print")), staged)
    roots = similar_components(near, prints_near, prints, sets_of, similarity, staged, "golay")
    roots = similar_components(prefix_met(printed, staged), within_reach, prints, sets_of, similarity, staged, "prefix", roots)
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(F.min("least").alias("first")).select("first.*")
    first = first.select(F.expr("coalesce(doc_id, 0)").alias("id"), F.expr("doc_id is null").alias("no_id"), "k1", "k2")
    copies = Window.partitionBy(*ROW_KEY).orderBy(F.xxhash64("row"))
    kept = rows.join(first.hint("merge"), ROW_KEY).withColumn("copy", F.row_number().over(copies))
    return kept.where("copy = 1").select("row.*")
