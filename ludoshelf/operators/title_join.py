"""Best match of every title in a whole catalogue of names: a blocked similarity join with exact verification.

Two strings of similarity s or more differ by at most (1 - s) * n edits, n the longer length. An edit breaks at most q of the q-grams
of a string, so at most q * (1 - s) * length of its numbered grams are not in the other. With all grams in one order, rare ones first, both strings therefore
hold a common gram among their first q * (1 - s) * length + 1: these are the blocks. The first gram that two strings share also bounds how many
they can share at all, by what is left behind it in both; pairs below the number that they need end in the join. No pair is lost, and the edit
distance decides. A pair may meet in several blocks; it is scored there, so that only what is similar enough is shuffled on.

Titles are looked up in rounds of falling similarity. Long grams and few of them serve the first rounds; a title that has found a name
there can not find a better one later, so only the rest meets the short grams of the last round. A crowded block is cut on the side of the
names, and its titles go to every part. Equal strings are compared once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludoshelf.operators.matching import ACCEPT_FROM, variant_rows
from ludoshelf.sources.staging import Stage, in_place

#: Least similarity and gram length of every round; q * (1 - s) is at most 1.
ROUNDS = ((0.9, 4), (0.78, 3), (ACCEPT_FROM, 2))
CROWDED = 2_000  # names of a block that are held against its titles in one piece
SLACK = 1e-9


def _least_length(similarity: float, q: int) -> int:
    """The shortest string that keeps a gram of length ``q`` through all edits of this similarity."""
    n = 1
    while n - q + 1 <= q * (1 - similarity) * n + SLACK:
        n += 1
    return n


def grams(strings: DataFrame, similarity: float, q: int) -> DataFrame:
    """``gram`` (numbered, so that repeats count) of every row of ``strings`` (s, side), with ``keep``, how many of the rarest block it."""
    letters = F.length("s")
    rows = strings.where(letters >= q).select("side", "s", F.explode(F.sequence(F.lit(1), letters - (q - 1))).alias("at"))
    counted = rows.groupBy("side", "s", F.expr(f"substring(s, at, {q})").alias("piece")).agg(F.count("*").alias("n"))
    numbered = counted.select("side", "s", "piece", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("number"))
    keep = F.floor(letters * (q * (1 - similarity)) + SLACK) + 1
    return numbered.select("side", "s", F.concat_ws("#", F.lit(q), "number", "piece").alias("gram"), keep.cast("int").alias("keep"))


def blocks(strings: DataFrame, similarity: float, q: int, crowded: int) -> DataFrame:
    """``side``, ``s``, ``gram``, ``part``, ``left`` and ``need``: where the strings of both sides meet, how many grams a string has from there on, and how
    many of its grams a string that similar must hold."""
    rows = grams(strings, similarity, q)
    shortest = _least_length(similarity, q)
    if shortest > 1 and q == min(length for _, length in ROUNDS):
        # The last round has no later one for strings that may lose all grams: they, and what they can match, meet by single letters.
        few = strings.where(F.length("s") <= int((shortest - 1) / similarity + SLACK))
        rows = rows.unionByName(grams(few, similarity, 1))
    in_name = F.sum(F.when(F.col("side") == "name", 1).otherwise(0))
    spread = rows.groupBy("gram").agg(F.count("*").alias("n"), in_name.alias("names"))
    spread = spread.where("names > 0 and names < n")  # a gram of one side alone joins nothing, but keeps its place in the order
    order = Window.partitionBy("side", "s", F.substring_index("gram", "#", 1)).orderBy(F.coalesce("n", F.lit(1)), "gram")
    ranked = rows.join(spread, "gram", "left").withColumn("rank", F.row_number().over(order)).where("rank <= keep and n is not null")
    parts = F.ceil(F.col("names") / crowded)
    own = F.array(F.pmod(F.xxhash64("s"), parts))
    part = F.explode(F.when(F.col("side") == "name", own).otherwise(F.sequence(F.lit(0).cast("long"), parts - 1)))
    total = F.length("s") - F.substring_index("gram", "#", 1).cast("int") + 1
    return ranked.select("side", "s", "gram", part.alias("part"), (total - F.col("rank") + 1).alias("left"), (total - F.col("keep") + 1).alias("need"))


def nearest(titles: DataFrame, names: DataFrame, staged: Stage = in_place, rounds=ROUNDS, crowded: int = CROWDED) -> DataFrame:
    """``title``, ``name`` and ``similarity``: for each of the distinct strings ``titles`` (s) the most similar of the distinct strings ``names`` (s).

    Equal similarities are decided by the least name. Titles below the last round's similarity are left out. Case counts; null and empty strings match nothing.
    """
    tasks = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = titles.where("s != ''")
    known = names.where("s != ''")
    exact = asked.join(known, "s", "left_semi").select(F.col("s").alias("title"), F.col("s").alias("name"), F.lit(1.0).alias("similarity"))
    found = [staged(exact, "match_exact")]
    for number, (similarity, q) in enumerate(rounds):
        asked = asked.join(found[-1].select(F.col("title").alias("s")), "s", "left_anti")
        sure = asked if number == len(rounds) - 1 else asked.where(F.length("s") >= _least_length(similarity, q))
        both = sure.select("s", F.lit("title").alias("side")).unionByName(known.select("s", F.lit("name").alias("side")))
        placed = staged(blocks(both, similarity, q, crowded), f"match_blocks_{number}")
        left = placed.where("side = 'title'").select("gram", "part", F.col("s").alias("title"), F.col("left").alias("t_left"), F.col("need").alias("t_need"))
        right = placed.where("side = 'name'").select("gram", "part", F.col("s").alias("name"), F.col("left").alias("n_left"), F.col("need").alias("n_need"))
        left = left.repartition(tasks, "gram", "part")  # few bytes, much work: not to be coalesced into few tasks
        shorter, longer = F.least(F.length("title"), F.length("name")), F.greatest(F.length("title"), F.length("name"))
        enough = F.least("t_left", "n_left") >= F.greatest("t_need", "n_need")
        pairs = left.join(right, ["gram", "part"]).where((shorter >= longer * similarity - SLACK) & enough)
        scored = pairs.withColumn("similarity", 1 - F.levenshtein("title", "name") / longer).where(F.col("similarity") >= similarity)
        best = scored.groupBy("title").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "name")).alias("best"))
        found.append(staged(best.select("title", "best.name", (-F.col("best.minus")).alias("similarity")), f"match_found_{number}"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def catalogue_match(titles: DataFrame, names: DataFrame, key: str = "app_id", staged: Stage = in_place, crowded: int = CROWDED) -> DataFrame:
    """The best name of the catalogue per row of ``titles`` (key, title): key, title, variant_ord, name_id, name, similarity, exact.

    ``names`` has name_id and name. Every variant of a title (without symbols, without edition) is looked up, ignoring case; the highest similarity wins, then the first
    variant, the least name and the least name_id. Titles without a name of the accepted similarity are left out. Rows with equal
    titles are looked up once. Null titles and names match nothing.
    """
    # Equal keys keep their own titles; a title is known by its text.
    variants = variant_rows(titles.select("title").where("title is not null").distinct(), "title", "title").select("title", "variant_ord", F.lower("variant").alias("s"))
    variants = staged(variants, "match_variants")
    catalogue = names.where("name is not null").groupBy(F.lower("name").alias("s")).agg(F.min(F.struct("name", "name_id")).alias("first"))
    catalogue = staged(catalogue, "match_names")
    found = nearest(variants.select("s").distinct(), catalogue.select("s"), staged, crowded=crowded)
    named = variants.join(found.withColumnRenamed("title", "s").withColumnRenamed("name", "lower_name"), "s")
    order = F.struct((-F.col("similarity")).alias("minus"), "variant_ord", "lower_name")
    best = named.groupBy("title").agg(F.min(order).alias("best"))
    full = best.join(catalogue.select(F.col("s").alias("lower_name"), "first"), F.col("best.lower_name") == F.col("lower_name"))
    return titles.join(full, "title").select(
        key, "title", "best.variant_ord", "first.name_id", "first.name", (-F.col("best.minus")).alias("similarity"), (F.col("best.minus") == -1).alias("exact")
    )
