"""Line dedup by overlapping three-line windows.

Three consecutive lines that hold words make a window. A window that stood earlier anywhere (by doc_id, then by
position) is removed: the positions that later occurrences cover are merged, and those lines go. Blank lines are no
part of a window and stay. Only hashes and positions are shuffled until the last join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def once(column: Column) -> Column:
    """A column computed once a row: a one-row generate, which later expressions read but cannot pull apart."""
    return F.explode(F.array(column))


def text_key(text: Column) -> list[Column]:
    """128 bits of a text; rows with the same doc_id and text are one document."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def same_row(a: str, b: str) -> Column:
    return F.expr(f"{a}.doc_id <=> {b}.doc_id and {a}.k1 = {b}.k1 and {a}.k2 = {b}.k2")


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, h1, h2 (hashes of a window) and ``lines`` (positions of its lines), a row per window."""
    lines = "transform(split(text, '\\n'), (x, i) -> if(x rlike '[^\\\\x20\\\\x09-\\\\x0D]', named_struct('i', i, 'a', xxhash64(x), 'b', xxhash64(1, x)), null))"
    worded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text").cast("string")), once(F.expr(f"filter({lines}, x -> x is not null)")).alias("l")
    )
    of = ", ".join(f"l[k + {n}].{{0}}" for n in range(WINDOW))
    made = (
        f"transform(sequence(0, size(l) - {WINDOW}), k -> named_struct('h1', xxhash64({of.format('a')}), 'h2', xxhash64({of.format('b')}), 'lines', array({of.format('i')})))"
    )
    rows = worded.where(f"size(l) >= {WINDOW}").select("doc_id", "k1", "k2", F.explode(F.expr(made)).alias("w"))
    return rows.select("doc_id", "k1", "k2", "w.h1", "w.h2", "w.lines")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with shortened texts, and n_lines and n_removed (long).

    A document that is only repeats keeps its row with the text that is left, "" at the least; a null text stays null
    with 0 lines. Rows alike in doc_id and text are one document and are treated alike. A null doc_id comes before
    all others. Texts with fewer than three worded lines stay as they are.
    """
    found = windows(docs)
    place = F.struct("doc_id", "k1", "k2", F.col("lines")[0].alias("at"))
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    gone = later.select("doc_id", "k1", "k2", F.explode("lines").alias("at")).groupBy("doc_id", "k1", "k2").agg(F.collect_set("at").alias("gone"))

    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text").cast("string")))
    cut = rows.alias("d").join(gone.alias("g"), same_row("d", "g"), "left").select("row", "gone")
    text = F.col("row.text").cast("string")
    split = F.split(text, "\n")
    cut = cut.withColumn("lines", once(F.when(F.col("gone").isNotNull(), split)))
    kept = F.expr("array_except(sequence(0, size(lines) - 1), gone)")
    cut = cut.withColumn("kept", once(F.when(F.col("gone").isNotNull(), kept)))
    short = F.expr("array_join(transform(kept, i -> lines[i]), '\\n')")
    left = F.when(F.col("gone").isNull(), text).otherwise(short)
    n_lines = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    n_removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    n_removed = F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(n_removed)
    columns = [left.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    own = {"n_lines": n_lines, "n_removed": n_removed}
    return cut.select(*[c for c, name in zip(columns, docs.columns, strict=True) if name not in own], *[v.alias(k) for k, v in own.items()])


SQL = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
), follow AS (
    SELECT doc_id, pos, line, lead(line, 1) OVER w AS line1, lead(line, 2) OVER w AS line2, lead(pos, 1) OVER w AS pos1, lead(pos, 2) OVER w AS pos2
    FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY line, line1, line2 ORDER BY doc_id, pos) AS n FROM follow WHERE pos2 IS NOT NULL
), gone AS (
    SELECT doc_id, pos FROM ranked WHERE n > 1 UNION SELECT doc_id, pos1 FROM ranked WHERE n > 1 UNION SELECT doc_id, pos2 FROM ranked WHERE n > 1
), kept AS (
    SELECT s.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY s.pos) AS text
    FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos GROUP BY s.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
    coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
