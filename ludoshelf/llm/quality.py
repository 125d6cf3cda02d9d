"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Each document has a vector of transformed statistics. Per (lang, source) the mean and covariance of the subset with the least
covariance determinant are estimated: from two deterministic starts, concentration steps take the vectors nearest to
the current estimate until the determinant settles. Documents far away in Mahalanobis distance are rejected. Every step
is an aggregation over all vectors; no group is gathered.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludoshelf.llm.common import map_rows, stage
from ludoshelf.llm.line_dedup import same_row, text_key
from ludoshelf.sources.staging import Staging

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SYMBOLS = re.compile(r"[#*$%&|<>]+")
BLANK = " \t\n\v\f\r"
#: The transformed statistics and the standard deviation that is added to what a group shows. It keeps a group
#: whose documents are all alike in a statistic from rejecting the first small difference.
FEATURES = (
    ("ln(n_words)", 1.0),
    ("word_chars / n_words", 0.5),
    ("ln(1 + n_symbols / n_words)", 0.03),
    ("sqrt(n_dup_lines / n_lines)", 0.2),
    ("sqrt(n_repeat_words / n_words)", 0.2),
)
D = len(FEATURES)
TRIANGLE = [(i, j) for i in range(D) for j in range(i, D)]
SUBSET = 0.75  # share of a group's vectors that the estimate rests on
TAIL = 1e-9  # share of a normal group's documents beyond the cut-off
PRIOR = 50.0  # weight, in vectors, of the estimate over all groups in a group's own
STEPS = 8
SALTS = 32  # parts of a group in joins: a language and source may hold a third of all rows


def statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the number of lines with a word; zeros for null."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANK))
    symbols = sum(len(m) for m in SYMBOLS.findall(text))
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    repeated = 0
    if n >= 3:
        threes = list(zip(words, words[1:], words[2:], strict=False))
        seen, twice = set(), set()
        for three in threes:
            (twice if three in seen else seen).add(three)
        if twice:
            last = -1
            for i, three in enumerate(threes):
                if three in twice:
                    repeated += i + 2 - max(last, i - 1)
                    last = i + 2
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def chi2_quantile(p: float, d: int) -> float:
    """Wilson-Hilferty."""
    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(p) * math.sqrt(2 / (9 * d))) ** 3


def chi2_share(x: float, d: int) -> float:
    return NormalDist().cdf(((x / d) ** (1 / 3) - 1 + 2 / (9 * d)) / math.sqrt(2 / (9 * d)))


#: The nearest vectors spread less than all; this makes their covariance that of a normal group.
CONSISTENCY = SUBSET / chi2_share(chi2_quantile(SUBSET, D), D + 2)


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``mu`` under the precision ``p`` (its upper triangle)."""
    terms = [f"{1 if i == j else 2} * p[{k}] * (x[{i}] - mu[{i}]) * (x[{j}] - mu[{j}])" for k, (i, j) in enumerate(TRIANGLE)]
    return F.expr(" + ".join(terms))


def _precision(moments: DataFrame, scale: float) -> DataFrame:
    """``mu``, ``cov``, ``p`` and ``logdet`` for rows with mean ``mu`` and covariance ``cov`` (upper triangle); other columns stay."""
    names = moments.columns
    floor = np.diag([s**2 for _, s in FEATURES])
    upper = tuple(np.array(TRIANGLE).T)

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            given = np.array(batch.column(names.index("cov")).to_pylist(), float).reshape(rows, len(TRIANGLE))
            cov = np.zeros((rows, D, D))
            cov[:, upper[0], upper[1]] = given
            cov[:, upper[1], upper[0]] = given
            cov = cov * scale + floor
            precision = np.linalg.inv(cov)[:, upper[0], upper[1]]
            columns = dict(zip(names, batch.columns, strict=True))
            columns["p"] = pa.array(list(precision), pa.list_(pa.float64()))
            columns["logdet"] = pa.array(np.linalg.slogdet(cov)[1])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in moments.schema.fields)
    return moments.mapInArrow(run, f"{kinds}, p array<double>, logdet double")


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    sums = [F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(D)]
    products = [F.covar_pop(F.col("x")[i], F.col("x")[j]).alias(f"c{i}{j}") for i, j in TRIANGLE]
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)
    return out.select(*keys, "n", F.array(*[f"m{i}" for i in range(D)]).alias("mu"), F.array(*[f"c{i}{j}" for i, j in TRIANGLE]).alias("cov"))


def _beside(vectors: DataFrame, of_groups: DataFrame, *keys: str) -> DataFrame:
    """Vectors with a row of their group; that row is there once per salt, so a large group's vectors spread over tasks."""
    salted = of_groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return vectors.join(salted, ["grp", "salt", *keys])


def estimates(vectors: DataFrame, staged: Staging, steps: int = STEPS) -> DataFrame:
    """``mu`` and ``p`` per ``grp`` for ``vectors`` (grp, x), each distinct vector of a group counting once."""
    vectors = staged(vectors.groupBy("grp", *[F.col("x")[i].alias(f"x{i}") for i in range(D)]).agg(F.lit(1)).select("grp", F.array(*[f"x{i}" for i in range(D)]).alias("x")), "quality_vectors")
    vectors = vectors.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int"))
    middle = vectors.groupBy("grp").agg(F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 1000) for i in range(D)]).alias("mu"))
    away = _beside(vectors, middle)
    spread = away.groupBy("grp", "mu").agg(*[F.percentile_approx(F.abs(F.col("x")[i] - F.col("mu")[i]), 0.5, 1000).alias(f"s{i}") for i in range(D)])
    spread = spread.select("grp", "mu", F.array(*[F.greatest(F.col(f"s{i}") * 1.4826, F.lit(s)) for i, (_, s) in enumerate(FEATURES)]).alias("s"))
    spread = staged(spread, "quality_spread")
    # First start: the medians with the spreads. Second: the medians with the covariance of directions, as spreads.
    plain = F.array(*[F.col("s")[i] ** 2 if i == j else F.lit(0.0) for i, j in TRIANGLE])
    z = F.zip_with(F.zip_with("x", "mu", lambda a, b: a - b), "s", lambda a, b: a / b)
    length = F.sqrt(F.aggregate("z", F.lit(1e-12), lambda a, v: a + v * v))
    signs = _beside(vectors, spread).withColumn("z", z).withColumn("z", F.transform("z", lambda v: v / length))
    turned = signs.groupBy("grp", "mu", "s").agg(*[F.avg(F.col("z")[i] * F.col("z")[j]).alias(f"c{i}{j}") for i, j in TRIANGLE])
    turned = turned.select("grp", "mu", F.array(*[F.col(f"c{i}{j}") * D * F.col("s")[i] * F.col("s")[j] for i, j in TRIANGLE]).alias("cov"))
    starts = spread.select("grp", F.lit(0).alias("start"), "mu", plain.alias("cov")).unionByName(turned.select("grp", F.lit(1).alias("start"), "mu", "cov"))
    now = staged(_precision(starts, 1.0), "quality_start")
    before = math.inf
    for step in range(steps):
        # The planner may broadcast the estimates where their written size is below its limit.
        far = _beside(vectors, now.select("grp", "start", "mu", "p")).select("grp", "salt", "start", "x", _distance().alias("d2"))
        most = far.groupBy("grp", "start").agg(F.percentile_approx("d2", SUBSET, 1000).alias("most"))
        near = _beside(far, most, "start").where("d2 <= most")
        now = staged(_precision(_moments(near, "grp", "start"), CONSISTENCY), f"quality_step_{step}")
        total = now.agg(F.sum("logdet")).first()[0] or 0.0
        if abs(before - total) < 1e-3 * now.count():
            break
        before = total
    best = now.groupBy("grp").agg(F.min_by(F.struct("n", "mu", "cov"), F.struct("logdet", "start")).alias("b")).select("grp", "b.*")
    best = staged(best, "quality_best")
    # Small groups lean on the estimate over all groups, in proportion to what they have themselves.
    everything = Window.partitionBy()  # over the groups' estimates, a row per group
    n = F.sum("n").over(everything)
    mean = [F.sum(F.col("n") * F.col("mu")[i]).over(everything) / n for i in range(D)]
    leaning = best.select("*", F.array(*mean).alias("mu0"))
    between = [F.sum(F.col("n") * (F.col("cov")[k] + (F.col("mu")[i] - F.col("mu0")[i]) * (F.col("mu")[j] - F.col("mu0")[j]))).over(everything) / n for k, (i, j) in enumerate(TRIANGLE)]
    leaning = leaning.select("*", F.array(*between).alias("cov0"))
    own = F.col("n") / (F.col("n") + PRIOR)
    mixed = leaning.select("grp", *[F.zip_with(a, b, lambda u, v: own * u + (1 - own) * v).alias(a) for a, b in (("mu", "mu0"), ("cov", "cov0"))])
    return staged(_precision(mixed, CONSISTENCY).select("grp", "mu", "p"), "quality_estimates")


def assess(docs: DataFrame, tail: float = TAIL, staged: Staging | None = None) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, lang, source): the statistics, base_failed, kept and distance2.

    Null, empty and blank texts have no words and fail the base rule. Documents that fail it are not part of the
    estimates and have a null distance2. Null languages and sources are values of their own. Repeated rows are judged alike, and
    exact copies count once in the estimates, so a large group of copies cannot pass for the normal case. Other columns are ignored.
    """
    staged = staged or stage(docs.sparkSession)
    judged = _judge(docs, tail, staged)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*columns, "kept", "distance2")


def keep(docs: DataFrame, tail: float = TAIL, staged: Staging | None = None) -> DataFrame:
    """The rows of ``docs``, as they are, that are kept."""
    judged = _judge(docs, tail, staged or stage(docs.sparkSession)).where("kept").select("doc_id", "k1", "k2", "grp").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text").cast("string")), _group().alias("grp"))
    same = same_row("d", "j") & F.expr("d.grp = j.grp")
    return rows.alias("d").join(judged.alias("j"), same, "left_semi").select("row.*")


def _group() -> Column:
    return F.to_json(F.struct(F.col("lang").cast("string"), F.col("source").cast("string")), {"ignoreNullFields": "false"})


def _judge(docs: DataFrame, tail: float, staged: Staging) -> DataFrame:
    """The statistics of every row with its key (doc_id, k1, k2, grp), distance2 and kept."""
    schema = "doc_id long, k1 long, k2 long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long"), *text_key(text), _group(), text)
    counted = map_rows(narrow, lambda: lambda doc_id, k1, k2, grp, text: (doc_id, k1, k2, grp, *statistics(text)), schema)
    failed = F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")
    x = F.when(~failed, F.array(*[F.expr(f).cast("double") for f, _ in FEATURES]))
    counted = staged(counted.withColumns({"base_failed": failed, "x": x}), "quality_statistics")
    model = estimates(counted.where("x is not null").select("grp", "x"), staged)
    judged = counted.join(model, "grp", "left").withColumn("distance2", _distance())
    fits = F.coalesce(F.col("distance2") <= chi2_quantile(1 - tail, D), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & fits)
