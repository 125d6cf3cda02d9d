"""The corpus pipeline: quality rules, line dedup, near-duplicates, benchmark decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludoshelf.llm.common import stage
from ludoshelf.llm.decontaminate import clean
from ludoshelf.llm.line_dedup import dedup_lines
from ludoshelf.llm.mixing import mix
from ludoshelf.llm.quality import keep
from ludoshelf.llm.simhash import representatives


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep(docs)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of three-line windows that stood earlier; n_chars follows the text."""
    shorter = dedup_lines(docs)
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return shorter.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return representatives(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mix(docs).documents


STAGES = [
    ("quality rules", good),
    ("line dedup", lines_once),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mixed),
]
#: Robust estimates, fingerprints and seeded draws are beyond SQL; tests/llm compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next one reads it."""
    docs, staged = spark.read.parquet(f"{sf_dir}/documents.parquet"), stage(spark)
    for k, (_, function) in enumerate(STAGES):
        docs = staged(function(spark, docs, sf_dir), f"stage_{k}")
    return docs
