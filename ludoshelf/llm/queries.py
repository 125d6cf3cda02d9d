"""One query for each operator of this subpackage, with production parameters, over its whole table."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from ludoshelf.llm import line_dedup, url_filter



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.quality import assess

    return assess(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).documents


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.decontaminate import contaminations

    found = contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.pii import find

    return find(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.lm import score

    return score(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.fingerprints import edit_likeness

    return edit_likeness(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.alignment import align_tokenizers

    return align_tokenizers(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ludoshelf.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_lm_scores": op10_lm_scores,
    "op11_fingerprints": op11_fingerprints,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL = {"op2_url_filter": url_filter.SQL, "op6_line_dedup": line_dedup.SQL}
