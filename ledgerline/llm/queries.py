"""The registered queries of this folder and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import oracles
from ledgerline.llm.common import table
from ledgerline.llm.hard_negatives import hard_negatives
from ledgerline.llm.langid import identify
from ledgerline.llm.line_dedup import dedup_lines
from ledgerline.llm.lm import score_texts
from ledgerline.llm.mixing import mixed_counts
from ledgerline.llm.near_text import near_duplicates
from ledgerline.llm.near_vectors import near_vectors
from ledgerline.llm.packing import best_fit
from ledgerline.llm.periodic import digest, periodic_runs, planted
from ledgerline.llm.quality_model import quality_scores
from ledgerline.llm.quality_rules import judge
from ledgerline.llm.tokens import public_path, token_counts
from ledgerline.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": oracles.NEAR_VECTORS,
    "op6_quality_rules": oracles.quality(),
    "op7_minhash_near_dedup": oracles.NEAR_TEXTS,
    "op11_hard_negatives": oracles.HARD_NEGATIVES,
    "op12_periodic_runs": oracles.PERIODIC_RUNS,
}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_counts(table(spark, root, "documents"), public_path("byte_bpe_50k.json"), limit=512)


@query
def op3_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    return dedup_lines(table(spark, root, "documents").select("doc_id", "text"))


@query
def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity(table(spark, root, "documents"), table(spark, root, "labels"))


@query
def op5_lm_scores(spark: SparkSession, root: str) -> DataFrame:
    return score_texts(table(spark, root, "documents"))


@query
def op6_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return judge(table(spark, root, "documents")).drop("char_distance", "word_distance")


@query
def op1_embedding_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_vectors(table(spark, root, "embeddings"))


@query
def op7_minhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(table(spark, root, "documents"), width=4, percent=80)


@query
def op8_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return best_fit(table(spark, root, "documents"), public_path("word_bpe_49k.json"), capacity=2048, separator=0)


@query
def op9_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixed_counts(table(spark, root, "documents"))


@query
def op10_language_id(spark: SparkSession, root: str) -> DataFrame:
    return identify(table(spark, root, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, root, "embeddings").withColumn("label", label))


@query
def op12_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    return digest(periodic_runs(planted(table(spark, root, "documents")), min_length=6, min_powers=4))


@query
def op13_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    return quality_scores(table(spark, root, "documents"), table(spark, root, "labels"))
