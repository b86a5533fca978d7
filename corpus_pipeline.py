"""From raw documents to packed training sequences, in five stages that each hand on a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, table
from ledgerline.llm.langid import UNKNOWN, accept
from ledgerline.llm.line_dedup import dedup_lines
from ledgerline.llm.mixing import mixed_documents
from ledgerline.llm.near_text import near_duplicates
from ledgerline.llm.packing import best_fit
from ledgerline.llm.tokens import public_path

#: A text whose main language has a smaller share is rejected as mixed.
LEAST_SHARE = 0.5
#: SQL states neither the mixture inference nor the tokenizer; tests compare stages with brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where there is such a column, as the length of the text that is left."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts of no main language."""
    return accept(docs, lambda lang, score: (lang != UNKNOWN) & (score >= LEAST_SHARE))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes blocks of lines that an earlier document holds; a document of which no word is left goes."""
    left = dedup_lines(docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    left = left.toDF(*names, "n_lines", "lines_cut", "words_cut")
    text = F.col(names[docs.columns.index("text")])
    gone = (F.col("lines_cut") > 0) & (F.length(F.trim(text, F.lit(" \t\n\u000b\f\r"))) == 0)
    return _counted(left.where(~gone).select(*names).toDF(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates, by five words and a similarity of 0.8."""
    kept = near_duplicates(docs, width=5, percent=80).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    found = docs.join(kept, "doc_id", "left_semi")
    # Repeated rows are copies as well; they lie in one partition already.
    return found.dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes words of each source up to its target; a document taken in two turns is there twice."""
    return _counted(mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of all texts into sequences of at most 2,048."""
    return best_fit(docs, public_path("word_bpe_49k.json"), capacity=2048, separator=0)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
