"""The corpus pipeline: quality filter, near-duplicate removal, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result to the shared folder
and reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomleaf.llm import packing, quality, simhash, substring
from fathomleaf.llm._shared import staged, table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    return simhash.keep_one(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines, sentences and runs of short lines that an earlier document has go; ``n_chars`` follows the text. Documents left empty stay out."""
    cut = substring.clean(docs, every=True).filter((F.col("text") != "") | (F.size("spans_") == 0))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row a piece."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
