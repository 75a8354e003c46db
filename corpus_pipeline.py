"""Corpus pipeline: documents through five stages to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. Every stage but the last returns the columns of ``documents``:

1. quality_classifier: documents that the resampling classifier rejects go.
2. line_dedup: lines with an earlier similar line are taken out of the texts
   (``n_chars`` follows); a document whose lines all go stays with an empty text.
3. simhash_dedup: one document of each group of near copies stays.
4. source_mixing: documents are repeated or left out so that sources meet
   their target words.
5. best_fit_packing: token pieces and their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendwise.llm import best_fit, line_dedup, mixing, quality_classifier, simhash
from lendwise.llm.common import fresh_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit.pack(docs)


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: No stage can be expressed in DuckDB (hash noise, tokenizer, XXH64); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and
    read again as the documents of the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
