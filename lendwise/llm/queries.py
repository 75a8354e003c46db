"""Queries of the training-data operators: each applies one operator, with
production parameters, to its whole table. SQL twins are in ``sql``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendwise.llm import (best_fit, centroids, chat_format, class_lm, divergence, exact_dedup, line_dedup, mixing, quality_classifier, quality_rules,
                          range_join, simhash, token_files)
from lendwise.llm.common import fresh_path, written
from lendwise.llm.sql import ORACLES, PROBE_ID, PROBE_TEXT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("failed_rule")  # its name depends on the sample's order


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), folder)
    return token_files.read_token_files(spark, folder)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).drop("text_hash")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(documents(spark, sf_dir))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.resample(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], turns.schema)
    return chat_format.read_back(written(chat_format.format_turns(turns.unionByName(probe)), "formatted")).drop("problem")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(documents(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(centroids.fit(table(spark, sf_dir, "embeddings")))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.near_groups(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1,
    "op2_exact_dedup": op2,
    "op3_token_files": op3,
    "op4_line_dedup": op4,
    "op5_simhash_dedup": op5,
    "op6_source_mixing": op6,
    "op7_lm_scoring": op7,
    "op8_quality_classifier": op8,
    "op9_chat_formatting": op9,
    "op10_best_fit_packing": op10,
    "op11_centroid_clustering": op11,
    "op12_source_divergence": op12,
    "op13_embedding_near_dedup": op13,
}

SQL = {name: sql for name, sql in ORACLES.items() if name in QUERIES}
