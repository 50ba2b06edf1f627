"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import bpe, closeness, licenses, lines, neardup, negatives, packing, partitions, privacy, quality, substrings, topk, whitening
from ledgermill.llm.store import table


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.runs(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.report(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.search(table(spark, sf_dir, "embeddings"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label)


def op12_closeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closeness.links(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


REGISTRY = {
    "op1_lines": op1_lines,
    "op2_licenses": op2_licenses,
    "op3_privacy": op3_privacy,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_topk": op7_topk,
    "op8_neardup": op8_neardup,
    "op9_substrings": op9_substrings,
    "op10_neighbours": op10_neighbours,
    "op11_negatives": op11_negatives,
    "op12_closeness": op12_closeness,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {"op1_lines": lines.SQL, "op2_licenses": licenses.SQL, "op7_topk": topk.SQL, "op9_substrings": substrings.SQL, "op11_negatives": negatives.SQL, "op12_closeness": closeness.SQL}
