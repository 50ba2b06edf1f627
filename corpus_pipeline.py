"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before has kept; all but the last return the
columns of documents. What a stage returns is written and read again before the next one starts, so a lost executor
costs the work of one stage at most. The operators define what nulls, empty texts and repeated rows give.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import lines, neardup, packing, privacy, quality
from ledgermill.llm.store import table, written


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated runs of lines."""
    return _counted(lines.without_repeats(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.representatives(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    return _counted(privacy.sanitised(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
