"""Corpus cleaning pipeline: ordered stages over ``documents``, each written and reread.

Every stage takes the documents that its predecessor kept, with the columns of
``documents``; where a stage changes texts, ``n_chars`` follows. The last one
returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import line_dedup, near_dedup, packing, pii, quality_rules
from sensorweave.llm.common import read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rule or the learned rules reject."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of long runs of lines, and documents that were nothing else."""
    return _recounted(line_dedup.keep_first_copies(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of near-duplicates."""
    return near_dedup.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    return _recounted(pii.redact_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the tokenised documents in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each_group),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: The stages hold learned rules, sketches, parsers and a tokenizer: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
