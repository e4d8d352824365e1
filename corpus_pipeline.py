"""From raw documents to packed sequences, in five stages.

Each stage takes what its predecessor kept, with the columns of ``documents``;
the last returns the packed pieces. A stage is fitted on its own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martwright.llm import exact_dedup, near_dedup, packing, pii, quality
from martwright.llm.common import table, written

END_ID = 1
NEAR_PERCENT = 80
# Fewer than the packing operator's own number: its workers hold what earlier stages left them.
PIECES_HELD = 40_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at ``NEAR_PERCENT``, the one with the smallest id."""
    return near_dedup.keep_one(docs, percent=NEAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return pii.mask(docs, pii.fit(docs), length_column="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, pieces_held=PIECES_HELD)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near-dedup", near_copies),
    ("personal data", personal_data),
    ("packing", packed),
]

# SQL can't score, tag or tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
