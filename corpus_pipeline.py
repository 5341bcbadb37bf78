"""Documents through five stages to packed training sequences.

Every stage takes nulls in any column, repeated rows, empty and very long texts, extra columns and an empty table; what it
makes of them is said with each. All but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.frames import kept_table, table
from tideline.llm.packing import pack_documents
from tideline.llm.probminhash import one_of_each
from tideline.llm.quality import with_quality
from tideline.llm.queries import WORD_BPE
from tideline.llm.secrets import without_secrets
from tideline.llm.toxicity import without_toxic
from tideline.session import prepare


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go. Null and empty texts have no features and the base rate's score."""
    return without_toxic(docs, table(prepare(spark), sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the outlier test reject go, null and empty texts among them."""
    return with_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that of the smallest id. Texts without words and rows without an id all stay."""
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced. Null texts stay null."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left and their places in sequences. A null or empty text is the end id alone."""
    return pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Learned scores, sketches and a genetic search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs
