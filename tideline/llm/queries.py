"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm.alignment import alignment_digests
from tideline.llm.bpe import encoded_digests
from tideline.llm.frames import table
from tideline.llm.neighbours import nearest_neighbours
from tideline.llm.packing import pack_documents
from tideline.llm.pii import pii_digest
from tideline.llm.probminhash import near_duplicate_classes
from tideline.llm.quality import quality_verdicts
from tideline.llm.secrets import secrets_digest
from tideline.llm.spelling import spelling_variants
from tideline.llm.token_counts import token_counts
from tideline.llm.token_store import stored_digests
from tideline.llm.toxicity import toxicity_scores
from tideline.llm.url_filters import RULES, judge_urls
from tideline.session import prepare

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(prepare(spark), sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(prepare(spark), sf_dir, "pages"), RULES)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(spark), sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return toxicity_scores(docs, table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(prepare(spark), sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(prepare(spark), sf_dir, "documents"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(prepare(spark), sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(prepare(spark), sf_dir, "documents"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_digests(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return alignment_digests(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_url_filters": op3_url_filters,
    "op4_neighbours": op4_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_bpe": op8_bpe,
    "op9_secrets": op9_secrets,
    "op10_probminhash": op10_probminhash,
    "op11_spelling": op11_spelling,
    "op12_token_store": op12_token_store,
    "op13_alignment": op13_alignment,
}
