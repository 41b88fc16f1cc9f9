"""From raw documents to token ids: five stages, each one of the operators.

Every stage works on all that the stage before it kept, written as Parquet to
the shared folder and read again. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmodel.llm.byte_bpe import byte_bpe
from billmodel.llm.common import table
from billmodel.llm.decontamination import without_leaks
from billmodel.llm.language_id import documents_language
from billmodel.llm.pii import mask_texts
from billmodel.llm.simhash_dedup import one_of_each
from billmodel.session import shared_folder

RANKS = "byte_bpe_multi_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language; the others go."""
    return documents_language(docs).filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each SimHash group (3-word
    shingles, at most 3 bits apart)."""
    return one_of_each(docs, shingle=3, bits=3)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of the five-word shingles of every
    benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    masked = mask_texts(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, as digests, and what they decode to."""
    out = byte_bpe(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("tokens", encode_tokens),
]

#: SQL cannot express the stages (trained models, byte-pair merges).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4()}"
    for n, (name, stage) in enumerate(STAGES):
        at = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
