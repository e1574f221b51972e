"""A training-data pipeline over ``documents``: five stages, each one operator of ``roadloom.llm``.

Each stage is written as Parquet and read again before the next. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm import exact_dedup, near_copies, packing, quality_rules, secret_scan
from roadloom.llm.common import bound_batches, materialise, table
from roadloom.llm.queries import tokenizer_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, texts unchanged."""
    bound_batches(spark)
    return quality_rules.keep_documents(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.deduplicate(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (SimHash, then bands, all by a five-word Jaccard of 0.8 or more), the row with the smallest doc_id."""
    bound_batches(spark)
    return near_copies.deduplicate(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the values of live-looking secrets masked."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 token ids."""
    bound_batches(spark)
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), length=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

#: The stages by rules, fingerprints and tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
