"""From raw documents to packed training sequences: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenrec.llm import decontaminate, packing, pii, quality, simhash
from lumenrec.llm.common import materialize, read


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    return simhash.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than traces of benchmark items."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", drop_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("PII", mask_personal),
    ("best-fit packing", pack_sequences),
]

#: No stage but the third can be put in SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
