"""A corpus from raw documents in five stages, each written as Parquet and read again by the next.

Language ID drops what it rejects, exact and near copies leave one document of each group, benchmark decontamination drops
contaminated documents, and the rest is encoded as BPE ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from sparkmart.llm.common import prepare, table
from sparkmart.llm.queries import BYTE_BPE
from sparkmart.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    return bpe.encoding_digests(docs, BYTE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: Language ID and BPE have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written below the checkpoint folder and read again."""
    prepare(spark)
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
