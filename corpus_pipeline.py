"""From raw documents to training sequences in five stages.

Each stage takes the documents that the one before it left, acts on its own
decision, and hands on the columns of ``documents``; the last returns the packed
pieces. Results between stages are Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.importance import keep_sample
from barline.llm.ngram_join import keep_one
from barline.llm.packing import pack
from barline.llm.pii import mask
from barline.llm.quality_rules import keep_good
from barline.llm.queries import table, vocabulary
from barline.llm.store import small_batches, staged
from barline.session import prepare


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling: drop documents unlike the labelled good ones."""
    return keep_sample(docs, table(small_batches(prepare(spark)), sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adaptive rules: drop documents beyond the fences of their language and source."""
    return keep_good(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: one document of each linked group stays."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts."""
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best two fit: the pieces of all documents, placed in sequences."""
    packed = pack(docs, vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Trained models, sketches and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
