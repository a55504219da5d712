"""From raw documents to packed training sequences, one stored table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidencepanel.llm.common import stored
from evidencepanel.llm.exact_dedup import keep_one_copy
from evidencepanel.llm.near_dedup import keep_one_of_group
from evidencepanel.llm.packing import packed_pieces
from evidencepanel.llm.pii import redact
from evidencepanel.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality machine scores below 0.3 go."""
    return keep_good(docs, spark.read.parquet(f"{folder}/labels.parquet"), threshold=0.3)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the largest number stays."""
    return keep_one_copy(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies, the least number stays."""
    return keep_one_of_group(docs, percent=80)


def blank_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sequences of 2048 tokens: one row per piece of a document."""
    return packed_pieces(docs, window=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", blank_personal_data),
    ("packing", pack),
]

#: Hash shingles, learned scores and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again before the next."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
