"""The corpus pipeline: documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import new_path, table
from barloom.llm.exact_dedup import drop_copies
from barloom.llm.near_dedup import drop_near_copies
from barloom.llm.packing import pack
from barloom.llm.quality import drop_low_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, fitted on this corpus and its labels."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest id."""
    return drop_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids, with the ids."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: A fitted classifier and a tokenizer have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again by the next.

    An empty table passes through all stages; what nulls and ties do is said by each operator.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
