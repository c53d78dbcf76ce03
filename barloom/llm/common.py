"""Registration and small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import cut_lineage, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

__all__ = ["QUERIES", "ORACLES", "register", "table", "cut_lineage", "new_path", "text_bytes", "filled"]


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def filled(text: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def text_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts; one number comes to the driver."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
