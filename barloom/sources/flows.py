"""Foreign and proprietary order flow: entry mapping and horizon sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTRIES = (
    "array<struct<day:string,buy_shares:bigint,sell_shares:bigint,buy_value:double,sell_value:double>>"
)
BILLION = 1_000_000_000


def map_flow_entries(raw: DataFrame, payload: str, keys: Sequence[str]) -> DataFrame:
    """Flow rows from a JSON array column: net shares and values in billions, missing sides as 0."""
    rows = raw.select(*keys, F.inline(F.from_json(payload, ENTRIES)))
    zero = F.lit(0)
    buy, sell = F.coalesce("buy_shares", zero), F.coalesce("sell_shares", zero)
    buy_value, sell_value = F.coalesce("buy_value", F.lit(0.0)), F.coalesce("sell_value", F.lit(0.0))
    return rows.select(
        *keys,
        F.try_to_date("day", "dd/MM/yyyy").alias("date"),
        buy.alias("buy_shares"),
        sell.alias("sell_shares"),
        (buy_value / BILLION).alias("buy_billion"),
        (sell_value / BILLION).alias("sell_billion"),
        (buy - sell).alias("net_shares"),
        ((buy_value - sell_value) / BILLION).alias("net_billion"),
    )


def daily_flows(trades: DataFrame, is_member: Column, is_sell: Column) -> DataFrame:
    """Net shares and value per instrument and day of one class of trades."""
    side = F.when(is_sell, -1).otherwise(1)
    return (
        trades.filter(is_member)
        .groupBy("ticker", "date")
        .agg(
            F.sum(side * F.col("size")).alias("net_shares"),
            F.sum(side * F.col("size") * F.col("price")).alias("net_value"),
        )
    )


def last_n_sums(flows: DataFrame, horizons: Sequence[int] = (1, 5, 20), prefix: str = "") -> DataFrame:
    """Sums over each instrument's last N flow rows, all horizons in one pass, and its latest date."""
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    sums = []
    for n in horizons:
        inside = F.col("_rn") <= n
        sums += [
            F.sum(F.when(inside, F.col("net_shares"))).alias(f"{prefix}shares_{n}d"),
            F.sum(F.when(inside, F.col("net_value"))).alias(f"{prefix}value_{n}d"),
        ]
    return (
        flows.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= max(horizons))
        .groupBy("ticker")
        .agg(F.max("date").alias(f"{prefix}flow_date"), *sums)
    )
