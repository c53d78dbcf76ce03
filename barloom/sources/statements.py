"""Quarterly statements: nested tables to long facts, features and availability dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import change_pct, ordered, ratio
from barloom.functions.text import parse_number, parse_period_end, plain_label

# Reporting lag in days, ordinary quarters and the fourth quarter.
QUARTER_LAG = 45
FOURTH_QUARTER_LAG = 75


def available_date(period_end: Column) -> Column:
    lag = F.when(F.quarter(period_end) == 4, FOURTH_QUARTER_LAG).otherwise(QUARTER_LAG)
    return F.date_add(period_end, lag)


def statement_facts(tables: DataFrame, aliases: DataFrame) -> DataFrame:
    """Long facts from rows ``(ticker, period_labels, date_ranges, rows[{label, values[]}])``.

    Values are matched to periods by position. ``aliases`` maps a plain label to a field and
    a priority; of several labels of one field the best priority wins.
    """
    exploded = tables.select("ticker", "period_labels", "date_ranges", F.explode("rows").alias("r"))
    cells = exploded.select(
        "ticker",
        plain_label(F.col("r.label")).alias("label"),
        F.posexplode("r.values").alias("pos", "text"),
        "period_labels",
        "date_ranges",
    ).select(
        "ticker",
        "label",
        parse_period_end(F.get("period_labels", F.col("pos")), F.get("date_ranges", F.col("pos"))).alias("period_end"),
        parse_number(F.col("text")).alias("value"),
    )
    return (
        cells.join(aliases, "label")
        .groupBy("ticker", "field", "period_end")
        .agg(F.min_by("value", "priority").alias("value"))
        .withColumn("available_date", available_date(F.col("period_end")))
    )


def statement_features(facts: DataFrame, fields: list[str]) -> DataFrame:
    """One row per period: the fields, changes against 1 and 4 periods before, revenue ratios."""
    wide = facts.groupBy("ticker", "period_end", "available_date").pivot("field", fields).agg(F.first("value"))
    w = ordered("ticker", "period_end")
    out = {}
    for f in fields:
        out[f"{f}_qoq_pct"] = change_pct(f, w, 1)
        out[f"{f}_yoy_pct"] = change_pct(f, w, 4)
    for f in fields:
        if f != "revenue" and "revenue" in fields:
            out[f"{f}_to_revenue"] = ratio(f, "revenue")
    return wide.withColumns(out)


def fundamental_ratios(df: DataFrame) -> DataFrame:
    """PE, PB and ROE from price, earnings and book value per share; zero divisors give null."""
    return df.withColumns(
        {
            "pe": ratio("price", "eps"),
            "pb": ratio("price", "bvps"),
            "roe": ratio("eps", "bvps") * 100.0,
        }
    )


def asof_backward(
    left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, block: str = "year"
) -> DataFrame:
    """Each left row with the last right row at or before it.

    Both sides are stacked and sorted; the last right row seen so far is carried forward, so
    no candidate pairs are formed. Histories are cut into time blocks, so that a key with
    very many rows spreads over tasks: the last right row of every block is passed on to the
    later blocks (one row per key and block), and each block starts from it.
    """
    fields = [c for c in right.columns if c not in (key, right_at)]
    own = [c for c in left.columns if c not in (key, left_at)]
    hit = F.struct(F.col(right_at).alias("_matched_at"), *fields)

    def in_block(at: str) -> Column:
        return F.trunc(at, block)

    marked_left = left.select(
        key,
        in_block(left_at).alias("_block"),
        F.col(left_at).alias("_at"),
        F.lit(2).alias("_side"),
        F.struct(*own).alias("_own") if own else F.lit(0).alias("_own"),
    )
    marked_right = right.select(
        key, in_block(right_at).alias("_block"), F.col(right_at).alias("_at"), F.lit(1).alias("_side"), hit.alias("_hit")
    )
    closing = marked_right.groupBy(key, "_block").agg(F.max_by("_hit", "_at").alias("_hit"))
    blocks = marked_left.select(key, "_block").distinct().join(closing, [key, "_block"], "full")
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = blocks.withColumn("_hit", F.last("_hit", ignorenulls=True).over(earlier)).filter("_hit is not null")
    seeds = seeds.select(key, "_block", F.col("_hit._matched_at").alias("_at"), F.lit(0).alias("_side"), "_hit")
    stacked = marked_left.unionByName(marked_right, allowMissingColumns=True).unionByName(seeds, allowMissingColumns=True)
    w = Window.partitionBy(key, "_block").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = stacked.withColumn("_hit", F.last("_hit", ignorenulls=True).over(w)).filter("_side = 2")
    return carried.select(
        key,
        F.col("_at").alias(left_at),
        *[F.col(f"_own.{c}").alias(c) for c in own],
        F.col("_hit._matched_at").alias(f"matched_{right_at}"),
        *[F.col(f"_hit.{c}").alias(c) for c in fields],
    )
