"""Ranks and running totals for groups of any size.

A window ordered over one huge group runs in one task. Here rows are first collapsed to
one row per distinct value (map-side combine absorbs hot values), the values are cut into
buckets by a fixed increasing function, bucket totals are accumulated (few rows), and the
ordered window only runs inside a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import cut_lineage

# Buckets per e-fold of the value; about 0.1 % relative width.
_STEPS = 1024


def value_bucket(x: Column) -> Column:
    """Non-decreasing map of a double to a bucket number (log-linear, both signs).

    The sign is kept apart: for large negative numbers the logarithm within asinh would cancel.
    """
    x = x.cast("double")
    size = F.floor(F.asinh(F.abs(x) * 1e6) * _STEPS)
    return F.when(x < 0, -size).otherwise(size)


def running_totals(
    df: DataFrame, by: Sequence[str], value: str, measures: dict[str, Column]
) -> DataFrame:
    """One row per (by, value) with each measure and its total over smaller values.

    Output columns: ``by``, ``value``, ``m`` and ``m_below`` for every measure ``m``.
    """
    by = list(by)
    names = list(measures)
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(*[F.sum(c).alias(m) for m, c in measures.items()])
        .withColumn("_bucket", value_bucket(F.col(value)))
    )
    buckets = distinct.groupBy(*by, "_bucket").agg(*[F.sum(m).alias(f"_s_{m}") for m in names])
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_s_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in names]
    )
    inside = (
        Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        distinct.join(offsets, [*by, "_bucket"])
        .withColumns(
            {
                f"{m}_below": F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))
                for m in names
            }
        )
        .select(*by, value, *names, *[f"{m}_below" for m in names])
    )


def add_rank(
    df: DataFrame,
    value: str,
    outputs: dict[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ranks of ``value`` among the non-null rows of ``by``.

    ``outputs`` maps a kind to a column name; kinds are ``min``, ``average`` (treatment of
    ties) and ``min_pct``, ``average_pct`` (the same in percent of the group). All kinds
    come from one pass. The input is written once first: ranks are joined back by value, and
    a floating-point sum computed twice may differ in its last digit.
    """
    keys = list(by) or ["_all"]
    work = df if by else df.withColumn("_all", F.lit(0))
    signed = -F.col(value) if descending else F.col(value)
    work = cut_lineage(work.withColumn("_v", signed.cast("double")))
    totals = running_totals(work, keys, "_v", {"_cnt": F.lit(1)})
    size = totals.groupBy(*keys).agg(F.sum("_cnt").alias("_size"))
    kinds = {
        "min": F.col("_cnt_below") + 1.0,
        "average": F.col("_cnt_below") + (F.col("_cnt") + 1) / 2.0,
    }
    kinds |= {f"{k}_pct": c / F.col("_size") * 100.0 for k, c in list(kinds.items())}
    ranked = totals.join(size, keys).select(
        *keys, "_v", *[kinds[kind].alias(name) for kind, name in outputs.items()]
    )
    joined = work.join(ranked, [*keys, "_v"], "left").drop("_v")
    return joined if by else joined.drop("_all")


def auc_by(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """Area under the ROC curve per group by average ranks; null when only one class is present."""
    pos = (F.col(label) == 1).cast("long")
    totals = running_totals(df, by, score, {"_pos": pos, "_neg": 1 - pos})
    wins = F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0))
    pairs = F.sum("_pos") * F.sum("_neg")
    return totals.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0))).alias("auc"))
