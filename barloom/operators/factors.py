"""Macro factors: calendar fill, regimes, sensitivities and shocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import correlation, change_pct, full_std, non_zero, ordered


def fill_on_calendar(series: DataFrame, calendar: DataFrame, key: str = "factor") -> DataFrame:
    """Series on the trading calendar, last value carried; values on other days are lost.

    The calendar is collected into one array: it has one entry per trading day.
    """
    days = calendar.agg(F.collect_set("date").alias("days")).scalar()
    grid = series.select(key).distinct().select(key, F.explode(days).alias("date"))
    w = ordered(key).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(series, [key, "date"], "left").withColumn("value", F.last("value", ignorenulls=True).over(w))


def factor_returns(filled: DataFrame, key: str = "factor") -> DataFrame:
    w = ordered(key)
    rows = filled.withColumn("fret", F.col("value") / non_zero(F.lag("value").over(w)) - 1)
    return rows.withColumns(
        {
            "fret5": change_pct("value", w, 5),
            "fret20": change_pct("value", w, 20),
            "fvol20": full_std("fret", w, 20) * 100.0,
        }
    )


def factor_regime(returns: DataFrame) -> DataFrame:
    """Latest value, 5- and 20-day return and volatility per factor."""
    return returns.groupBy("factor").agg(
        *[F.max_by(c, "date").alias(c) for c in ("value", "fret5", "fret20", "fvol20")], F.max("date").alias("date")
    )


def pair_with_factors(bars: DataFrame, returns: DataFrame) -> DataFrame:
    """(instrument, factor, date) returns by an equi-join on the date; every pair is part of the result."""
    w = ordered("ticker")
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    c = F.col("close")
    assets = bars.select(
        "ticker",
        "date",
        (c / non_zero(F.lag(c).over(w)) - 1).alias("r"),
        (F.lead(c, 5).over(w) / non_zero(c) - 1).alias("fwd5"),
        (F.row_number().over(newest) - 1).alias("age"),
    )
    return assets.join(returns.select("date", "factor", "fret"), "date")


def sensitivities(pairs: DataFrame, regime: DataFrame) -> DataFrame:
    """Current correlation and beta over the last 20 and 60 rows (full frames) and factor alignment."""
    both = F.col("r").isNotNull() & F.col("fret").isNotNull()
    out = []
    for n in (20, 60):
        inside = both & (F.col("age") < n)
        r, f = F.when(inside, F.col("r")), F.when(inside, F.col("fret"))
        ready = F.count(F.when(inside, 1)) == n
        out += [
            F.when(ready, correlation(r, f)).alias(f"corr{n}"),
            F.when(ready, F.covar_samp(r, f) / non_zero(F.var_samp(f))).alias(f"beta{n}"),
        ]
    rows = pairs.groupBy("ticker", "factor").agg(*out)
    return rows.join(regime.select("factor", "fret20"), "factor").withColumn(
        "alignment20", F.col("corr60") * F.col("fret20")
    )


def factor_shocks(pairs: DataFrame, least: int = 10) -> DataFrame:
    """Outcomes on days when the factor moved beyond its own upper or lower decile.

    Each group has at most one row per trading day.
    """
    usable = pairs.filter("r is not null and fwd5 is not null and fret is not null")
    f = F.col("fret")
    limits = usable.groupBy("ticker", "factor").agg(
        F.when(F.count(F.when(f > 0, 1)) >= least, F.percentile(F.when(f > 0, f), 0.9)).alias("up_at"),
        F.when(F.count(F.when(f < 0, 1)) >= least, F.percentile(F.when(f < 0, f), 0.1)).alias("down_at"),
    )
    up, down = f >= F.col("up_at"), f <= F.col("down_at")
    return usable.join(limits, ["ticker", "factor"]).groupBy("ticker", "factor").agg(
        F.count(F.when(up, 1)).alias("up_shocks"),
        F.count(F.when(down, 1)).alias("down_shocks"),
        *[
            (F.avg(F.when(cond, F.col(c))) * 100).alias(f"{c}_on_{side}")
            for side, cond in (("up", up), ("down", down))
            for c in ("r", "fwd5")
        ],
    )


def rank_factors(sens: DataFrame) -> DataFrame:
    """Factors of each instrument by strength of the 60-row correlation."""
    order = Window.partitionBy("ticker").orderBy(
        F.abs("corr60").desc_nulls_last(), F.col("alignment20").desc_nulls_last(), "factor"
    )
    return sens.withColumn("factor_rank", F.row_number().over(order))
