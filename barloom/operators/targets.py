"""Forward labels: direct horizons, trade efficiency, cycles, touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import frames as R

MONTH_DAYS = 21


def horizon_targets(bars: DataFrame, horizons: int = 10) -> DataFrame:
    """One row per (instrument, date, horizon): open and close return and non-negative wicks to that day."""
    w = R.ordered("ticker")
    base = R.non_zero("close")

    def ahead(h: int) -> Column:
        return F.struct(
            F.lit(h).alias("horizon"),
            *[F.lead(c, h).over(w).alias(c) for c in ("date", "open", "high", "low", "close")],
        )

    rows = bars.select("ticker", "date", "open", "high", "low", "close").withColumn(
        "_f", F.array(*[ahead(h) for h in range(1, horizons + 1)])
    )
    rows = rows.select("ticker", "date", F.col("close").alias("base_close"), base.alias("_b"), F.explode("_f").alias("f"))
    top, bottom = F.greatest("f.open", "f.close"), F.least("f.open", "f.close")
    exists = F.col("f.close").isNotNull()
    return rows.select(
        "ticker",
        "date",
        "base_close",
        F.col("f.horizon").alias("horizon"),
        F.col("f.date").alias("forecast_date"),
        *[F.col(f"f.{c}").alias(f"actual_{c}") for c in ("open", "high", "low", "close")],
        ((F.col("f.open") / F.col("_b") - 1) * 100.0).alias("target_open"),
        ((F.col("f.close") / F.col("_b") - 1) * 100.0).alias("target_close"),
        F.when(exists, F.greatest((F.col("f.high") - top) / F.col("_b") * 100.0, F.lit(0.0))).alias("target_upper"),
        F.when(exists, F.greatest((bottom - F.col("f.low")) / F.col("_b") * 100.0, F.lit(0.0))).alias("target_lower"),
    )


def excursion_targets(bars: DataFrame, horizon: int, first_day: int = 1, prefix: str = "") -> DataFrame:
    """Highest gain with its first day, lowest loss and close return within ``horizon`` rows ahead.

    Extremes accept a shorter tail, the close return does not. ``first_day`` delays the gain
    (not the loss), as for sales allowed only after settlement.
    """
    w = R.ordered("ticker")
    c = R.non_zero("close")
    rows = bars.withColumn("_i", F.row_number().over(w))
    sale = w.rowsBetween(first_day, horizon)
    peak_row = F.max_by("_i", F.struct("high", -F.col("_i"))).over(sale)
    return rows.withColumns(
        {
            f"{prefix}peak": (F.max("high").over(sale) / c - 1) * 100.0,
            f"{prefix}peak_day": (peak_row - F.col("_i")).cast("double"),
            f"{prefix}drawdown": (F.min("low").over(w.rowsBetween(1, horizon)) / c - 1) * 100.0,
            f"{prefix}close_ret": (F.lead("close", horizon).over(w) / c - 1) * 100.0,
        }
    ).drop("_i")


def excursion_samples(bars: DataFrame, horizons: Sequence[int], first_day: int = 1) -> DataFrame:
    """The excursion targets of several horizons as rows; all windows share one sort."""
    rows = bars.select("ticker", "date", "close", "high", "low")
    for h in horizons:
        rows = excursion_targets(rows, h, first_day, prefix=f"h{h}_")
    names = ("peak", "peak_day", "drawdown", "close_ret")
    packed = F.array(
        *[F.struct(F.lit(h).alias("horizon"), *[F.col(f"h{h}_{n}").alias(n) for n in names]) for h in horizons]
    )
    return rows.select("ticker", "date", F.explode(packed).alias("x")).select("ticker", "date", "x.*")


def cycle_samples(bars: DataFrame, months: Sequence[int] = (1, 2, 3, 4, 5, 6), sell_delay: int = 3) -> DataFrame:
    rows = excursion_samples(bars, [m * MONTH_DAYS for m in months], sell_delay)
    return rows.withColumn("months", (F.col("horizon") / MONTH_DAYS).cast("int")).drop("close_ret")


# Touch horizons in days and entry depths in ATRs.
TOUCH_HORIZONS = (1, 5, 10)
TOUCH_DEPTHS = (0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0)


def touch_labels(bars: DataFrame) -> DataFrame:
    """1 when the lows of the next rows reach close minus depth times the mean-based ATR; no future counts 0."""
    from barloom.functions.smoothing import true_range
    from barloom.operators.panel import mean_atr

    w = R.ordered("ticker")
    rows = bars.select("ticker", "date", "close", "high", "low").withColumn("_tr", true_range(w))
    rows = rows.withColumns(
        {
            "atr14": mean_atr("_tr", w),
            **{f"_low{h}": R.forward_min("low", w, h) for h in TOUCH_HORIZONS},
        }
    ).filter("atr14 is not null")
    grid = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), F.lit(k).alias("depth"), F.col(f"_low{h}").alias("low"))
            for h in TOUCH_HORIZONS
            for k in TOUCH_DEPTHS
        ]
    )
    rows = rows.select("ticker", "date", "close", "atr14", F.explode(grid).alias("g"))
    entry = F.col("close") - F.col("atr14") * F.col("g.depth")
    return rows.select(
        "ticker",
        "date",
        F.col("g.horizon").alias("horizon"),
        F.col("g.depth").alias("depth"),
        (F.col("atr14") / R.non_zero("close") * 100.0).alias("atr_pct"),
        ((entry / R.non_zero("close") - 1) * 100.0).alias("entry_pct"),
        R.flag(F.col("g.low") <= entry).alias("touched"),
    )


def color_labels(targets: DataFrame, limit: float = 6.75) -> DataFrame:
    """GREEN, RED, CEILING and FLOOR labels of a horizon row; unknown outcomes stay null."""
    c = F.col("target_close")
    high = (F.col("actual_high") / R.non_zero("base_close") - 1) * 100.0
    low = (F.col("actual_low") / R.non_zero("base_close") - 1) * 100.0

    def label(cond: Column) -> Column:
        return F.when(c.isNotNull(), cond.cast("int"))

    return targets.withColumns(
        {
            "is_green": label(c > 0),
            "is_red": label(c < 0),
            "is_ceiling": label(high >= limit),
            "is_floor": label(low <= -limit),
        }
    )


def recent_dates(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the last ``n`` distinct dates. Only the distinct dates are sorted, not the rows."""
    dates = rows.select("date").distinct().orderBy(F.desc("date")).limit(n)
    return rows.join(dates, "date", "left_semi")


def recent_weight(horizon: Column, first: float = 0.75, last: float = 0.40, longest: int = 10) -> Column:
    """Weight of the recent-window variant, falling linearly with the horizon."""
    if longest <= 1:
        return F.lit(first)
    step = (first - last) / (longest - 1)
    return F.lit(first) - (R.clamp(horizon.cast("double"), 1.0, float(longest)) - 1) * step
