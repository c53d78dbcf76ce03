"""The 129-column daily feature sample: candles, trend, states, weekly context, lags.

Columns of the instrument start with ``t_``, of the index ``i_``, of the peer index ``p_``.
Everything after the join on the date is windows by instrument, so the sample costs one
shuffle of the bars whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import frames as R

FIELDS = ("open", "high", "low", "close", "volume")
LAGS = (1, 2, 3)


def join_series(bars: DataFrame, index: DataFrame, peer: DataFrame | None = None) -> DataFrame:
    """Instrument bars on the index's dates (inner), optionally with a peer index (left)."""
    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select("date", *[F.col(f).alias(f"{prefix}_{f}") for f in FIELDS])

    own = bars.select("ticker", "sector", "date", *[F.col(f).alias(f"t_{f}") for f in FIELDS])
    rows = own.join(named(index, "i"), "date")
    if peer is None:
        empty = {f"p_{f}": F.lit(None).cast("double") for f in FIELDS}
        return rows.withColumns(empty)
    return rows.join(named(peer, "p"), "date", "left")


def _trend(s: str, w) -> dict[str, Column]:
    c, h, low, o, v = (F.col(f"{s}_{f}") for f in ("close", "high", "low", "open", "volume"))
    prev = R.non_zero(F.lag(c).over(w))
    returns = R.change_pct(c, w, 1)
    return {
        f"{s}_ret1": returns,
        f"{s}_ret5": R.change_pct(c, w, 5),
        f"{s}_ret20": R.change_pct(c, w, 20),
        f"{s}_dist20": R.return_pct(c, R.full_mean(c, w, 20)),
        f"{s}_dist50": R.return_pct(c, R.full_mean(c, w, 50)),
        f"{s}_gap": (o / prev - 1) * 100.0,
        f"{s}_body": (c - o) / prev * 100.0,
        f"{s}_range": (h - low) / prev * 100.0,
        f"{s}_pos20": R.range_position(c, w, 20),
        f"{s}_pos60": R.range_position(c, w, 60),
        f"{s}_vol_ratio20": R.ratio(v, R.full_mean(v, w, 20)),
    }


def candle_features(rows: DataFrame) -> DataFrame:
    """Candle anatomy of the instrument in percent of the previous close."""
    w = R.ordered("ticker")
    o, h, low, c = (F.col(f"t_{f}") for f in ("open", "high", "low", "close"))
    prev = R.non_zero(F.lag(c).over(w))
    return rows.withColumns(
        {
            "t_upper_wick": (h - F.greatest(o, c)) / prev * 100.0,
            "t_lower_wick": (F.least(o, c) - low) / prev * 100.0,
        }
    )


def trend_features(rows: DataFrame) -> DataFrame:
    w = R.ordered("ticker")
    out: dict[str, Column] = {}
    for s in ("t", "i", "p"):
        out |= _trend(s, w)
    out["t_ret3"] = R.change_pct("t_close", w, 3)
    rows = candle_features(rows).withColumns(out)
    return rows.withColumns(
        {
            "t_volatility10": R.full_std("t_ret1", w, 10),
            "i_volatility10": R.full_std("i_ret1", w, 10),
            "rel5": F.col("t_ret5") - F.col("i_ret5"),
            "rel20": F.col("t_ret20") - F.col("i_ret20"),
            "rel5_peer": F.col("t_ret5") - F.col("p_ret5"),
            "corr20": R.paired_corr("t_ret1", "i_ret1", w, 20),
            "beta20": R.paired_beta("t_ret1", "i_ret1", w, 20),
            "corr20_peer": R.paired_corr("t_ret1", "p_ret1", w, 20),
            "beta20_peer": R.paired_beta("t_ret1", "p_ret1", w, 20),
            **{f"{s}_streak": R.streak_state(f"{s}_ret1", w, 2) for s in ("t", "i", "p")},
        }
    )


def _two_sided(up: Column, down: Column) -> Column:
    """-1 where ``down``, else +1 where ``up``, else 0: the negative case is decided last."""
    return F.when(down, -1.0).when(up, 1.0).otherwise(0.0)


def state_features(rows: DataFrame) -> DataFrame:
    """Three-valued regime states of the instrument, from :func:`trend_features` columns."""
    w = R.ordered("ticker")
    c, o, h, low = (F.col(f"t_{f}") for f in ("close", "open", "high", "low"))
    signed_range = F.abs("t_range") * F.signum(F.coalesce("t_body", F.lit(0.0)))
    rows = rows.withColumns(
        {
            "_shock": R.adaptive_threshold("t_ret1", w, 40, 0.8, 3.0, 1.75),
            "_impulse": R.adaptive_threshold("t_ret3", w, 60, 0.8, 5.0, 1.5),
            "_wide": R.adaptive_threshold("t_range", w, 40, 0.75, 3.5, 1.25),
            "_trend": R.adaptive_threshold("t_ret5", w, 60, 0.75, 4.0, 1.25),
            "_quiet": R.lower_quantile_threshold("t_volatility10", w, 60, 0.35, 0.8),
            "_narrow": R.lower_quantile_threshold("t_range", w, 60, 0.35, 1.2),
            "_rotate": R.adaptive_threshold("rel5", w, 60, 0.75, 1.0, 1.25),
            "_stretch": R.adaptive_threshold("t_dist20", w, 80, 0.8, 6.0, 1.0),
            "_upper": R.adaptive_threshold("t_upper_wick", w, 60, 0.75, 1.5, 1.0),
            "_lower": R.adaptive_threshold("t_lower_wick", w, 60, 0.75, 1.5, 1.0),
            "_above": F.coalesce(F.col("t_dist20") >= 0, F.lit(False)),
            "_in_range": (c - low) / R.non_zero(h - low),
        }
    )
    was_above = F.lag("_above", 1, False).over(w)
    squeezed = (F.col("t_volatility10") <= F.col("_quiet")) & (F.col("t_range") <= F.col("_narrow"))
    linked = F.col("corr20") >= 0.45
    stretched = F.col("_stretch")
    states = {
        "t_limit": R.three_state("t_ret1", F.lit(6.75)),
        "t_shock": R.three_state("t_ret1", "_shock"),
        "t_impulse": R.three_state("t_ret3", "_impulse"),
        "t_wide": R.three_state(signed_range, "_wide"),
        "t_trend": _two_sided(
            (F.col("t_ret5") >= F.col("_trend")) & (F.col("t_pos20") >= 0.7),
            (F.col("t_ret5") <= -F.col("_trend")) & (F.col("t_pos20") <= 0.3),
        ),
        "t_compression": _two_sided(
            squeezed & (F.col("t_dist20") >= 0) & (F.col("t_pos20") >= 0.45),
            squeezed & (F.col("t_dist20") < 0) & (F.col("t_pos20") <= 0.55),
        ),
        "t_reclaim": _two_sided(
            F.col("_above") & ~was_above & (F.col("t_ret1") > 0), ~F.col("_above") & was_above & (F.col("t_ret1") < 0)
        ),
        "t_rotation": _two_sided(
            linked & (F.col("rel5") >= F.col("_rotate")), linked & (F.col("rel5") <= -F.col("_rotate"))
        ),
        "t_exhaustion": _two_sided(
            (F.col("t_dist20") >= stretched)
            & ((F.col("_in_range") <= 0.35) | F.coalesce(F.col("t_upper_wick") >= F.col("_upper"), F.lit(False))),
            (F.col("t_dist20") <= -stretched)
            & ((F.col("_in_range") >= 0.65) | F.coalesce(F.col("t_lower_wick") >= F.col("_lower"), F.lit(False))),
        ),
    }
    return rows.withColumns(states).drop(
        "_shock", "_impulse", "_wide", "_trend", "_quiet", "_narrow", "_rotate", "_stretch", "_upper", "_lower", "_above", "_in_range"
    )


def week_start(date: Column) -> Column:
    """First day of the Saturday-to-Friday week."""
    return F.date_sub(F.trunc(F.date_add(date, 2), "week"), 2)


def weekly_context(rows: DataFrame, s: str) -> DataFrame:
    """Week-to-date and previous-week features of one series, without looking into the current week's end.

    Weeks are numbered per instrument; the previous week is a value range over that number,
    so the weekly figures come from the same partitioning as the daily ones.
    """
    rows = rows.withColumn("_week", week_start(F.col("date")))
    rows = rows.withColumn("_wk", F.dense_rank().over(Window.partitionBy("ticker").orderBy("_week")))
    by_week = Window.partitionBy("ticker").orderBy("_wk")
    so_far = Window.partitionBy("ticker", "_wk").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    c, h, low, v = (F.col(f"{s}_{f}") for f in ("close", "high", "low", "volume"))

    def back(n: int, agg: Column, until: int | None = None) -> Column:
        return agg.over(by_week.rangeBetween(-n, -(until or n)))

    close1, close2 = back(1, F.max_by(c, "date")), back(2, F.max_by(c, "date"))
    high1, low1, vol1 = back(1, F.max(h)), back(1, F.min(low)), back(1, F.sum(v))
    mean4 = F.when(F.col("_wk") > 4, back(4, F.sum(v), 1) / 4.0)
    return rows.withColumns(
        {
            f"{s}_wtd_ret": R.return_pct(c, close1),
            f"{s}_wtd_range": R.ratio_pct(F.max(h).over(so_far) - F.min(low).over(so_far), close1),
            f"{s}_wtd_volume": R.ratio_pct(F.sum(v).over(so_far), vol1),
            f"{s}_to_week_high": R.return_pct(c, high1),
            f"{s}_to_week_low": R.return_pct(c, low1),
            f"{s}_week_ret": R.return_pct(close1, close2),
            f"{s}_week_range": R.ratio_pct(high1 - low1, close2),
            f"{s}_week_vol_ratio4": R.ratio(vol1, mean4),
        }
    ).drop("_week", "_wk")


LAGGED = (
    "t_ret1 t_range t_vol_ratio20 t_streak t_limit t_shock t_impulse t_wide t_trend t_compression t_reclaim t_rotation "
    "t_exhaustion rel5 rel5_peer i_ret1 i_range i_streak p_ret1 p_streak"
).split()

WEEKLY = "wtd_ret wtd_range wtd_volume to_week_high to_week_low week_ret week_range week_vol_ratio4".split()
BASE = (
    "t_gap t_body t_range t_upper_wick t_lower_wick t_ret1 t_ret5 t_ret20 t_dist20 t_dist50 t_pos20 t_pos60 t_vol_ratio20 "
    "t_volatility10 t_streak t_limit t_shock t_impulse t_wide t_trend t_compression t_reclaim t_rotation t_exhaustion "
    + " ".join(f"t_{x}" for x in WEEKLY)
    + " rel5 rel20 rel5_peer rel_wtd_ret rel_week_ret corr20 beta20 i_gap i_body i_range i_ret1 i_ret5 i_ret20 i_dist20 i_dist50 "
    "i_pos20 i_pos60 i_vol_ratio20 i_volatility10 i_streak "
    + " ".join(f"i_{x}" for x in WEEKLY)
    + " p_ret1 p_ret5 p_ret20 p_dist20 p_pos20 p_vol_ratio20 p_streak corr20_peer beta20_peer"
).split()
FEATURES = BASE + [f"{c}_lag{k}" for c in LAGGED for k in LAGS]


def lag_features(rows: DataFrame) -> DataFrame:
    w = R.ordered("ticker")
    return rows.withColumns({f"{c}_lag{k}": F.lag(c, k).over(w) for c in LAGGED for k in LAGS})


def feature_sample(bars: DataFrame, index: DataFrame, peer: DataFrame | None = None) -> DataFrame:
    """Key, base prices and the 69 base plus 60 lagged features per (instrument, date)."""
    rows = state_features(trend_features(join_series(bars, index, peer)))
    rows = weekly_context(weekly_context(rows, "t"), "i").withColumns(
        {
            "rel_wtd_ret": F.col("t_wtd_ret") - F.col("i_wtd_ret"),
            "rel_week_ret": F.col("t_week_ret") - F.col("i_week_ret"),
        }
    )
    prices = ["t_open", "t_high", "t_low", "t_close"]
    return lag_features(rows).select("ticker", "sector", "date", *prices, *FEATURES)
