"""One-row-per-instrument technical snapshot and everything derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import grid as G
from barloom.functions.frames import correlation, clamp, non_zero, ordered, ratio, ratio_pct, return_pct
from barloom.functions.ranks import add_rank
from barloom.operators.panel import INDEX_KEY, one_series
from barloom.functions.smoothing import with_atr, with_ema, with_macd, with_rsi

PRICE_LEVELS = (
    "last_close prev_close sma20 sma50 sma200 ema20 atr14 macd macd_signal macd_hist std20 high252 low252"
).split()


def snapshot(bars: DataFrame, index: DataFrame, live: DataFrame | None = None, unit: float = 1.0) -> DataFrame:
    """Indicators of every instrument at its last bar.

    ``live`` (ticker, price, day_volume, day_value) overrides the last price. Bars may hold
    whole-number prices; ``unit`` of them make one price unit. All steps after the join with
    the index keep the partitioning by instrument: one shuffle of the bars.
    """
    before = F.lag("close").over(ordered(INDEX_KEY))
    index_ret = one_series(index).select("date", (F.col("close") / non_zero(before) - 1).alias("_iret"))
    w = ordered("ticker")
    rows = bars.join(index_ret, "date", "left").withColumn(
        "_ret", F.col("close") / non_zero(F.lag("close").over(w)) - 1
    )
    rows = with_macd(with_rsi(with_atr(with_ema(rows, {"ema20": 20}), 14, "atr14"), 14, "rsi14"))
    rows = rows.withColumns(
        {
            "_n": F.count(F.lit(1)).over(Window.partitionBy("ticker")),
            "_i": F.row_number().over(w),
        }
    ).withColumn("_age", F.col("_n") - F.col("_i"))

    def tail(agg, x: str, n: int) -> Column:
        return F.when(F.max("_n") >= n, agg(F.when(F.col("_age") < n, F.col(x))))

    def at_age(x: str, age: int) -> Column:
        return F.max(F.when(F.col("_age") == age, F.col(x)))

    pair = F.col("_ret").isNotNull() & F.col("_iret").isNotNull()
    i_ret = F.when(pair, F.col("_iret"))
    beta = F.covar_samp("_ret", "_iret") / non_zero(F.var_samp(i_ret))
    snap = rows.groupBy("ticker", "sector").agg(
        F.max("date").alias("last_date"),
        F.max("_n").alias("bars"),
        at_age("close", 0).alias("last_close"),
        at_age("close", 1).alias("prev_close"),
        at_age("volume", 0).alias("volume"),
        *[tail(F.avg, "close", n).alias(f"sma{n}") for n in (20, 50, 200)],
        tail(F.stddev_samp, "close", 20).alias("std20"),
        F.when(F.max("_n") >= 20, at_age("ema20", 0)).alias("ema20"),
        F.when(F.max("_n") > 14, at_age("rsi14", 0)).alias("rsi14"),
        F.when(F.max("_n") > 14, at_age("atr14", 0)).alias("atr14"),
        *[at_age(c, 0).alias(c) for c in ("macd", "macd_signal", "macd_hist")],
        F.stddev_samp(F.when(F.col("_age") < 20, F.col("_ret"))).alias("_v20"),
        F.stddev_samp(F.when(F.col("_age") < 60, F.col("_ret"))).alias("_v60"),
        beta.alias("beta"),
        F.when(F.var_samp(i_ret) > 0, correlation("_ret", "_iret")).alias("corr"),
        *[at_age("close", n).alias(f"_c{n}") for n in (5, 20, 60)],
        tail(F.avg, "volume", 20).alias("adv20"),
        F.max(F.when(F.col("_age") < 252, F.col("high"))).alias("high252"),
        F.min(F.when(F.col("_age") < 252, F.col("low"))).alias("low252"),
    )
    snap = snap.withColumns(
        {
            "vol20_pct": F.col("_v20") * 100.0,
            "vol60_pct": F.col("_v60") * 100.0,
            **{f"ret{n}": return_pct("last_close", f"_c{n}") for n in (5, 20, 60)},
            "atr_pct": ratio_pct("atr14", "last_close"),
            "pct_from_high": return_pct("last_close", "high252"),
            "pct_to_low": return_pct("last_close", "low252"),
        }
    ).drop("_v20", "_v60", "_c5", "_c20", "_c60")
    if unit != 1.0:
        snap = snap.withColumns({c: F.col(c) / unit for c in PRICE_LEVELS})
    if live is None:
        snap = snap.withColumns(
            {c: F.lit(None).cast("double") for c in ("price", "day_volume", "day_value")}
        )
    else:
        snap = snap.join(live.select("ticker", "price", "day_volume", "day_value"), "ticker", "left")
    last_price = G.round_to_tick(F.coalesce("price", "last_close"))
    snap = snap.withColumn("price_source", F.when(F.col("price").isNotNull(), "intraday").otherwise("close"))
    snap = snap.withColumn("last", last_price)
    return snap.withColumns(
        {
            "change_pct": return_pct("last", "last_close"),
            "z20": (F.col("last") - F.col("sma20")) / non_zero("std20"),
            "band_up": F.col("sma20") + 2 * F.col("std20"),
            "band_down": F.col("sma20") - 2 * F.col("std20"),
            "intraday_pct_adv": F.when(F.col("adv20") > 0, F.col("day_volume") / F.col("adv20")),
        }
    ).drop("price")


def technical(snap: DataFrame) -> DataFrame:
    """Output contract: last, reference and indicators.

    The z-score falls back to distance in ATRs only when no instrument has one; that test is
    one scalar aggregate over the snapshot, not a window over all rows.
    """
    any_z = snap.agg(F.max(F.col("z20").isNotNull())).scalar()
    by_atr = F.when(F.col("atr14") == 0, 0.0).otherwise((F.col("last") - F.col("sma20")) / non_zero("atr14"))
    base = snap.withColumns(
        {"last": F.coalesce("last", "last_close"), "ref": F.coalesce("last_close", "last")}
    )
    return base.withColumns(
        {
            "change_pct": return_pct("last", "ref"),
            "z20": F.when(F.coalesce(any_z, F.lit(False)), F.col("z20")).otherwise(by_atr),
        }
    ).select(
        *("ticker sector last ref change_pct sma20 sma50 sma200 ema20 rsi14 atr14 vol20_pct vol60_pct macd macd_signal "
          "beta corr z20 ret5 ret20 ret60 adv20 day_volume day_value intraday_pct_adv high252 low252 price_source").split()
    )


def with_bands(tech: DataFrame) -> DataFrame:
    low, high = G.price_band(F.col("ref"))
    return tech.withColumns({"floor": low, "ceil": high, "tick": G.tick_size(F.col("ref"))})


def with_grid(tech: DataFrame) -> DataFrame:
    """Neighbouring valid prices: one tick each side and three ladder levels each way."""
    low, high = F.col("floor"), F.col("ceil")
    tech = tech.withColumns(
        {
            "bid1": clamp(G.round_to_tick(F.col("last") - F.col("tick")), low, high),
            "ask1": clamp(G.round_to_tick(F.col("last") + F.col("tick")), low, high),
            "ticks_to_floor": G.ticks_between(F.col("last"), low, F.col("tick")),
            "ticks_to_ceil": G.ticks_between(high, F.col("last"), F.col("tick")),
        }
    )
    for name, direction in (("below", -1), ("above", 1)):
        previous = "last"
        for level in (1, 2, 3):
            tech = tech.withColumn(f"{name}{level}", G.next_level(F.col(previous), direction, low, high))
            previous = f"{name}{level}"
    return tech


def with_ratios(tech: DataFrame, lot: int = 100) -> DataFrame:
    """Distances, flags, notionals and liquidity ranks of the snapshot."""
    last = F.col("last")

    def above(x: str) -> Column:
        return F.when(last.isNotNull() & F.col(x).isNotNull(), (last > F.col(x)).cast("int"))

    span = F.col("high252") - F.col("low252")
    tech = tech.withColumns(
        {
            "atr_pct": ratio_pct("atr14", "last"),
            "adtv": F.col("adv20") * last,
            "lot_size": F.lit(lot),
            "lot_notional": lot * last,
            "lot_atr": lot * F.col("atr14"),
            "slippage_pct": ratio_pct("tick", "last"),
            "pos52": clamp((last - F.col("low252")) / non_zero(span), 0.0, 1.0),
            "above_sma20": above("sma20"),
            "above_sma50": above("sma50"),
            "above_sma200": above("sma200"),
            "dist_ref_pct": return_pct("last", "ref"),
            "dist_sma20_pct": return_pct("last", "sma20"),
            "dist_sma50_pct": return_pct("last", "sma50"),
            "floor_valid": F.coalesce(last > F.col("floor"), F.lit(False)),
            "ceil_valid": F.coalesce(last < F.col("ceil"), F.lit(False)),
        }
    )
    return tech


def with_liquidity_rank(tech: DataFrame) -> DataFrame:
    """Rank by traded value, descending with minimum ties, and the same in percent."""
    return add_rank(tech, "adtv", {"min": "adtv_rank", "min_pct": "adtv_rank_pct"}, descending=True)


def with_signals(tech: DataFrame, min_adv: float = 10_000.0) -> DataFrame:
    """Preset fit scores, distance to the band in ATRs and sorted risk flags."""
    last, atr = F.col("last"), F.col("atr14")

    def points(condition: Column, n: float) -> Column:
        return F.when(condition, n).otherwise(0.0)

    momentum = (
        points(F.col("rsi14") >= 55, 0.4)
        + points(F.col("ret20") >= 0, 0.3)
        + points(F.col("macd") > F.col("macd_signal"), 0.3)
    )
    reversion = points(F.col("z20") <= -0.5, 0.5) + points((atr > 0) & (last - F.col("floor") <= atr), 0.5)
    near = F.least((F.col("ceil") - last) / non_zero(atr), (last - F.col("floor")) / non_zero(atr))
    tick = G.tick_size(last)
    near_limit = F.coalesce(F.col("ceil") - last <= tick, F.lit(False)) | F.coalesce(
        last - F.col("floor") <= tick, F.lit(False)
    )
    flags = F.array(
        F.when(F.col("adv20").isNull() | (F.col("adv20") < min_adv), "LOW_LIQ"),
        F.when(near_limit, "NEAR_LIMIT"),
        F.when(F.lower("price_source") != "intraday", "STALE_SNAPSHOT"),
        F.when(atr.isNull() | (atr == 0), "ZERO_ATR"),
    )
    return tech.withColumns(
        {
            "fit_momentum": F.least(momentum, F.lit(1.0)),
            "fit_reversion": F.least(reversion, F.lit(1.0)),
            "band_distance": F.when(atr == 0, 0.0).otherwise(near),
            "risk_flags": F.array_join(F.array_compact(flags), "|"),
        }
    ).withColumn("fit_balanced", (F.col("fit_momentum") + F.col("fit_reversion")) / 2.0)


def round_to_lot(x: Column, lot: int, mode: str = "round") -> Column:
    """Whole lots; ``round`` is half-even; null counts as 0."""
    units = x / lot
    whole = {"floor": F.floor(units), "ceil": F.ceil(units), "round": F.bround(units, 0)}[mode]
    return F.coalesce(whole.cast("long") * lot, F.lit(0))


def with_sizing(
    tech: DataFrame, target: str, current: str, pct_adv: float = 0.1, max_qty: float = 500_000.0, lot: int = 100, slice_adv: float = 0.02
) -> DataFrame:
    """Largest order, slice count and slice size for moving ``current`` to ``target``."""
    adv = F.coalesce("adv20", F.lit(0.0))
    delta = F.abs(F.col(target) - F.col(current))
    slices = (
        F.when(delta == 0, 0)
        .when(adv * slice_adv <= 0, 1)
        .otherwise(F.greatest(F.lit(1), F.ceil(delta / non_zero(adv * slice_adv))))
    )
    return tech.withColumns(
        {
            "delta_qty": F.bround((F.col(target) - F.col(current)).cast("double"), 0).cast("long"),
            "max_order_qty": F.when(adv > 0, round_to_lot(F.least(adv * pct_adv, F.lit(max_qty)), lot, "floor")).otherwise(0),
            "slice_count": slices.cast("long"),
            "liquidity": F.col("adv20") * F.col("last"),
            "volatility": F.coalesce(F.when(F.col("last") > 0, F.col("atr14") / F.col("last")), F.lit(0.0)),
        }
    ).withColumn(
        "slice_qty",
        F.when(F.col("slice_count") > 0, round_to_lot(delta / F.col("slice_count"), lot)).otherwise(0),
    )


# Preset names and the sides they declare.
PRESETS = (("momentum", "BUY"), ("mean_reversion", "BOTH"), ("balanced", "BOTH"), ("risk_off", "SELL"))


def preset_levels(tech: DataFrame) -> DataFrame:
    """Near and opportunity buy and sell prices per preset, snapped and inside the band."""
    low, high = F.col("floor"), F.col("ceil")
    last, sma, atr = F.col("last"), F.col("sma20"), F.col("atr14")
    tick = G.tick_size(F.coalesce("last", "ref"))
    preset = F.col("preset")
    anchor = F.coalesce((last + sma) / 2.0, last, sma)
    raw_buy = (
        F.when(preset == "momentum", last + tick)
        .when(preset == "mean_reversion", F.coalesce(sma - 0.5 * atr, last - tick))
        .when(preset == "balanced", F.coalesce(anchor - tick, anchor))
    )
    raw_sell = (
        F.when(preset == "momentum", last + 2 * tick)
        .when(preset == "mean_reversion", F.coalesce(sma + 0.5 * atr, last + tick))
        .when(preset == "balanced", F.coalesce(anchor + tick, anchor))
        .otherwise(last - tick)
    )
    presets = F.array(*[F.struct(F.lit(p).alias("preset"), F.lit(s).alias("side")) for p, s in PRESETS])
    rows = tech.withColumn("_p", F.explode(presets)).withColumns({"preset": F.col("_p.preset"), "side": F.col("_p.side")})
    rows = rows.withColumns(
        {"near_buy": G.snap_and_clamp(raw_buy, low, high), "near_sell": G.snap_and_clamp(raw_sell, low, high)}
    )
    have = sma.isNotNull() & atr.isNotNull()

    def step(side: str, k: float) -> Column:
        near = F.col(f"near_{side}")
        price = F.least(near, sma - k * atr) if side == "buy" else F.greatest(near, sma + k * atr)
        return F.when(have & near.isNotNull(), G.snap_and_clamp(price, low, high))

    return rows.select(
        "ticker", "preset", "side", "near_buy", "near_sell",
        step("buy", 0.5).alias("opp1_buy"), step("sell", 0.5).alias("opp1_sell"),
        step("buy", 1.0).alias("opp2_buy"), step("sell", 1.0).alias("opp2_sell"),
    )


def public_columns(dataset: DataFrame, internal: Sequence[str]) -> DataFrame:
    """Drop score and sizing columns that the published snapshot does not carry."""
    return dataset.drop(*internal)
