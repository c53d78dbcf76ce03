"""Recursive smoothing (EMA, Wilder RSI and ATR, MACD) as decayed window sums.

``s[i] = (1-a)*s[i-1] + a*x[i]`` with ``s[0] = x[0]`` is a sum of inputs with weights
``a*(1-a)^(i-j)``. A plain prefix sum of ``x[j]*(1-a)^-j`` would overflow on long
histories, so each history is cut into blocks: the sum restarts in every block, and the ends of all earlier
blocks are carried in, each decayed by the blocks since. Ratios of two smoothed series stay
right however small both have become. No Python, one shuffle by key; the only array holds
one number per earlier block of the key's history.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import non_zero, ordered


def _block_length(alphas: Sequence[float]) -> int:
    decay = [-math.log1p(-a) for a in alphas]
    shortest = math.ceil(41.5 / min(decay))
    longest = math.floor(600.0 / max(decay))
    if shortest > longest:
        raise ValueError("smoothing factors too far apart to share one pass")
    return shortest


def _chained(ends: Column, decay: float) -> Column:
    """Sum of the block ends, each decayed once for every block after it."""
    return F.aggregate(ends, F.lit(0.0), lambda total, end: total * F.lit(decay) + end)


def exp_smooth(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    parts: Sequence[tuple[str, str, float]],
) -> DataFrame:
    """Add one smoothed column per ``(input, output, alpha)``.

    All inputs must be null on the same leading rows and non-null after them.
    """
    keys = list(keys)
    size = _block_length([a for _, _, a in parts])
    w = ordered(keys, order)
    seen = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    lead_in = parts[0][0]
    df = df.withColumn("_n", F.when(F.col(lead_in).isNotNull(), F.count(lead_in).over(seen)))
    df = df.withColumns(
        {"_block": F.floor((F.col("_n") - 1) / size), "_off": (F.col("_n") - 1) % size}
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = {}
    for src, out, a in parts:
        keep = F.lit(1.0 - a)
        share = F.when(F.col("_n") == 1, F.col(src) * 1.0).otherwise(F.col(src) * a)
        local[f"_local_{out}"] = F.sum(share * F.pow(keep, -F.col("_off"))).over(inside) * F.pow(
            keep, F.col("_off")
        )
    df = df.withColumns(local)
    smoothed = {}
    for src, out, a in parts:
        closings = F.collect_list(F.when(F.col("_off") == size - 1, F.col(f"_local_{out}"))).over(before)
        carried = _chained(closings, (1.0 - a) ** size) * F.pow(F.lit(1.0 - a), F.col("_off") + 1)
        smoothed[out] = F.when(F.col(src).isNotNull(), F.col(f"_local_{out}") + carried)
    return df.withColumns(smoothed).drop("_n", "_block", "_off", *local)


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def with_ema(df: DataFrame, spans: dict[str, int], price: str = "close", key: str = "ticker") -> DataFrame:
    """EMA columns ``{output: span}`` of one price column."""
    parts = [(price, out, span_alpha(span)) for out, span in spans.items()]
    return exp_smooth(df, [key], "date", parts)


def with_rsi(df: DataFrame, period: int, out: str, price: str = "close", key: str = "ticker") -> DataFrame:
    """Wilder RSI, seeded at the first difference; no average loss gives null."""
    w = ordered(key)
    step = F.col(price) - F.lag(price).over(w)
    df = df.withColumn("_step", step).withColumns(
        {
            "_gain": F.greatest(F.col("_step"), F.lit(0)) * F.when(F.col("_step").isNotNull(), 1.0),
            "_loss": F.greatest(-F.col("_step"), F.lit(0)) * F.when(F.col("_step").isNotNull(), 1.0),
        }
    )
    df = exp_smooth(df, [key], "date", [("_gain", "_up", 1.0 / period), ("_loss", "_down", 1.0 / period)])
    strength = F.col("_up") / non_zero("_down")
    return df.withColumn(out, 100.0 - 100.0 / (1.0 + strength)).drop(
        "_step", "_gain", "_loss", "_up", "_down"
    )


def true_range(w, high: str = "high", low: str = "low", close: str = "close"):
    prev = F.lag(close).over(w)
    return F.greatest(
        F.col(high) - F.col(low), F.abs(F.col(high) - prev), F.abs(F.col(low) - prev)
    )


def with_atr(df: DataFrame, period: int, out: str, key: str = "ticker") -> DataFrame:
    """Wilder ATR, seeded with the first bar's range."""
    df = df.withColumn("_tr", true_range(ordered(key)) * 1.0)
    return exp_smooth(df, [key], "date", [("_tr", out, 1.0 / period)]).drop("_tr")


def with_macd(
    df: DataFrame,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    price: str = "close",
    key: str = "ticker",
) -> DataFrame:
    """Columns ``macd``, ``macd_signal``, ``macd_hist``; null while a history is shorter than ``slow``."""
    df = with_ema(df, {"_fast": fast, "_slow": slow}, price, key)
    df = df.withColumn("_line", F.col("_fast") - F.col("_slow"))
    df = exp_smooth(df, [key], "date", [("_line", "_signal", span_alpha(signal))])
    bars = F.count(F.lit(1)).over(ordered(key).rowsBetween(Window.unboundedPreceding, 0))
    ready = bars >= max(fast, slow)
    return df.withColumns(
        {
            "macd": F.when(ready, F.col("_line")),
            "macd_signal": F.when(ready, F.col("_signal")),
            "macd_hist": F.when(ready, F.col("_line") - F.col("_signal")),
        }
    ).drop("_fast", "_slow", "_line", "_signal")
