"""Signals to labelled trades, trade metrics and the choice of a playbook."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import frames as R
from barloom.functions.smoothing import with_ema
from barloom.operators.panel import mean_rsi

EMA_SPANS = (5, 7, 10, 15)
STOP = -0.10
FIRST_PROBE = 2  # bars after entry before an exit may trigger
WARM_UP = 21  # first bar position that may signal


@dataclass(frozen=True)
class Setup:
    """One entry rule of a family with its limits."""

    signal_id: int
    family: str
    limits: tuple[float, ...]


@dataclass(frozen=True)
class Config:
    """An entry rule with an exit: EMA span, longest hold, optional target."""

    config_id: int
    signal_id: int
    family: str
    ema_span: int
    max_hold: int
    target: float | None


# Entry limits per family and exits (EMA spans, holds, targets) per family.
ENTRY_GRID = {
    "washout_reclaim": [(-0.12, -0.18), (35.0, 40.0)],
    "trend_pullback": [(-0.10, -0.07), ((40.0, 58.0), (45.0, 62.0))],
    "breakout_followthrough": [(-0.08, -0.12), (5, 10), (0.03, 0.045), (1.0, 1.3)],
    "trend_reacceleration": [(5, 10), (0.01, 0.02), (0.8, 1.0), (0.04,)],
}
EXIT_GRID = {
    "washout_reclaim": [(7, 10), (15,), (None, 0.10, 0.15)],
    "trend_pullback": [(10, 15), (15, 25), (None, 0.08, 0.12)],
    "breakout_followthrough": [(5,), (10, 15), (0.10, 0.15)],
    "trend_reacceleration": [(10, 15), (15, 25), (None, 0.10)],
}


def setups() -> list[Setup]:
    out = []
    for family, grid in ENTRY_GRID.items():
        for combo in product(*grid):
            flat = tuple(v for c in combo for v in (c if isinstance(c, tuple) else (c,)))
            out.append(Setup(len(out), family, flat))
    return out


def catalogue() -> list[Config]:
    """All entry rules crossed with the exits of their family: 200 configurations."""
    out = []
    for s in setups():
        for span, hold, target in product(*EXIT_GRID[s.family]):
            out.append(Config(len(out), s.signal_id, s.family, span, hold, target))
    return out


def catalogue_table(spark: SparkSession) -> DataFrame:
    rows = [(c.config_id, c.signal_id, c.family, c.ema_span, c.max_hold, c.target) for c in catalogue()]
    return spark.createDataFrame(
        rows, "config_id int, signal_id int, family string, ema_span int, max_hold int, target double"
    )


def playbook_indicators(bars: DataFrame) -> DataFrame:
    """Indicators the entry rules read, bar position and history length per instrument."""
    rows = with_ema(bars, {f"ema{n}": n for n in EMA_SPANS})
    w = R.ordered("ticker")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c, h, v = F.col("close"), F.col("high"), F.col("volume")
    rows = rows.withColumns(
        {
            "_step": c - F.lag(c).over(w),
            "ret1": c / R.non_zero(F.lag(c).over(w)) - 1,
            "ret3": c / R.non_zero(F.lag(c, 3).over(w)) - 1,
            **{f"sma{n}": R.full_mean(c, w, n) for n in (20, 50, 200)},
            "vol_ratio20": R.ratio(v, R.full_mean(v, w, 20)),
            **{f"prior_high{n}": R.full_frame(F.max, h, w, n, shift=1) for n in (5, 10)},
            "dd60": c / R.non_zero(R.full_max(c, w, 60)) - 1,
            "_bb": R.full_mean(c, w, 20) - 2.0 * R.full_std(c, w, 20),
            "idx": F.row_number().over(w) - 1,
            "n": F.count(F.lit(1)).over(whole),
        }
    )
    return rows.withColumns(
        {
            "dist_sma20": c / R.non_zero("sma20") - 1,
            "rsi14": mean_rsi("_step", w),
            "was_below_band": F.lag(c < F.col("_bb")).over(w),
            "split": F.floor(F.col("n") * 0.7).cast("int"),
        }
    ).drop("_step", "_bb")


def setup_condition(s: Setup) -> Column:
    c = F.col("close")
    ret1, vol = F.col("ret1"), F.col("vol_ratio20")
    if s.family == "washout_reclaim":
        dd, rsi = s.limits
        return (F.col("dd60") <= dd) & (F.col("rsi14") <= rsi) & (ret1 > 0) & F.col("was_below_band")
    if s.family == "trend_pullback":
        low, rsi_low, rsi_high = s.limits
        return (
            F.col("dist_sma20").between(low, 0.0)
            & F.col("rsi14").between(rsi_low, rsi_high)
            & (ret1 > 0)
            & (c > F.col("ema10"))
            & (c >= F.col("sma200"))
        )
    if s.family == "breakout_followthrough":
        dd, look, least, volume = s.limits
        return (F.col("dd60") <= dd) & (c > F.col(f"prior_high{look}")) & (ret1 >= least) & (vol >= volume)
    look, least, volume, stretch = s.limits
    return (
        (c >= F.col("sma50"))
        & (F.col("sma50") >= F.col("sma200"))
        & (c > F.col(f"prior_high{look}"))
        & (F.col("ret3") >= least)
        & (vol >= volume)
        & (F.col("dist_sma20") <= stretch)
    )


def fired_setups(indicators: DataFrame) -> DataFrame:
    """One row per bar and entry rule that fires there."""
    hits = F.array_compact(F.array(*[F.when(setup_condition(s), F.lit(s.signal_id)) for s in setups()]))
    return indicators.withColumn("signal_id", F.explode(hits))


def label_trades(indicators: DataFrame, configs: DataFrame) -> DataFrame:
    """Exit of every fired signal under every configuration and segment (train, test, all).

    Entry is the next open. From the third bar on, each bar is probed for target, stop and
    close below the exit EMA, in that order; otherwise the trade ends by time or with the
    segment. Each bar carries at most the longest hold of bars ahead, never the history.
    """
    longest = max(c.max_hold for c in catalogue())
    ahead = R.ordered("ticker").rowsBetween(1, longest)
    bar = F.struct("open", "high", "low", "close", *[f"ema{n}" for n in EMA_SPANS])
    rows = fired_setups(indicators.withColumn("path", F.collect_list(bar).over(ahead)))
    rows = rows.select("ticker", "date", "idx", "n", "split", "path", "signal_id").join(
        F.broadcast(configs), "signal_id"
    )
    segments = F.array(
        F.struct(F.lit("train").alias("segment"), F.lit(WARM_UP).alias("first"), F.col("split").alias("upper")),
        F.struct(F.lit("test").alias("segment"), F.greatest("split", F.lit(WARM_UP)).alias("first"), F.col("n").cast("int").alias("upper")),
        F.struct(F.lit("all").alias("segment"), F.lit(WARM_UP).alias("first"), F.col("n").cast("int").alias("upper")),
    )
    inside = F.filter(segments, lambda s: (F.col("idx") >= s["first"]) & (F.col("idx") < s["upper"] - 1))
    rows = rows.withColumn("s", F.explode(inside)).withColumns(
        {"segment": F.col("s.segment"), "span": F.least("max_hold", F.col("s.upper") - F.col("idx") - 1)}
    )
    entry = F.col("path")[0]["open"].cast("double")
    rows = rows.withColumn("entry", entry)
    goal, stop = F.col("entry") * (1 + F.col("target")), F.col("entry") * (1 + STOP)

    def probe(x: Column, i: Column) -> Column:
        ema = F.when(F.col("ema_span") == 5, x["ema5"])
        for n in EMA_SPANS[1:]:
            ema = ema.when(F.col("ema_span") == n, x[f"ema{n}"])
        reason = (
            F.when(x["high"] >= goal, "target").when(x["low"] <= stop, "stop").when(x["close"] < ema, "ema")
        )
        price = F.when(reason == "target", goal).when(reason == "stop", stop).otherwise(x["close"].cast("double"))
        allowed = (i >= FIRST_PROBE) & (i < F.col("span"))
        return F.when(allowed & reason.isNotNull(), F.struct(i.alias("i"), reason.alias("reason"), price.alias("price")))

    rows = rows.withColumn("hit", F.get(F.array_compact(F.transform("path", probe)), F.lit(0)))
    last = F.col("span") - 1
    rows = rows.withColumns(
        {
            "hold": F.coalesce(F.col("hit.i"), last) + 1,
            "exit": F.coalesce(F.col("hit.price"), F.get("path", last)["close"].cast("double")),
            "reason": F.coalesce(F.col("hit.reason"), F.lit("time")),
        }
    )
    held = F.slice("path", 1, F.col("hold"))
    return rows.select(
        "ticker",
        "config_id",
        "segment",
        "date",
        "idx",
        (F.col("idx") + F.col("hold")).alias("exit_idx"),
        "hold",
        "reason",
        "entry",
        "exit",
        ((F.col("exit") / F.col("entry") - 1) * 100.0).alias("ret_pct"),
        ((F.array_min(F.transform(held, lambda x: x["low"])) / F.col("entry") - 1) * 100.0).alias("drawdown_pct"),
        ((F.array_max(F.transform(held, lambda x: x["high"])) / F.col("entry") - 1) * 100.0).alias("runup_pct"),
    )


def non_overlapping(labels: DataFrame) -> DataFrame:
    """Keep a signal only when the previous kept trade of its group has ended.

    A group holds at most one signal per trading day of one instrument.
    """
    fields = [c for c in labels.columns if c not in ("ticker", "config_id", "segment")]
    ordered = ["idx", *[f for f in fields if f != "idx"]]
    packed = labels.groupBy("ticker", "config_id", "segment").agg(
        F.array_sort(F.collect_list(F.struct(*ordered))).alias("signals")
    )
    kept_type = "array<" + packed.schema["signals"].dataType.elementType.simpleString() + ">"

    def step(acc: Column, s: Column) -> Column:
        grown = F.struct(s["exit_idx"].alias("until"), F.concat(acc["kept"], F.array(s)).alias("kept"))
        return F.when(s["idx"] > acc["until"], grown).otherwise(acc)

    start = F.struct(F.lit(-1).alias("until"), F.array().cast(kept_type).alias("kept"))
    kept = F.aggregate("signals", start, step, lambda acc: acc["kept"])
    return packed.select("ticker", "config_id", "segment", F.inline(kept))


def trade_metrics(trades: DataFrame, keys: tuple[str, ...] = ("ticker", "config_id", "segment")) -> DataFrame:
    ret = F.col("ret_pct")
    gains, losses = F.sum(F.when(ret > 0, ret).otherwise(0.0)), -F.sum(F.when(ret <= 0, ret).otherwise(0.0))
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trades"),
        (F.avg(R.flag(ret > 0)) * 100).alias("win_pct"),
        F.avg(ret).alias("avg_ret"),
        F.median(ret).alias("median_ret"),
        F.when(losses > 0, gains / R.non_zero(losses)).alias("profit_factor"),
        F.avg("hold").alias("avg_hold"),
        F.min("drawdown_pct").alias("worst_drawdown"),
    )


def trade_score(trades: Column, avg_ret: Column, median: Column, win: Column, factor: Column, hold: Column, drawdown: Column) -> Column:
    """Composite score; fewer than three trades or missing statistics score -999."""
    score = (
        avg_ret + 0.35 * median + 0.12 * win + 2.5 * F.coalesce(F.least(factor, F.lit(3.0)), F.lit(0.0))
        - 0.12 * hold + 0.25 * drawdown + F.least(trades.cast("double"), F.lit(12.0))
    )
    return F.when(F.coalesce(trades, F.lit(0)) < 3, -999.0).otherwise(F.coalesce(score, F.lit(-999.0)))


def playbook_scores(metrics: DataFrame, tickers: DataFrame, configs: DataFrame) -> DataFrame:
    """One row per (instrument, configuration): train, test and all scores and the robust blend."""
    fields = ("trades", "avg_ret", "median_ret", "win_pct", "profit_factor", "avg_hold", "worst_drawdown")
    wide = metrics.groupBy("ticker", "config_id").agg(
        *[F.max(F.when(F.col("segment") == s, F.col(f))).alias(f"{s}_{f}") for s in ("train", "test", "all") for f in fields]
    )
    ids = F.sequence(F.lit(0), F.lit(len(catalogue()) - 1))
    rows = tickers.select("ticker", F.explode(ids).alias("config_id")).join(wide, ["ticker", "config_id"], "left")
    rows = rows.join(F.broadcast(configs), "config_id")
    for s in ("train", "test", "all"):
        rows = rows.withColumn(f"{s}_score", trade_score(*[F.col(f"{s}_{f}") for f in (fields[0], *fields[1:3], *fields[3:])]))
    train, test = F.col("train_score"), F.col("test_score")
    n = F.coalesce("test_trades", F.lit(0))
    robust = (
        F.when(n >= 3, 0.45 * train + 0.55 * test)
        .when(n == 2, 0.60 * train + 0.40 * test - 3.0)
        .when(n == 1, 0.75 * train + 0.25 * test - 6.0)
        .otherwise(train - 12.0)
    )
    return rows.withColumn("robust_score", robust).fillna(0, subset=[f"{s}_{f}" for s in ("train", "test", "all") for f in ("trades", "win_pct")])


def best_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key under a full sort list; the partial result per task is one row per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_playbook(scores: DataFrame) -> DataFrame:
    order = [F.desc(c) for c in ("robust_score", "test_score", "train_score", "all_score")]
    return best_per_key(scores, ["ticker"], [*order, F.asc("config_id")])


def current_signals(indicators: DataFrame) -> DataFrame:
    """Entry rules that fire on the instrument's last bar."""
    return fired_setups(indicators.filter(F.col("idx") == F.col("n") - 1)).select("ticker", "date", "signal_id")
