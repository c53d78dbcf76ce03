"""Forecast metrics, model choice, overlays: grouped aggregates and ranked picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import clamp, flag, non_zero, return_pct
from barloom.functions.ranks import auc_by

FEE_PCT = 0.06


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def same_sign_pct(actual: Column, predicted: Column) -> Column:
    """Percent of rows whose signs agree; zero is a sign of its own."""
    return F.avg((F.signum(actual) == F.signum(predicted)).cast("int")) * 100.0


def reconstruct(df: DataFrame) -> DataFrame:
    """Predicted prices and returns from predicted open and close return and wicks."""
    base = F.col("base_close")
    opened, closed = base * (1 + F.col("pred_open") / 100.0), base * (1 + F.col("pred_close") / 100.0)
    upper, lower = F.greatest("pred_upper", F.lit(0.0)), F.greatest("pred_lower", F.lit(0.0))
    df = df.withColumns({"pred_open_price": opened, "pred_close_price": closed})
    high = F.greatest("pred_open_price", "pred_close_price") + base * upper / 100.0
    low = F.least("pred_open_price", "pred_close_price") - base * lower / 100.0
    df = df.withColumns({"pred_high_price": high, "pred_low_price": low})
    return df.withColumns(
        {
            **{f"pred_{f}_ret": return_pct(f"pred_{f}_price", "base_close") for f in ("open", "high", "low", "close")},
            "pred_range": (F.col("pred_high_price") - F.col("pred_low_price")) / non_zero(base) * 100.0,
            "bias": F.when(F.col("pred_close_price") > F.col("pred_open_price"), "BULLISH")
            .when(F.col("pred_close_price") < F.col("pred_open_price"), "BEARISH")
            .when(F.col("pred_close_price").isNotNull(), "DOJI"),
        }
    )


def attach_actuals(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{f"actual_{f}_ret": return_pct(f"actual_{f}", "base_close") for f in ("open", "high", "low", "close")},
            "actual_range": (F.col("actual_high") - F.col("actual_low")) / non_zero("base_close") * 100.0,
        }
    )


def ohlc_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Error set per group, one aggregation, with the selection scores of the forecast jobs."""
    up = F.avg(F.greatest(F.col("actual_high_ret") - F.col("pred_high_ret"), F.lit(0.0)))
    down = F.avg(F.greatest(F.col("pred_low_ret") - F.col("actual_low_ret"), F.lit(0.0)))
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("eval_rows"),
        *[mae(f"actual_{f}_ret", f"pred_{f}_ret").alias(f"{f}_mae") for f in ("open", "high", "low", "close")],
        mae("actual_range", "pred_range").alias("range_mae"),
        up.alias("upside_miss"),
        down.alias("downside_miss"),
        same_sign_pct(F.col("actual_close_ret"), F.col("pred_close_ret")).alias("hit_pct"),
    )
    close, rng, hit = F.col("close_mae"), F.col("range_mae"), F.col("hit_pct")
    return out.withColumns(
        {
            "mean_mae": (F.col("open_mae") + F.col("high_mae") + F.col("low_mae") + close) / 4.0,
            "next_session_score": close + 0.35 * rng + 0.90 * F.col("upside_miss") + 0.60 * F.col("downside_miss") - 0.01 * hit,
            "range_score": close + 0.5 * rng - 0.01 * hit,
        }
    )


def trade_columns(peak: Column, drawdown: Column) -> tuple[Column, Column, Column]:
    """(trade score, net edge after fees, reward to risk)."""
    score = peak - F.abs(drawdown)
    return score, score - FEE_PCT, F.when(F.abs(drawdown) > 1e-9, peak / F.abs(drawdown))


def timing_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Errors of peak, day, drawdown and close forecasts and of the trade score built from them."""
    actual, actual_net, _ = trade_columns(F.col("peak"), F.col("drawdown"))
    pred, pred_net, _ = trade_columns(F.col("pred_peak"), F.col("pred_drawdown"))
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("eval_rows"),
        *[mae(c, f"pred_{c}").alias(f"{c}_mae") for c in ("peak", "peak_day", "drawdown", "close_ret")],
        F.avg(F.abs(actual - pred)).alias("trade_mae"),
        same_sign_pct(actual_net, pred_net).alias("trade_hit_pct"),
    )
    timing = (
        F.col("peak_mae") + 0.15 * F.col("peak_day_mae") + 0.5 * F.col("drawdown_mae")
        + 0.5 * F.col("close_ret_mae") + 0.75 * F.col("trade_mae") - 0.01 * F.col("trade_hit_pct")
    )
    cycle = F.col("peak_mae") + 0.15 * F.col("peak_day_mae") + 0.5 * F.col("drawdown_mae")
    return out.withColumns({"timing_score": timing, "cycle_score": cycle})


def classification_metrics(
    df: DataFrame, by: Sequence[str], prob: str, label: str, outcome: str, high: float = 0.55, low: float = 0.45
) -> DataFrame:
    """AUC, Brier, accuracy, and outcomes of strong signals per group.

    The AUC needs an order over each group, which may be all rows; it is counted over
    distinct scores in buckets, so no group is sorted in one task.
    """
    p, y, r = F.col(prob), F.col(label), F.col(outcome)
    bull, bear = p >= high, p <= low
    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("eval_rows"),
        F.avg(y).alias("base_rate"),
        F.avg((p - y) * (p - y)).alias("brier"),
        F.avg(((p >= 0.5).cast("int") == y).cast("int")).alias("accuracy"),
        *[
            x
            for name, cond in (("bull", bull), ("bear", bear))
            for x in (
                F.count(F.when(cond, 1)).alias(f"{name}_rows"),
                F.avg(F.when(cond, r)).alias(f"{name}_ret"),
                (F.avg(F.when(cond, (r > 0).cast("int"))) * 100.0).alias(f"{name}_hit_pct"),
            )
        ],
    )
    return stats.join(auc_by(df, by, prob, label), list(by), "left").withColumn(
        "fill_score", F.col("brier") + (1 - F.col("accuracy"))
    )


def basket_returns(df: DataFrame, by: Sequence[str], prob: str, outcomes: Sequence[str], k: int) -> DataFrame:
    """Mean over days of the best ``k`` rows per day and group."""
    best = Window.partitionBy(*by, "date").orderBy(F.desc(prob), "ticker")
    picks = df.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= k)
    daily = picks.groupBy(*by, "date").agg(*[F.avg(c).alias(c) for c in outcomes])
    return daily.groupBy(*by).agg(
        F.count(F.lit(1)).alias("signal_days"),
        *[F.avg(c).alias(f"top_{c}") for c in outcomes],
        (F.avg(flag(F.col(outcomes[0]) > 0)) * 100.0).alias("top_hit_pct"),
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def group_comparison(summary: DataFrame, key: str, groups: tuple[str, str]) -> DataFrame:
    """Winner per key, best of each model group, and the challenger's lead over the baseline."""
    order = [F.col("auc").desc_nulls_last(), F.asc("brier"), F.desc("accuracy"), F.col("bull_ret").desc_nulls_last(), F.asc("model")]
    best = first_per_key(summary, [key, "model_group"], order)
    top = first_per_key(summary, [key], order).select(
        key, F.col("model_group").alias("winning_group"), F.col("model").alias("winning_model"), F.col("auc").alias("winning_auc")
    )
    sides = best.groupBy(key).agg(
        *[
            F.max(F.when(F.col("model_group") == g, F.col(c))).alias(f"{name}_{c}")
            for name, g in zip(("baseline", "challenger"), groups)
            for c in ("model", "auc", "brier", "accuracy", "bull_ret")
        ]
    )
    return top.join(sides, key).withColumns(
        {f"lead_{c}": F.col(f"challenger_{c}") - F.col(f"baseline_{c}") for c in ("auc", "accuracy", "bull_ret")}
    )


def feature_set_lift(summary: DataFrame) -> DataFrame:
    """Best model per feature set of names ``set::model`` and its AUC over the baseline set's."""
    parts = F.split("model", "::")
    rows = summary.withColumns({"feature_set": F.get(parts, F.lit(0)), "base_model": F.get(parts, F.lit(1))})
    best = first_per_key(
        rows, ["feature_set"], [F.col("auc").desc_nulls_last(), F.asc("brier"), F.asc("base_model")]
    )
    reference = best.filter("feature_set = 'baseline'").select("auc").scalar()
    return best.select(
        "feature_set", "base_model", "auc", "brier", "accuracy", (F.col("auc") - reference).alias("auc_lift")
    )


def horizon_rollup(metrics: DataFrame, by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    return metrics.groupBy(*by).agg(F.count(F.lit(1)).alias("groups"), *[F.avg(f).alias(f) for f in fields])


def top_and_bottom(df: DataFrame, by: Sequence[str], value: str, k: int = 10) -> DataFrame:
    """The ``k`` highest and lowest rows per group, stacked with a bucket label."""
    out = None
    for name, order in (("TOP", F.desc(value)), ("BOTTOM", F.asc(value))):
        w = Window.partitionBy(*by).orderBy(order, "ticker")
        part = df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)
        part = part.withColumn("bucket", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def usable_overlay(best: DataFrame, current: DataFrame) -> DataFrame:
    """Best model per key with its current signal; usable by AUC, hit rate and edge."""
    joined = best.join(current, ["ticker", "target", "horizon", "model"], "left")
    usable = (F.col("auc") >= 0.55) & (F.col("bull_hit_pct") >= 55) & (F.col("edge") > 0)
    return joined.withColumn("usable", F.coalesce(usable, F.lit(False)))


def overlay_score(overlay: DataFrame) -> DataFrame:
    """Summed votes of usable rows: a YES weighs more than a NO, longer horizons one more."""
    far = F.when(F.col("horizon") >= 10, 1).otherwise(0)
    votes = F.when(F.col("signal") == "YES", 3 + far).when(F.col("signal") == "NO", -(1 + far)).otherwise(0)
    sign = F.when(F.col("target") == "GREEN", 1).when(F.col("target") == "RED", -1).otherwise(0)
    counted = F.when(F.col("usable"), votes * sign).otherwise(0)
    return overlay.groupBy("ticker").agg(
        F.sum(counted).alias("overlay_score"), F.count(F.when(F.col("usable"), 1)).alias("usable_rows")
    )


def blend_variants(full: DataFrame, recent: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Weighted mean of two variants on their common keys; unusable weights count half each."""
    a, b = F.col("full_weight"), F.col("recent_weight")
    total = a + b
    wf = F.when(total > 0, a / non_zero(total)).otherwise(0.5)
    wr = F.when(total > 0, b / non_zero(total)).otherwise(0.5)
    other = recent.select("ticker", "horizon", "full_weight", "recent_weight", *[F.col(f).alias(f"_{f}") for f in fields])
    return full.join(other, ["ticker", "horizon"]).select(
        "ticker", "horizon", *[(F.col(f) * wf + F.col(f"_{f}") * wr).alias(f"blend_{f}") for f in fields]
    )


def clip_peak_day(x: Column, horizon: Column) -> Column:
    return clamp(x, F.lit(1.0), horizon.cast("double"))


