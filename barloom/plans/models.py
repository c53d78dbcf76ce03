"""Model jobs over the derived samples. Scores have no SQL equal; their metrics are checked in ``metrics``."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import candidates as CA
from barloom.operators import expanding as EX
from barloom.operators import features as FE
from barloom.operators import intraday as D
from barloom.operators import metrics as ME
from barloom.operators import models as MO
from barloom.operators import panel as P
from barloom.operators import targets as T
from barloom.plans import inputs as I
from barloom.plans.intraday import index_5m
from barloom.plans.panel import parts
from barloom.plans.registry import query
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage
from barloom.sources import bars as B

OHLC = ["target_open", "target_close", "target_upper", "target_lower"]


def sample(spark, d, bars):
    return cut_lineage(FE.feature_sample(bars, B.index_bars(bars), B.index_bars(bars, weighted=True)))


def ohlc_rows(spark, d, horizons=(1,)):
    bars = I.bars_table(spark, d)
    labels = T.horizon_targets(bars, max(horizons)).filter(F.col("horizon").isin(*horizons))
    return sample(spark, d, bars).join(labels, ["ticker", "date"])


@query("ohlc_walk_forward")
def ohlc_walk_forward(spark, d, min_train: int = 140, every: int = 10):
    """Walk-forward ridge of the four next-day targets on all 129 features, per instrument.

    ``min_train`` days come before the first forecast, and the model is refitted every ``every``
    days; 1 refits daily.
    """
    rows = MO.grouped_forecast(ohlc_rows(spark, d), ["ticker", "horizon"], FE.FEATURES, OHLC, min_train, every=every)
    return rounded(rows, digits=4)


@query("next_session_forecast")
def next_session_forecast(spark, d):
    """Last 30 rows held out, errors per instrument."""
    rows = MO.grouped_forecast(ohlc_rows(spark, d), ["ticker", "horizon"], FE.FEATURES, OHLC, 120, holdout=30)
    held = rows.filter("role = 'eval'")
    return held.groupBy("ticker", "horizon").agg(
        F.count(F.lit(1)).alias("eval_rows"), *[F.round(ME.mae(t, f"pred_{t}"), 4).alias(f"{t}_mae") for t in OHLC]
    )


#: Training days of the variants; None for all earlier ones.
VARIANTS = {"full": None, "recent": 252, "quarter": 63}
ACTUALS = ["base_close", "forecast_date", "actual_open", "actual_high", "actual_low", "actual_close"]


def range_race(spark, d, bars=None, horizons=tuple(range(1, 11)), variants=VARIANTS, features=None):
    """Ridge and forest forecasts of the next days' open, close and wicks, three variants, last 30 days held out."""
    bars = bars if bars is not None else I.bars_table(spark, d)
    labels = T.horizon_targets(bars, max(horizons)).filter(F.col("horizon").isin(*horizons))
    features = features if features is not None else sample(spark, d, bars)
    rows = cut_lineage(features.join(labels, ["ticker", "date"]))
    return cut_lineage(CA.race(rows, ["ticker", "horizon"], FE.BASE, OHLC, variants, 30, 20, ACTUALS))


def chosen_now(predicted, keys, targets, weights=None):
    """Current rows of the best candidate per key, with its held-out error."""
    best = CA.choose(CA.held_out_errors(predicted, [*keys, "variant", "model"], targets, weights), keys, ["model", "variant"])
    now = predicted.filter("role = 'current'").drop("role", *targets)
    return best.select(*keys, "model", "variant", "eval_rows", "error").join(now, [*keys, "model", "variant"])


@query("range_forecast")
def range_forecast(spark, d):
    """Best of two models and three variants by held-out error, per instrument and each of ten horizons, with its current forecast."""
    return rounded(chosen_now(range_race(spark, d), ["ticker", "horizon"], OHLC).drop(*ACTUALS[1:]), digits=4)


EXCURSIONS = ["peak", "peak_day", "drawdown", "close_ret"]
# Weights of the errors in the choice of a timing and of a cycle forecast.
TIMING_WEIGHTS = {"peak": 1.0, "peak_day": 0.15, "drawdown": 0.5, "close_ret": 0.5}
CYCLE_WEIGHTS = {"peak": 1.0, "peak_day": 0.15, "drawdown": 0.5}


def timing_race(spark, d, bars=None, horizons=(3, 5, 10), variants=VARIANTS, features=None):
    bars = bars if bars is not None else I.bars_table(spark, d)
    features = features if features is not None else sample(spark, d, bars)
    rows = features.join(T.excursion_samples(bars, horizons), ["ticker", "date"]).join(bars.select("ticker", "date", "close"), ["ticker", "date"])
    return cut_lineage(CA.race(cut_lineage(rows), ["ticker", "horizon"], FE.BASE, EXCURSIONS, variants, 40, 80, ["close"]))


@query("timing_forecast")
def timing_forecast(spark, d):
    """Peak, day, drawdown and close within 3, 5 and 10 sessions: the best of two models and three variants, 40 days held out."""
    return rounded(chosen_now(timing_race(spark, d), ["ticker", "horizon"], EXCURSIONS, TIMING_WEIGHTS).drop("close"), digits=4)


def cycle_race(spark, d, bars=None, variants=VARIANTS):
    bars = bars if bars is not None else I.bars_table(spark, d)
    rows = sample(spark, d, bars).join(T.cycle_samples(bars), ["ticker", "date"])
    return cut_lineage(CA.race(cut_lineage(rows), ["ticker", "months"], FE.BASE, EXCURSIONS[:3], variants, 40, 80))


@query("cycle_forecast")
def cycle_forecast(spark, d):
    """Peak, day and drawdown within one to six months: the best of two models and three variants, 40 days held out."""
    return rounded(chosen_now(cycle_race(spark, d), ["ticker", "months"], EXCURSIONS[:3], CYCLE_WEIGHTS), digits=4)


@query("rest_of_session_forecast")
def rest_of_session_forecast(spark, d):
    """Rest-of-session targets from intraday snapshots; the last 25 rows are held out."""
    bars = cut_lineage(I.bars_5m(spark, d))
    rows = D.snapshot_sample(D.intraday_snapshots(bars), D.intraday_snapshots(index_5m(bars)))
    skip = {"ticker", *D.KEYS, *D.TARGETS}
    features = [c for c, t in rows.dtypes if c not in skip and t in ("double", "bigint", "int")]
    out = MO.grouped_forecast(rows, ["ticker"], features, list(D.TARGETS), 10, holdout=25, order="bar_ts")
    return rounded(out, digits=4)


COLORS = ("is_green", "is_red", "is_ceiling", "is_floor")


@query("color_classifier")
def color_classifier(spark, d, horizons: tuple = (1, 3, 5, 10), min_train: int = 120, every: int = 10):
    """Up-day, down-day and limit-touch probabilities per instrument and horizon, walk-forward.

    ``every`` is the number of days between refits.
    """
    rows = T.color_labels(ohlc_rows(spark, d, horizons))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).cast("double").alias("label")) for c in COLORS]))
    rows = rows.select("ticker", "horizon", "date", *FE.BASE, each.alias("_l")).select("*", "_l.target", "_l.label").drop("_l")
    out = MO.grouped_forecast(rows, ["ticker", "horizon", "target"], FE.BASE, ["label"], min_train, every=every, fit=MO.logistic)
    return rounded(out, digits=4)


def touch_race(spark, d):
    """(labels, predictions): held-out and current touch probabilities of a logistic per instrument and horizon and a pooled forest.

    Both learn from all depths of the grid; a quarter of the days, 15 to 40, is held out.
    """
    bars = I.bars_table(spark, d)
    labels = cut_lineage(T.touch_labels(bars))
    rows = cut_lineage(sample(spark, d, bars).join(labels, ["ticker", "date"]).withColumn("depth_key", F.col("depth")))
    features = [*FE.BASE, "atr_pct", "entry_pct", "depth"]
    own = MO.grouped_forecast(
        rows, ["ticker", "horizon"], features, ["touched"], 120, holdout=MO.fill_holdout, fit=MO.logistic, carry=["depth_key"]
    ).withColumn("model", F.lit("logistic"))
    pooled = CA.pooled_forest(rows, ["ticker", "horizon"], features, ["touched"], {"full": None}, MO.fill_holdout, ["depth_key"]).drop("variant")
    return labels, cut_lineage(own.unionByName(pooled.withColumn("model", F.lit("forest"))))


def fill_choice(labels, predicted):
    keys = ["ticker", "horizon"]
    scores = CA.fill_scores(predicted.filter("role = 'eval'"), keys, "touched", "pred_touched")
    wanted = labels.groupBy(*keys).agg(F.avg("touched").alias("positive_rate"))
    return CA.choose_fill(wanted, scores, keys)


@query("fill_model_choice")
def fill_model_choice(spark, d):
    """The fill model of every instrument and horizon by Brier loss plus error rate on held-out days, or the fallback."""
    return rounded(fill_choice(*touch_race(spark, d)), digits=4)


@query("touch_classifier")
def touch_classifier(spark, d):
    """Touch probability by horizon and depth from the chosen model; the depth's base rate where none could be scored."""
    labels, predicted = touch_race(spark, d)
    best = fill_choice(labels, predicted).select("ticker", "horizon", "model")
    current = predicted.filter("role = 'current'").join(best, ["ticker", "horizon", "model"]).select(
        "ticker", "horizon", F.col("depth_key").alias("depth"), "model", F.least(F.greatest("pred_touched", F.lit(0.0)), F.lit(1.0)).alias("model_prob")
    )
    base = labels.groupBy("ticker", "horizon", "depth").agg(F.avg("touched").alias("base_rate"))
    return rounded(MO.with_fallback(base, current, ["ticker", "horizon", "depth"], "model_prob", "base_rate"), digits=4)


POOLED = "ret5 ret20 ret60 dist20 dist50 vol_ratio20 rel20 rel60 rel20_rank rel60_rank corr20 beta20 sector_breadth20 sector_rank".split()


def outperform_rows(spark, d):
    panel, _, _ = parts(spark, d)
    rows = P.feature_panel(panel).withColumn(
        "label", F.when(F.col("excess10").isNotNull(), (F.col("excess10") > 0).cast("double"))
    )
    return rows.filter("dist50 is not null").select("ticker", "sector", "date", "label", "excess10", *POOLED)


@query("pooled_outperform")
def pooled_outperform(spark, d, min_train: int = 80, every: int = 5):
    """Pooled logistic walk-forward: will an instrument beat the index over ten days.

    Refitted every ``every`` days from ``min_train`` days on, all refits in shared passes.
    """
    out = EX.expanding_logistic(outperform_rows(spark, d), POOLED, ["sector"], "label", min_train, every)
    return rounded(out.select("ticker", "date", "role", "label", "prob"), digits=4)


@query("pooled_outperform_boosted")
def pooled_outperform_boosted(spark, d, min_train: int = 80, every: int = 10):
    """The boosted challenger of the same job."""
    out = MO.pooled_walk_forward(outperform_rows(spark, d), POOLED, ["sector"], "label", "boosted", min_train, every)
    return rounded(out.select("ticker", "date", "role", "label", "prob"), digits=4)


MARKET = ["i_ret5", "i_ret20", "i_range20", "breadth20", "breadth50", "positive5", "dispersion20", "median_rel20", "mean_corr20"]


@query("market_direction")
def market_direction(spark, d, horizons: tuple = (5, 10), min_train: int = 80, every: int = 5):
    """Direction of the index over five and ten days, walk-forward, with UP and DOWN calls.

    Refitted every ``every`` days from ``min_train`` days on, all refits of a horizon in shared passes.
    """
    panel, sectors, idx = parts(spark, d)
    rows = cut_lineage(P.market_panel(panel, sectors, idx))
    out = None
    for h in horizons:
        ahead = F.col(f"i_fwd{h}")
        known = rows.withColumn("label", F.when(ahead.isNotNull(), (ahead > 0).cast("double"))).select("date", "label", *MARKET)
        one = EX.expanding_logistic(known, MARKET, [], "label", min_train, every).withColumn("horizon", F.lit(h))
        out = one if out is None else out.unionByName(one)
    return rounded(out.select("date", "horizon", "role", "label", "prob").withColumn("call", MO.direction_call(F.col("prob"))), digits=4)
