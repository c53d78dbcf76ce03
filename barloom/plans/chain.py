"""The decision chain over fitted forecasts: metrics, choice, ladder, watchlist and verdicts.

The same functions as over the naive forecasts of ``metrics``, fed with what ``models`` predicts.
The scores have no SQL; the steps after them are checked with the same SQL over stored scores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import expanding as EX
from barloom.operators import metrics as ME
from barloom.operators import panel as P
from barloom.plans import decisions as DP
from barloom.plans import inputs as I
from barloom.plans import market as PM
from barloom.plans import metrics as PX
from barloom.plans import models as M
from barloom.plans.panel import parts
from barloom.plans.registry import query
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage

#: Variants the chain uses, and the models whose ranges are blended.
VARIANTS = {"full": None, "recent": 252}
BLENDED = ("ridge_full", "ridge_recent")


def _named(rows):
    return rows.withColumn("model", F.concat_ws("_", "model", "variant")).drop("variant", "role")


def scores(spark, d, bars):
    """(OHLC, timing) predictions of every candidate with the naive ones on the same rows, as the metrics take them."""
    features = M.sample(spark, d, bars)
    ohlc = _named(M.range_race(spark, d, bars, PX.HORIZONS, VARIANTS, features))
    for f in PX.OHLC:
        ohlc = ohlc.withColumnRenamed(f"pred_target_{f}", f"pred_{f}")
    timing = _named(M.timing_race(spark, d, bars, variants=VARIANTS, features=features))
    out = []
    for fitted, naive in (
        (ohlc, PX.ohlc_forecasts(spark, d, bars)),
        (timing, PX.timing_forecasts(spark, d, bars).join(bars.select("ticker", "date", "close"), ["ticker", "date"])),
    ):
        keys = ["ticker", "horizon", "date"]
        naive = naive.join(fitted.select(*keys).distinct(), keys, "left_semi").select(*fitted.columns)
        out.append(cut_lineage(fitted.unionByName(naive)))
    return tuple(out)


def inputs(spark, d):
    bars = I.bars_table(spark, d)
    ohlc, timing = scores(spark, d, bars)
    return bars, cut_lineage(PM.members(spark, d, bars)), priced(ohlc), timing


def priced(ohlc):
    return cut_lineage(ME.attach_actuals(ME.reconstruct(ohlc)))


@query("model_metrics_by_ticker")
def model_metrics_by_ticker(spark, d):
    """Error set of every candidate, fitted and naive, per instrument and horizon on the held-out days."""
    ohlc = M.range_race(spark, d, horizons=PX.HORIZONS, variants=VARIANTS)
    rows = _named(ohlc)
    for f in PX.OHLC:
        rows = rows.withColumnRenamed(f"pred_target_{f}", f"pred_{f}")
    return rounded(ME.ohlc_metrics(priced(rows).filter("actual_close is not null and pred_close is not null"), ["ticker", "model", "horizon"]))


def ladder(spark, d, bars, people, ohlc, timing):
    return DP.ladder_parts(spark, d, people, ohlc, timing, BLENDED)


@query("entry_ladder_from_models")
def entry_ladder_from_models(spark, d):
    return rounded(ladder(spark, d, *inputs(spark, d))[1], "limit_price")


@query("verdicts_from_models")
def verdicts_from_models(spark, d):
    given = inputs(spark, d)
    return DP.verdicts_of(spark, d, given[0], given[1], *ladder(spark, d, *given))


@query("watchlist_from_models")
def watchlist_from_models(spark, d):
    given = inputs(spark, d)
    return DP.watchlist(spark, d, given[0], given[1], *ladder(spark, d, *given))


#: Nested feature sets of the lift study; each holds the one before.
FEATURE_SETS = {
    "baseline": ["ret5", "ret20", "ret60", "dist20", "dist50", "vol_ratio20"],
    "relative": ["ret5", "ret20", "ret60", "dist20", "dist50", "vol_ratio20", "rel20", "rel60", "rel20_rank", "rel60_rank"],
    "market": M.POOLED,
}


def lift_scores(spark, d, horizons=(5, 10), min_train: int = 80, every: int = 5):
    """Walk-forward scores of one logistic per nested feature set on the same rows and blocks: will an instrument beat the index."""
    panel, _, _ = parts(spark, d)
    rows = cut_lineage(P.feature_panel(panel).filter("dist50 is not null").select("ticker", "sector", "date", "excess5", "excess10", *M.POOLED))
    out = None
    for h in horizons:
        ahead = F.col(f"excess{h}")
        known = rows.withColumns({"label": F.when(ahead.isNotNull(), (ahead > 0).cast("double")), "ret": ahead})
        for name, features in FEATURE_SETS.items():
            one = EX.expanding_logistic(known, features, ["sector"], "label", min_train, every).filter("role = 'eval'").select(
                "ticker", "date", F.lit(h).alias("horizon"), "ret", F.col("label").cast("int").alias("y"), F.lit(f"{name}::logistic").alias("model"),
                F.lit("baseline" if name == "baseline" else "challenger").alias("model_group"), "prob",
            )
            out = one if out is None else out.unionByName(one)
    return cut_lineage(out)


def lift_of(scores):
    """Lift of every feature set over the baseline set, per horizon."""
    summary = cut_lineage(ME.classification_metrics(scores, ["model", "model_group", "horizon"], "prob", "y", "ret"))
    out = None
    for h in [r[0] for r in summary.select("horizon").distinct().orderBy("horizon").collect()]:
        one = ME.feature_set_lift(summary.filter(F.col("horizon") == h)).withColumn("horizon", F.lit(h))
        out = one if out is None else out.unionByName(one)
    return out


@query("feature_set_lift_fitted")
def feature_set_lift_fitted(spark, d):
    """AUC, Brier loss and accuracy of fits on nested feature sets, and their lift over the first."""
    return rounded(lift_of(lift_scores(spark, d)))
