"""Several forecasts of the same targets side by side, and the choice of the best per key by held-out error.

Per-key ridge runs inside groups of one row a day; pooled forests come from Spark ML and learn
from all keys at once. Both hold out the same last days and forecast the newest one, so their
rows can be stacked, scored and chosen by plain aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.models import grouped_forecast
from barloom.session import cut_lineage

#: What trees see in place of a missing value.
MISSING = -1e9
#: Pooled fits that run at a time.
PARALLEL = 6


Holdout = int | Callable[[int], int]


def spans(labelled: DataFrame, by: str, order: str, holdout: Holdout, last: int | None, newest) -> dict:
    """For each ``by`` (``from``, ``cut``, ``now_from``): training starts and the first held-out day, over its labelled days.

    Days come to the driver, one list a value of ``by``.
    """
    out = {}
    for r in labelled.groupBy(by).agg(F.sort_array(F.collect_set(order)).alias("days")).collect():
        days = r["days"]
        cut = len(days) - (holdout(len(days)) if callable(holdout) else holdout)
        if cut <= 0:
            continue
        known = [d for d in days if d < newest]
        out[r[by]] = (days[max(0, cut - last) if last else 0], days[cut], known[max(0, len(known) - last) if last else 0])
    return out


def pooled_forest(
    rows: DataFrame, keys: Sequence[str], features: Sequence[str], targets: Sequence[str], variants: Mapping[str, int | None], holdout: Holdout,
    carry: Sequence[str] = (), order: str = "date", trees: int = 16, depth: int = 5,
) -> DataFrame:
    """Held-out (``eval``) and ``current`` predictions of one forest per target and variant over all keys.

    ``keys`` are a name and a number (the horizon), both features besides ``features``; missing
    values stand below all others. The last ``holdout`` labelled days of each horizon are kept out; a variant's number limits training to the last such
    many days, as in ``grouped_forecast``. Each key's last row is scored by a fit on the labelled
    days before the newest one. Columns as there; without enough days there are no rows.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    name, number = keys
    known = None
    for t in targets:
        known = F.col(t).isNotNull() if known is None else known & F.col(t).isNotNull()
    numeric = [*features, number]
    given = rows.select(*keys, order, *carry, *targets, *[F.coalesce(F.col(f).cast("double"), F.lit(MISSING)).alias(f"_x_{f}") for f in numeric]).withColumn("_known", known)
    last = given.groupBy(*keys).agg(F.max(order).alias("_last"))
    given = cut_lineage(given.join(last, list(keys)))
    newest = given.agg(F.max(order)).first()[0]
    labelled = given.filter("_known")
    ends = ["role", "variant", *[c for t in targets for c in (t, f"pred_{t}")]]
    kinds = ["string", "string", *["double"] * (2 * len(targets))]
    wanted = [*keys, order, *carry]
    empty = given.limit(0).select(*wanted, *[F.lit(None).cast(k).alias(c) for c, k in zip(ends, kinds)])

    def job(variant: str, role: str, limits: dict) -> DataFrame:
        """Fits and scores of one variant: for each horizon (a few numbers) its own days."""
        train = test = F.lit(False)
        for h, (since, cut, now) in limits.items():
            own = F.col(number) == F.lit(h)
            if role == "eval":
                train = train | (own & (F.col(order) >= F.lit(since)) & (F.col(order) < F.lit(cut)))
                test = test | (own & (F.col(order) >= F.lit(cut)))
            else:
                train = train | (own & (F.col(order) >= F.lit(now)) & (F.col(order) < F.lit(newest)))
                test = test | own
        test = test & (F.col("_known") if role == "eval" else F.col(order) == F.col("_last"))
        head = Pipeline(
            stages=[
                StringIndexer(inputCol=name, outputCol="_name", handleInvalid="keep"),
                VectorAssembler(inputCols=["_name", *[f"_x_{f}" for f in numeric]], outputCol="features"),
            ]
        ).fit(labelled.filter(train))
        training = cut_lineage(head.transform(labelled.filter(train)).select("features", *targets))
        scored = head.transform(given.filter(test))
        for t in targets:
            forest = RandomForestRegressor(
                labelCol=t, predictionCol=f"pred_{t}", numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, subsamplingRate=0.5, seed=42
            )
            scored = forest.fit(training).transform(scored)
        parts = [F.lit(role), F.lit(variant), *[F.col(c) for t in targets for c in (t, f"pred_{t}")]]
        return scored.select(*wanted, *[c.cast(k).alias(n) for c, n, k in zip(parts, ends, kinds)])

    jobs = []
    for variant, days in variants.items() if newest is not None else ():
        limits = spans(labelled, number, order, holdout, days, newest)
        jobs += [(variant, role, limits) for role in ("eval", "current") if limits]
    if not jobs:
        return empty
    with ThreadPool(PARALLEL) as pool:
        made = pool.starmap(job, jobs)
    out = made[0]
    for part in made[1:]:
        out = out.unionByName(part)
    return out


def race(
    rows: DataFrame, keys: Sequence[str], features: Sequence[str], targets: Sequence[str], variants: Mapping[str, int | None],
    holdout: int, min_train: int, carry: Sequence[str] = (), **forest,
) -> DataFrame:
    """Stacked predictions of ridge and forest for every variant (days of training, None for all): adds ``model`` and ``variant``."""
    own = grouped_forecast(rows, keys, features, targets, min_train, holdout=holdout, train_last=variants, carry=carry)
    pooled = pooled_forest(rows, keys, features, targets, variants, holdout, carry, **forest)
    return own.withColumn("model", F.lit("ridge")).unionByName(pooled.withColumn("model", F.lit("forest")))


def held_out_errors(predicted: DataFrame, by: Sequence[str], targets: Sequence[str], weights: Mapping[str, float] | None = None) -> DataFrame:
    """Mean absolute error of each target over the held-out rows, and ``error``, their weighted sum (weight 1 unless given)."""
    weights = weights or {}
    held = predicted.filter("role = 'eval'")
    out = held.groupBy(*by).agg(F.count(F.lit(1)).alias("eval_rows"), *[F.avg(F.abs(F.col(t) - F.col(f"pred_{t}"))).alias(f"{t}_mae") for t in targets])
    total = None
    for t in targets:
        part = F.col(f"{t}_mae") * F.lit(float(weights.get(t, 1.0)))
        total = part if total is None else total + part
    return out.withColumn("error", total)


def choose(errors: DataFrame, keys: Sequence[str], among: Sequence[str], error: str = "error") -> DataFrame:
    """Of each key the row with the smallest error, ties by the names in ``among``; one aggregate."""
    rest = [c for c in errors.columns if c not in keys]
    return errors.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(error, *among)).alias("_r")).select(*keys, "_r.*")


def fill_scores(predicted: DataFrame, keys: Sequence[str], target: str, prob: str) -> DataFrame:
    """Of each key and model over its held-out rows: rows, positive rate, Brier loss, accuracy and their selection score.

    Only keys whose held-out rows have both outcomes are scored; probabilities are kept off 0 and 1.
    """
    p = F.least(F.greatest(F.col(prob), F.lit(1e-6)), F.lit(1 - 1e-6))
    y = F.col(target)
    out = predicted.filter(F.col(target).isNotNull() & F.col(prob).isNotNull()).groupBy(*keys, "model").agg(
        F.count(F.lit(1)).alias("eval_rows"),
        F.avg(y).alias("positive_rate"),
        F.avg((p - y) * (p - y)).alias("brier"),
        F.avg(((p >= 0.5).cast("double") == y).cast("double")).alias("accuracy"),
    )
    out = out.filter((F.col("positive_rate") > 0) & (F.col("positive_rate") < 1))
    return out.withColumn("selection_score", F.col("brier") + 1.0 - F.col("accuracy"))


def choose_fill(wanted: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The model with the least selection score for every wanted key (with its positive_rate), else ``heuristic_fallback``."""
    best = choose(scores.withColumnRenamed("positive_rate", "held_rate"), keys, ["model"], "selection_score")
    rows = wanted.select(*keys, "positive_rate").join(best, list(keys), "left")
    return rows.withColumns(
        {
            "model": F.coalesce("model", F.lit("heuristic_fallback")),
            "eval_rows": F.coalesce("eval_rows", F.lit(0).cast("long")),
            "positive_rate": F.coalesce("held_rate", "positive_rate"),
        }
    ).select(*keys, "model", "eval_rows", "positive_rate", "brier", "accuracy", "selection_score")
