"""Model jobs: per-group fits inside Spark groups, pooled fits with Spark ML.

Per-group fits (one instrument and horizon) see at most one row per trading day, so a
group is small whatever the data volume. Pooled models use Spark ML on the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import boosted as BO
from barloom.session import cut_lineage, new_path


def _prepare(train: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median imputation and scaling by the training rows' population deviation."""
    with np.errstate(all="ignore"):
        known = ~np.isnan(train).all(axis=0)
        middle = np.where(known, np.nanmedian(np.where(known, train, 0.0), axis=0), 0.0)
    fill = lambda x: np.where(np.isnan(x), middle, x)
    train, test = fill(train), fill(test)
    mean, std = train.mean(axis=0), train.std(axis=0)
    std = np.where(std == 0, 1.0, std)
    return (train - mean) / std, (test - mean) / std


def ridge(train: np.ndarray, y: np.ndarray, test: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Ridge predictions for several targets at once; the intercept is not penalised."""
    x, z = _prepare(train, test)
    centre = y.mean(axis=0)
    weights = np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ (y - centre))
    return z @ weights + centre


def logistic(train: np.ndarray, y: np.ndarray, test: np.ndarray, penalty: float = 1.0, steps: int = 25) -> np.ndarray:
    """Ridge-penalised logistic probabilities by Newton steps."""
    x, z = _prepare(train, test)
    x, z = np.c_[np.ones(len(x)), x], np.c_[np.ones(len(z)), z]
    keep = np.eye(x.shape[1]) * penalty
    keep[0, 0] = 1e-9
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - keep @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + keep
        move = np.linalg.solve(curve, slope)
        beta += move
        if np.abs(move).max() < 1e-8:
            break
    return 1.0 / (1.0 + np.exp(-np.clip(z @ beta, -30, 30)))


def grouped_forecast(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    targets: Sequence[str],
    min_train: int,
    every: int | None = None,
    holdout: int | Callable[[int], int] | None = None,
    train_last: int | Mapping[str, int | None] | None = None,
    fit: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = ridge,
    order: str = "date",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Out-of-sample and current predictions per group.

    Counts are of distinct values of ``order`` (days) with known targets; a group may have
    several rows a day. With ``every`` the model is refitted before each block of that many days
    on strictly earlier ones, from ``min_train`` days on (walk-forward); with ``holdout`` the last
    days (a number, or a function of the number of days) are kept out once. ``train_last`` slices
    every training set to its last days; a mapping of names to such numbers (None for all days) gives
    rows for each, with its name as ``variant``. The rows of the latest day are scored by a fit on all
    earlier labelled rows. Groups that are too short give no rows. Output: keys, order column,
    role (``eval`` or ``current``), ``carry`` columns of the row, targets, ``pred_`` columns.
    """
    keys, features, targets = list(keys), list(features), list(targets)
    named = isinstance(train_last, Mapping)
    variants = dict(train_last) if named else {"": train_last}
    schema = T.StructType(
        [rows.schema[c] for c in (*keys, order, *carry)]
        + [T.StructField("variant", T.StringType())] * named
        + [T.StructField("role", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for t in targets for c in (t, f"pred_{t}")]
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        known = pdf[targets].notna().all(axis=1).to_numpy()
        x = pdf[features].to_numpy(dtype=float)
        y = pdf[targets].to_numpy(dtype=float)
        labelled = np.flatnonzero(known)
        moments = pdf[order].to_numpy()
        days, first = np.unique(moments[labelled], return_index=True)
        first = np.append(first, len(labelled))
        n = len(days)
        spans = []
        if every is not None:
            spans = [(start, min(start + every, n)) for start in range(min_train, n, every)]
        else:
            out = holdout(n) if callable(holdout) else holdout or 0
            if n >= min_train + out:
                spans = [(n - out, n)]

        def before(day: int, last: int | None) -> np.ndarray:
            return labelled[first[max(0, day - last) if last else 0] : first[day]]

        parts = []

        def emit(index: np.ndarray, predicted: np.ndarray, role: str, variant: str) -> None:
            part = pdf.loc[index, [*keys, order, *carry]].copy()
            part["role"] = role
            part["variant"] = variant
            for j, t in enumerate(targets):
                part[t] = y[index, j]
                part[f"pred_{t}"] = predicted.reshape(len(index), -1)[:, j]
            parts.append(part)

        for variant, last in variants.items():
            for start, end in spans:
                train, test = before(start, last), labelled[first[start] : first[end]]
                if len(train) and len(test) and _varied(fit, y[train]):
                    emit(test, fit(x[train], _target(fit, y[train]), x[test]), "eval", variant)
            if spans:
                newest = np.flatnonzero(moments == moments[-1])
                train = before(int(np.searchsorted(days, moments[-1])), last)
                if len(train) and _varied(fit, y[train]):
                    emit(newest, fit(x[train], _target(fit, y[train]), x[newest]), "current", variant)
        if not parts:
            return pd.DataFrame(columns=[f.name for f in schema.fields])
        return pd.concat(parts, ignore_index=True)[[f.name for f in schema.fields]]

    wanted = rows.select(*keys, order, *carry, *features, *[t for t in targets if t not in features])
    return wanted.groupBy(*keys).applyInPandas(run, schema)


def _varied(fit, y: np.ndarray) -> bool:
    """A classifier needs both classes among its training rows."""
    return fit is not logistic or len(np.unique(y[:, 0])) > 1


def _target(fit, y: np.ndarray) -> np.ndarray:
    return y[:, 0] if fit is logistic else y


def fill_holdout(dates: int) -> int:
    """Days kept out for touch models: a quarter of the history, at least 15, at most 40."""
    return min(40, max(15, dates // 4))


def with_fallback(wanted: DataFrame, predictions: DataFrame, keys: Sequence[str], prob: str, heuristic: str) -> DataFrame:
    """Model probability where a group could be fitted, else the heuristic."""
    return wanted.join(predictions, list(keys), "left").withColumns(
        {"prob": F.coalesce(prob, heuristic), "source": F.when(F.col(prob).isNull(), "heuristic_fallback").otherwise("model")}
    )


def preprocessing(features: Sequence[str], categories: Sequence[str]) -> list:
    """Median imputation, standardisation and one-hot encoding as Spark ML stages; unknown categories become zeros."""
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    filled = [f"{f}__in" for f in features]
    stages = [
        Imputer(strategy="median", relativeError=0.0, inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_num"),
        StandardScaler(withMean=True, withStd=True, inputCol="_num", outputCol="_std"),
    ]
    vectors = ["_std"]
    for c in categories:
        stages += [
            StringIndexer(inputCol=c, outputCol=f"{c}__ix", handleInvalid="keep"),
            OneHotEncoder(inputCol=f"{c}__ix", outputCol=f"{c}__oh", dropLast=True),
        ]
        vectors.append(f"{c}__oh")
    return [*stages, VectorAssembler(inputCols=vectors, outputCol="features")]


def classifiers(label: str) -> dict[str, Callable]:
    """Baseline and challenger estimators by name."""
    from pyspark.ml import classification as C

    return {
        "logistic": lambda n: C.LogisticRegression(labelCol=label, maxIter=100, regParam=1e-3),
        "random_forest": lambda n: C.RandomForestClassifier(labelCol=label, numTrees=100, maxDepth=8, minInstancesPerNode=8, seed=42),
        "boosted": lambda n: C.GBTClassifier(labelCol=label, maxDepth=3, stepSize=0.05, maxIter=60, seed=42),
        "boosted_sampled": lambda n: C.GBTClassifier(
            labelCol=label, maxDepth=4, stepSize=0.05, maxIter=60, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42
        ),
        "network": lambda n: C.MultilayerPerceptronClassifier(labelCol=label, layers=[n, 24, 12, 2], maxIter=100, seed=42),
        "deep_network": lambda n: C.MultilayerPerceptronClassifier(labelCol=label, layers=[n, 48, 24, 12, 2], maxIter=100, seed=42),
    }


def pooled_walk_forward(
    rows: DataFrame,
    features: Sequence[str],
    categories: Sequence[str],
    label: str,
    model: str,
    min_train_dates: int,
    every: int,
) -> DataFrame:
    """Pooled expanding-window classification: refit before each block of dates on strictly earlier dates.

    Only the list of block starts comes to the driver. Each block's scores are written once when
    its model is fitted, and the result reads them, so the plan does not grow with the number of
    blocks. A last fit on all labelled rows scores the latest date. Adds ``prob``, ``role`` and
    ``model``. Blocks of ``boosted`` are fitted side by side unless a task cannot hold the labelled
    rows; then, and for the other models, one after the other.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = cut_lineage(rows.withColumns({f: F.col(f).cast("double") for f in features}))
    labelled = rows.filter(F.col(label).isNotNull())
    dates = [r[0] for r in labelled.select("date").distinct().orderBy("date").collect()]
    starts = dates[min_train_dates::every]
    if model == "boosted" and labelled.count() <= BO.ROWS:
        return BO.expanding_boosted(rows, features, categories, label, starts, rows.agg(F.max("date")).first()[0])
    edges = [*starts, None]
    since = sorted(r[0] for r in labelled.groupBy(label).agg(F.min("date")).select("min(date)").collect())  # of each class
    schema = T.StructType([*rows.schema, T.StructField("prob", T.DoubleType()), T.StructField("role", T.StringType()), T.StructField("model", T.StringType())])
    path = new_path(rows.sparkSession)
    rows.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema[-3:]]).write.parquet(path)

    def score(before, test: DataFrame, role: str) -> None:
        if sum(day < before for day in since) < 2:
            return
        train = labelled.filter(F.col("date") < F.lit(before))
        head = Pipeline(stages=preprocessing(features, categories)).fit(train)
        prepared = head.transform(train)
        width = prepared.schema["features"].metadata["ml_attr"]["num_attrs"]
        fitted = classifiers(label)[model](width).fit(prepared)
        probability = vector_to_array(F.col("probability"))[1]
        scored = fitted.transform(head.transform(test))
        scored.select(*rows.columns, probability.alias("prob"), F.lit(role).alias("role"), F.lit(model).alias("model")).write.mode("append").parquet(path)

    for start, end in zip(edges, edges[1:]):
        block = F.col("date") >= F.lit(start)
        if end is not None:
            block = block & (F.col("date") < F.lit(end))
        score(start, labelled.filter(block), "eval")
    newest = rows.agg(F.max("date")).first()[0]
    if newest is not None:
        score(newest, rows.filter(F.col("date") == F.lit(newest)), "current")
    return rows.sparkSession.read.schema(schema).parquet(path)


def direction_call(prob, high: float = 0.55, low: float = 0.45):
    return F.when(prob >= high, "UP").when(prob <= low, "DOWN").otherwise("NEUTRAL")
