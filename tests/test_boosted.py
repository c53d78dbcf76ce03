"""Boosted walk-forward: blocks side by side against separate fits of Spark ML, cuts against the plain rule."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barloom.operators import boosted as BO
from barloom.operators import models as MO

FEATURES = ["a", "b", "c", "same"]
SCHEMA = "ticker string, date date, sector string, a double, b double, c double, same double, label double"
DAYS = pd.date_range("2020-01-01", periods=130).date


def rows(tickers=14):
    """Missing values, few values, one value, a missing and a late category, repeated rows, the newest day unlabelled."""
    rng = np.random.default_rng(11)
    out = []
    for j in range(tickers):
        for k, day in enumerate(DAYS):
            a, b = rng.normal(0, 1, 2)
            label = float(a + 0.5 * b * b + (j % 3) + rng.normal(0, 1.5) > 1.2) if k < len(DAYS) - 1 else None
            sector = None if j == 5 else "late" if j == 6 and k > 110 else f"s{j % 3}"
            out.append((f"t{j}", day, sector, float(a), None if k % 7 == j % 7 else float(b), float(rng.integers(0, 4)), 2.0, label))
    return [*out, *out[300:340]]


def stored(spark, given):
    return MO.cut_lineage(spark.createDataFrame(given, SCHEMA))


def test_blocks_equal_separate_fits_of_spark_ml(spark, monkeypatch):
    df = stored(spark, rows())
    with monkeypatch.context() as m:
        m.setattr(MO, "classifiers", lambda label: pytest.fail("a fit of Spark ML for each block"))
        got = MO.pooled_walk_forward(df, FEATURES, ["sector"], "label", "boosted", 99, 16)
        pdf = got.toPandas()
    assert got.columns == [*df.columns, "prob", "role", "model"]
    assert set(pdf[pdf.role == "eval"].date) == set(DAYS[99:129]) and set(pdf[pdf.role == "current"].date) == {DAYS[-1]}
    assert len(pdf) == df.filter(F.col("date") >= F.lit(DAYS[99])).count()
    for start, end, role in ((DAYS[115], DAYS[129], "eval"), (DAYS[129], None, "current")):
        train = df.filter(F.col("label").isNotNull() & (F.col("date") < F.lit(start)))
        test = df.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end) if end else F.lit(True)))
        head = Pipeline(stages=MO.preprocessing(FEATURES, ["sector"])).fit(train)
        fitted = MO.classifiers("label")["boosted"](0).fit(head.transform(train))
        want = fitted.transform(head.transform(test)).select("ticker", "date", vector_to_array("probability")[1].alias("want")).toPandas()
        both = want.merge(pdf[pdf.role == role], on=["ticker", "date"])
        assert len(both) == len(want) > 0 and np.allclose(both.want, both.prob, atol=1e-9)


def test_without_both_classes_and_without_rows(spark):
    given = [r[:7] + (None if r[7] is None else r[7] if r[1] > DAYS[40] else 0.0,) for r in rows(3)]
    got = MO.pooled_walk_forward(stored(spark, given), FEATURES, ["sector"], "label", "boosted", 30, 10).toPandas()
    assert min(got.date) == DAYS[50] and (got.role == "current").sum() == 3
    one = [r[:7] + (1.0,) for r in rows(1)]
    assert MO.pooled_walk_forward(stored(spark, one), FEATURES, [], "label", "boosted", 30, 10).collect() == []
    assert MO.pooled_walk_forward(stored(spark, []), FEATURES, ["sector"], "label", "boosted", 30, 10).collect() == []


def test_more_rows_than_a_task_holds_are_fitted_by_spark_ml(spark, monkeypatch):
    class Called(Exception):
        pass

    def called(label):
        raise Called

    monkeypatch.setattr(BO, "ROWS", 10)
    monkeypatch.setattr(MO, "classifiers", called)
    with pytest.raises(Called):
        MO.pooled_walk_forward(stored(spark, rows(3)), FEATURES, ["sector"], "label", "boosted", 99, 16)


def plain_cuts(values, counts):
    n, bins = sum(counts), min(BO.BINS, sum(counts))
    if len(values) <= bins:
        return [(a + b) / 2 for a, b in zip(values, values[1:])]
    out, upto, target = [], counts[0], n / bins
    for k in range(1, len(values)):
        before, upto = upto, upto + counts[k]
        if abs(before - target) < abs(upto - target):
            out.append((values[k - 1] + values[k]) / 2)
            target += n / bins
    return out


def test_cuts_follow_the_plain_rule():
    rng = np.random.default_rng(3)
    for size, most in ((1, 5), (20, 3), (32, 1), (33, 1), (33, 9), (60, 400), (500, 2), (5000, 30)):
        values, counts = np.sort(rng.normal(size=size)), rng.integers(1, most + 1, size)
        counts[size // 2] += most * size // 3
        assert BO.cuts_between(values, counts).tolist() == plain_cuts(values.tolist(), counts.tolist())
