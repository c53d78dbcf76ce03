"""Expanding-window fits of all blocks at once against a separate fit for each."""

import datetime as dt

import numpy as np
import pytest

from barloom.operators import expanding as E

DAY = dt.date(2024, 1, 1)


def separate_fit(x, cats, y, z, z_cats):
    """Probabilities for ``z`` of a balanced ridge logistic fit on ``x``, by Newton steps on its own rows alone."""
    with np.errstate(all="ignore"):
        middle = np.array([np.nanmedian(c) if (~np.isnan(c)).any() else 0.0 for c in x.T])
    x, z = (np.where(np.isnan(a), middle, a) for a in (x, z))
    mean, std = x.mean(axis=0), x.std(axis=0)
    std[std < 1e-12] = 1.0
    names = sorted({c for c in cats if c is not None})
    full = lambda a, c: np.c_[np.ones(len(a)), (a - mean) / std, np.array([[v == n for n in names] for v in c]).reshape(len(a), -1)].astype(float)
    x, z = full(x, cats), full(z, z_cats)
    worth = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    keep = np.eye(x.shape[1])
    keep[0, 0] = 0
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (worth * p * (1 - p))[:, None]).T @ x + keep + 1e-10 * np.eye(len(w)), x.T @ (worth * (y - p)) - keep @ w)
    return 1 / (1 + np.exp(-z @ w))


def sample(draw, days, names, gaps=True):
    rows = []
    for d in range(days):
        for k, name in enumerate(names):
            a, b = draw.normal(100, 3), draw.normal()
            y = float(a - 100 + 2 * b + draw.normal(0, 4) > 0)
            rows.append([name, "xyz"[k % 3] if d > 5 or k % 3 < 2 else None, DAY + dt.timedelta(days=d), a, b, 7.0, y if d < days - 3 else None])
            if gaps and draw.random() < 0.2:
                rows[-1][3 + int(draw.integers(2))] = None
    return rows


@pytest.mark.parametrize("gaps", [True, False])
def test_scores_equal_separate_fits(spark, gaps):
    rows = sample(np.random.default_rng(1), 40, "abcdefg", gaps)
    df = spark.createDataFrame(rows, "ticker string, sector string, date date, a double, b double, c double, label double").repartition(5)
    got = {(r.ticker, r.date, r.role): r.prob for r in E.expanding_logistic(df, ["a", "b", "c"], ["sector"], "label", 10, 4).collect()}
    labelled = [r for r in rows if r[6] is not None]
    days = sorted({r[2] for r in labelled})
    want = {}
    num = lambda part: np.array([[np.nan if v is None else v for v in r[3:6]] for r in part], float)
    blocks = [(days[k], days[k : k + 4], "eval", labelled) for k in range(10, len(days), 4)]
    blocks.append((rows[-1][2], [rows[-1][2]], "current", rows))
    for start, own, role, source in blocks:
        train, test = [r for r in labelled if r[2] < start], [r for r in source if r[2] in own]
        p = separate_fit(num(train), [r[1] for r in train], np.array([r[6] for r in train]), num(test), [r[1] for r in test])
        want.update({(r[0], r[2], role): v for r, v in zip(test, p)})
    assert got.keys() == want.keys() and len(want) == 7 * (27 + 1)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-7


def test_separable_classes_and_one_class_only(spark):
    schema = "ticker string, date date, a double, label double"
    rows = [("a", DAY + dt.timedelta(days=k), float(k % 2), float(k % 2)) for k in range(30)]
    got = E.expanding_logistic(spark.createDataFrame(rows, schema), ["a"], [], "label", 5, 5).collect()
    assert len(got) == 26 and all((r.prob > 0.5) == (r.label == 1) for r in got)
    ones = spark.createDataFrame([(t, d, a, 1.0) for t, d, a, _ in rows], schema)
    assert E.expanding_logistic(ones, ["a"], [], "label", 5, 5).collect() == []
    assert E.expanding_logistic(spark.createDataFrame([], schema), ["a"], [], "label", 5, 5).collect() == []


def test_expanding_medians_equal_numpy(spark):
    draw = np.random.default_rng(2)
    rows = [(int(q), None if draw.random() < 0.1 else float(v), float(round(v))) for q, v in zip(draw.integers(0, 9, 500), draw.normal(0, 100, 500))]
    df = spark.createDataFrame(rows, "q int, a double, b double").repartition(4)
    got = {(r.feature, r.block): r.median for r in E.expanding_medians(df, ["a", "b"], "q", 7).collect()}
    want = {(f, b): float(np.median([r[k] for r in rows if r[0] <= b and r[k] is not None])) for k, f in ((1, "a"), (2, "b")) for b in range(7)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
