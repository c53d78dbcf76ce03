"""Model queries as registered, against separate fits on the rows they learn from."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom import plans
from barloom.operators import panel as P
from barloom.plans import models as M
from barloom.plans.panel import parts
from tests.test_expanding import separate_fit

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def check_blocks(got, pdf, features, category, key, min_train, every, wanted=(0, 7, -2)):
    """Some blocks, and the newest day, of ``got`` (date, role, key -> prob) against a fit of their own."""
    labelled = pdf[pdf.label.notna()]
    days = sorted(labelled.date.unique())
    starts = days[min_train::every]
    assert {d for d, role, *_ in got if role == "eval"} == set(days[min_train:])
    newest = pdf.date.max()
    assert {d for d, role, *_ in got if role == "current"} == {newest}
    blocks = [(starts[k], days[days.index(starts[k]) :][:every], "eval", labelled) for k in wanted] + [(newest, [newest], "current", pdf)]
    for start, own, role, source in blocks:
        train, test = labelled[labelled.date < start], source[source.date.isin(own)]
        cats = lambda x: list(x[category]) if category else [None] * len(x)
        p = separate_fit(train[features].to_numpy(float), cats(train), train.label.to_numpy(float), test[features].to_numpy(float), cats(test))
        for (_, row), value in zip(test.iterrows(), p):
            assert abs(got[row.date, role, row[key]] - value) < 1.1e-4


def test_pooled_outperform_equals_separate_fits(spark):
    pdf = M.outperform_rows(spark, SF).toPandas()
    got = {(r.date, r.role, r.ticker): r.prob for r in plans.QUERIES["pooled_outperform"](spark, SF).collect()}
    check_blocks(got, pdf, M.POOLED, "sector", "ticker", 80, 5)


def test_market_direction_equals_separate_fits(spark):
    rows = P.market_panel(*parts(spark, SF))
    out = plans.QUERIES["market_direction"](spark, SF).collect()
    assert all(r.call == ("UP" if r.prob >= 0.55 else "DOWN" if r.prob <= 0.45 else "NEUTRAL") or min(abs(r.prob - 0.55), abs(r.prob - 0.45)) < 1e-4 for r in out)
    for h in (5, 10):
        ahead = F.col(f"i_fwd{h}")
        pdf = rows.withColumn("label", F.when(ahead.isNotNull(), (ahead > 0).cast("double"))).select("date", "label", *M.MARKET).toPandas()
        pdf["one"] = 1
        got = {(r.date, r.role, 1): r.prob for r in out if r.horizon == h}
        check_blocks(got, pdf, M.MARKET, None, "one", 80, 5)


def test_scores_separate_better_than_chance_on_their_own_rows():
    """The separate fit used here is a fit: it orders a separable sample."""
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 2))
    y = (x[:, 0] > 0).astype(float)
    p = separate_fit(x[:300], [None] * 300, y[:300], x[300:], [None] * 100)
    assert ((p > 0.5) == (y[300:] == 1)).mean() > 0.95
