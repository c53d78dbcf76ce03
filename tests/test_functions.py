"""Helpers against plain pandas and numpy on small inputs."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import grid as G
from barloom.functions import ranks as RK
from barloom.functions import smoothing as SM
from barloom.functions import text as X


def history(n=3000, seed=1, tickers=("A", "B")):
    rng = np.random.default_rng(seed)
    rows = []
    for t in tickers:
        close = 50 + np.cumsum(rng.normal(0, 0.5, n))
        for i in range(n):
            rows.append((t, dt.date(2010, 1, 1) + dt.timedelta(i), float(close[i] + 1), float(close[i] - 1), float(close[i])))
    return pd.DataFrame(rows, columns=["ticker", "date", "high", "low", "close"])


def test_smoothing_matches_recursion_over_many_blocks(spark):
    pdf = history()
    df = SM.with_macd(SM.with_rsi(SM.with_ema(spark.createDataFrame(pdf), {"ema5": 5, "ema20": 20}), 14, "rsi"))
    got = df.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    for _, g in got.groupby("ticker"):
        c = g.close
        assert np.allclose(g.ema20, c.ewm(span=20, adjust=False).mean(), rtol=1e-12)
        assert np.allclose(g.ema5, c.ewm(span=5, adjust=False).mean(), rtol=1e-12)
        step = c.diff()
        up = step.clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean()
        down = (-step).clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean()
        want = 100 - 100 / (1 + up / down.replace(0.0, np.nan))
        assert np.allclose(g.rsi, want, equal_nan=True)
        line = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
        assert g.macd.isna().sum() == 25
        assert np.allclose(g.macd[25:], line[25:], atol=1e-9)
        assert np.allclose(g.macd_signal[25:], line.ewm(span=9, adjust=False).mean()[25:], atol=1e-9)


def test_smoothing_keeps_ratios_over_long_flat_stretches(spark):
    moving = 50 + np.cumsum(np.random.default_rng(4).normal(0, 0.5, 40))
    close = np.concatenate([moving, np.full(3000, moving[-1])])
    rows = [("t", dt.date(2000, 1, 1) + dt.timedelta(i), float(c)) for i, c in enumerate(close)]
    got = SM.with_rsi(spark.createDataFrame(rows, "ticker string, date date, close double"), 14, "rsi").orderBy("date").toPandas().rsi
    up = down = None
    want = [None]
    for step in np.diff(close):
        gain, loss = max(step, 0.0), max(-step, 0.0)
        up = gain if up is None else up * 13 / 14 + gain / 14
        down = loss if down is None else down * 13 / 14 + loss / 14
        want.append(100 - 100 / (1 + up / down) if down else None)
    assert np.allclose(got.astype(float), np.array(want, float), equal_nan=True, rtol=1e-6)
    assert not np.isnan(got.iloc[-1])


def test_embedded_list_with_nested_brackets(spark):
    page = '<script id="__NEXT_DATA__">{"a":{"_collection":[{"symbol":"aa]","tags":["x",["y"]]},{"ticker":" bb ","n":[1,2]}],"rest":[{"symbol":"no"}]}}</script>'
    df = spark.createDataFrame([(page,), ("none",), (None,), ('<script id="__NEXT_DATA__">{"_collection":[{"symbol":"open"}</script>',)], "h string")
    assert [r[0] for r in df.select(X.embedded_members(F.col("h"))).collect()] == [["AA]", "BB"], None, None, None]


def test_rank_matches_pandas_with_ties_and_nulls(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 400), "v": np.round(rng.normal(0, 3, 400), 1), "i": range(400)})
    pdf.loc[::17, "v"] = np.nan
    pdf.loc[:130, "v"] = 0.5  # a third of all rows share one value
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    out = RK.add_rank(df, "v", {"average_pct": "a", "min": "m"}, by=["g"]).toPandas().sort_values("i").reset_index(drop=True)
    by = pdf.groupby("g").v
    assert np.allclose(out.a, by.rank(method="average", pct=True) * 100, equal_nan=True)
    assert np.allclose(out.m, by.rank(method="min"), equal_nan=True)
    down = RK.add_rank(df, "v", {"min_pct": "p"}, descending=True).toPandas().sort_values("i").reset_index(drop=True)
    assert np.allclose(down.p, pdf.v.rank(method="min", ascending=False, pct=True) * 100, equal_nan=True)


def test_auc_counts_pairs(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"m": rng.choice(["a", "b"], 300), "p": np.round(rng.random(300), 2), "y": rng.integers(0, 2, 300)})
    pdf = pd.concat([pdf, pd.DataFrame({"m": ["c"] * 3, "p": [0.1, 0.2, 0.3], "y": [1, 1, 1]})])
    got = {r.m: r.auc for r in RK.auc_by(spark.createDataFrame(pdf), ["m"], "p", "y").collect()}
    for m in "ab":
        g = pdf[pdf.m == m]
        pos, neg = g[g.y == 1].p.to_numpy(), g[g.y == 0].p.to_numpy()
        wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
        assert got[m] == pytest.approx(wins)
    assert got["c"] is None


def test_price_grid(spark):
    df = spark.createDataFrame([(12.0,), (9.995,), (49.98,), (50.04,), (None,)], "x double")
    low, high = G.price_band(F.col("x"))
    rows = df.select("x", G.tick_size(F.col("x")), G.round_to_tick(F.col("x")), low, high).collect()
    assert rows[0][1:] == (0.05, 12.0, 11.2, 12.8)
    assert rows[1][1:3] == (0.01, 10.0)
    assert rows[2][1:3] == (0.05, 50.0)
    assert rows[3][1:3] == (0.1, 50.0)
    assert rows[4][1:] == (None, None, None, None)


def test_number_and_period_parsing(spark):
    df = spark.createDataFrame(
        [("(1,234.5)",), ("12,5 %",), ("-",), ("",), ("1,234,567",), ("−3",), ("abc",), (None,)], "t string"
    )
    assert [r[0] for r in df.select(X.parse_number(F.col("t"))).collect()] == [-1234.5, 12.5, None, None, 1234567.0, -3.0, None, None]
    p = spark.createDataFrame([("Q4/2025", None), ("Q1/2025", "01/01/2025 - 31/03/2025"), ("x", "x")], "l string, s string")
    assert [r[0] for r in p.select(X.parse_period_end(F.col("l"), F.col("s"))).collect()] == [
        dt.date(2025, 12, 31), dt.date(2025, 3, 31), None,
    ]
    label = spark.createDataFrame([("  Lợi nhuận sau Thuế (Đồng) ",)], "t string").select(X.plain_label(F.col("t"))).first()[0]
    assert label == "loi nhuan sau thue dong"


def test_page_extraction(spark):
    page = (
        '<script id="__NEXT_DATA__" type="application/json">{"a":{"_collection":[{"symbol":"aaa","x":1},{"ticker":"bbb"}]}}</script>'
        '<p class="p8">P/E <b>12,5</b></p><p class="p8">P/B <b>1.1</b></p><p class="p8">P/E <b>13</b></p>'
    )
    df = spark.createDataFrame([(page,)], "h string")
    row = df.select(
        X.embedded_members(F.col("h")).alias("m"), X.label_value_map(F.col("h"), r'<p class="p8">([^<]*)<b>([^<]*)</b>').alias("v")
    ).first()
    assert row.m == ["AAA", "BBB"]
    assert row.v == {"P/E": "13", "P/B": "1.1"}


def test_safe_values(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("",), ("inf",), ("x",), ("2.5",)], "t string")
    assert [r[0] for r in df.select(X.safe_double(F.col("t"))).collect()] == [1.5, None, None, None, None, 2.5]
    assert [r[0] for r in df.select(X.round_or_null(F.col("t"), 0)).collect()] == [2.0, None, None, None, None, 2.0]


def test_value_buckets_never_fall(spark):
    draw = np.random.default_rng(3)
    x = np.sort(np.concatenate([draw.normal(0, 10.0**k, 300) for k in range(-8, 12)]))
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", RK.value_bucket(F.col("x")).alias("b")).orderBy("x").collect()
    assert (np.diff([r.b for r in rows]) >= 0).all() and len({r.b for r in rows}) > 1000
