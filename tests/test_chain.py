"""Decisions over fitted forecasts: the steps after the scores against SQL over the stored scores; the choice of candidates."""

import os

import numpy as np
import pandas as pd
import pytest

from barloom.operators import candidates as CA
from barloom.operators import models as MO
from barloom.plans import chain as C
from barloom.plans import decisions as DP
from barloom.plans import inputs as I
from barloom.plans import market as PM
from barloom.plans import registry as RG
from barloom.plans.snapshot import rounded
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_chain_equals_sql_over_stored_scores(spark, tmp_path):
    bars = I.bars_table(spark, SF)
    replaced = {}
    for name, rows in zip(("v_fc0", "v_tf"), C.scores(spark, SF, bars)):
        rows.write.parquet(str(tmp_path / name))
        replaced[name] = f"select * from read_parquet('{tmp_path / name}/*.parquet')"
    ohlc, timing = (spark.read.parquet(str(tmp_path / n)) for n in replaced)
    models = {r.model for r in ohlc.select("model").distinct().collect()}
    assert models == {"ridge_full", "ridge_recent", "forest_full", "forest_recent", "trailing_mean", "last_known"}
    replaced["v_blend"] = RG.view_text("v_blend").replace("'trailing_mean'", "'ridge_full'").replace("'last_known'", "'ridge_recent'")
    people = PM.members(spark, SF, bars)
    parts = C.ladder(spark, SF, bars, people, C.priced(ohlc), timing)
    con = duck(SF)
    for name, made in (
        ("entry_ladder", rounded(parts[1], "limit_price")),
        ("verdicts", DP.verdicts_of(spark, SF, bars, people, *parts)),
        ("candidate_watchlist", DP.watchlist(spark, SF, bars, people, *parts)),
    ):
        columns, n, same, *_, note = compare(spark, con, name, lambda s, d, made=made: made, RG.with_views(RG.STATEMENTS[name], replaced), SF)
        assert same and n, (name, note)


def race_rows(draw, days=80):
    rows = []
    for t in "ab":
        for h in (1, 2):
            for k in range(days):
                x, z = draw.normal(), draw.normal()
                step = float(z > 0) * 4 - 2
                y = (3 * x if t == "a" else step) + 0.1 * draw.normal()
                rows.append((t, h, pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=k), x, z, None if k >= days - h else y, 7))
    return rows


def test_race_chooses_by_held_out_error(spark):
    """A line suits ridge, a step suits trees; the chosen row has the least error of all candidates."""
    schema = "ticker string, horizon int, date date, x double, z double, y double, tag int"
    df = spark.createDataFrame(race_rows(np.random.default_rng(1)), schema)
    got = CA.race(df, ["ticker", "horizon"], ["x", "z"], ["y"], {"full": None, "last": 25}, 10, 20, ["tag"], trees=20, depth=5).toPandas()
    assert set(got.groupby(["ticker", "horizon", "model", "variant", "role"]).size().index) == {
        (t, h, m, v, r) for t in "ab" for h in (1, 2) for m in ("ridge", "forest") for v in ("full", "last") for r in ("eval", "current")
    }
    assert (got[got.role == "eval"].groupby(["ticker", "horizon", "model", "variant"]).size() == 10).all()
    assert (got[got.role == "current"].y.isna()).all() and (got.tag == 7).all()
    errors = CA.held_out_errors(spark.createDataFrame(got), ["ticker", "horizon", "model", "variant"], ["y"])
    best = {(r.ticker, r.horizon): r for r in CA.choose(errors, ["ticker", "horizon"], ["model", "variant"]).collect()}
    own = got[got.role == "eval"].assign(e=lambda x: (x.y - x.pred_y).abs()).groupby(["ticker", "horizon", "model", "variant"]).e.mean()
    for key, r in best.items():
        assert abs(r.error - own[key].min()) < 1e-9 and abs(own[(*key, r.model, r.variant)] - own[key].min()) < 1e-9
    assert best["a", 1].model == "ridge" and best["b", 1].model == "forest"


def test_variants_in_one_pass_equal_their_own_runs(spark):
    schema = "ticker string, horizon int, date date, x double, z double, y double, tag int"
    df = spark.createDataFrame(race_rows(np.random.default_rng(2)), schema)
    both = MO.grouped_forecast(df, ["ticker", "horizon"], ["x", "z"], ["y"], 20, holdout=10, train_last={"full": None, "last": 25}).toPandas()
    for name, last in (("full", None), ("last", 25)):
        one = MO.grouped_forecast(df, ["ticker", "horizon"], ["x", "z"], ["y"], 20, holdout=10, train_last=last).toPandas()
        mine = both[both.variant == name].drop(columns="variant")
        order = ["ticker", "horizon", "date", "role"]
        pd.testing.assert_frame_equal(mine.sort_values(order).reset_index(drop=True), one.sort_values(order).reset_index(drop=True))


def test_short_history_gives_no_forest(spark):
    schema = "ticker string, horizon int, date date, x double, z double, y double, tag int"
    df = spark.createDataFrame(race_rows(np.random.default_rng(3), 8), schema)
    assert CA.pooled_forest(df, ["ticker", "horizon"], ["x", "z"], ["y"], {"full": None}, 10).count() == 0
    assert CA.pooled_forest(df.limit(0), ["ticker", "horizon"], ["x", "z"], ["y"], {"full": None}, 10).count() == 0


def test_fill_choice_equals_sql_over_stored_scores(spark, tmp_path):
    import duckdb

    draw = np.random.default_rng(9)
    rows = [
        (f"t{k % 7}", int(h), str(m), float(y if k % 7 else 1), None if draw.random() < 0.05 else float(np.clip(0.6 * y + draw.normal(0.2, 0.3), -0.1, 1.1)))
        for k in range(900) for h, m, y in [(draw.integers(1, 3), draw.choice(["logistic", "forest"]), draw.integers(2))]
    ]
    df = spark.createDataFrame(rows, "ticker string, horizon int, model string, touched double, pred_touched double")
    df.write.parquet(str(tmp_path / "scores"))
    scores = CA.fill_scores(df, ["ticker", "horizon"], "touched", "pred_touched")
    wanted = spark.createDataFrame([(f"t{k}", h, 0.5) for k in range(8) for h in (1, 2)], "ticker string, horizon int, positive_rate double")
    got = sorted(tuple(r) for r in CA.choose_fill(wanted, scores, ["ticker", "horizon"]).collect())
    want = duckdb.sql(
        f"""
        with p as (select *, least(greatest(pred_touched, 1e-6), 1 - 1e-6) p from '{tmp_path}/scores/*.parquet' where touched is not null and pred_touched is not null),
        s as (select ticker, horizon, model, count(*) n, avg(touched) r, avg((p - touched) ** 2) b, avg(case when (p >= 0.5) = (touched = 1) then 1.0 else 0 end) a from p group by all having min(touched) < max(touched)),
        c as (select * from s qualify row_number() over (partition by ticker, horizon order by b + 1 - a, model) = 1),
        w as (select 't' || k ticker, h horizon from range(8) t(k), (values (1), (2)) v(h))
        select w.ticker, w.horizon, coalesce(model, 'heuristic_fallback'), coalesce(n, 0), coalesce(r, 0.5), b, a, b + 1 - a from w left join c using (ticker, horizon) order by 1, 2
        """
    ).fetchall()
    assert len(got) == len(want) == 16 and sum(r[2] == "heuristic_fallback" for r in got) == 4
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and all(x is y is None or abs(x - y) < 1e-9 for x, y in zip(g[4:], w[4:]))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_lift_equals_sql_over_stored_scores(spark, tmp_path):
    scores = C.lift_scores(spark, SF, horizons=(5,))
    scores.write.parquet(str(tmp_path / "scores"))
    assert {r.model for r in scores.select("model").distinct().collect()} == {f"{n}::logistic" for n in C.FEATURE_SETS}
    rows = scores.groupBy("model").count().collect()
    assert len({r["count"] for r in rows}) == 1  # the same rows for every set
    replaced = {"v_prob0": f"select * from read_parquet('{tmp_path}/scores/*.parquet')"}
    got = rounded(C.lift_of(scores).filter("horizon = 5").drop("horizon"))
    _, n, same, *_, note = compare(spark, duck(SF), "lift", lambda s, d: got, RG.with_views(RG.STATEMENTS["feature_set_lift"], replaced), SF)
    assert same and n == 3, note


def test_feature_sets_are_nested():
    sets = list(C.FEATURE_SETS.values())
    assert all(set(a) < set(b) for a, b in zip(sets, sets[1:]))
