"""Metrics and model choice over stored forecasts.

The forecasts are two plain ones computed from the bars themselves: the mean of the last
twenty known outcomes and the last known outcome. They let every metric be checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import frames as R
from barloom.operators import metrics as ME
from barloom.operators import targets as T
from barloom.plans import inputs as I
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage

HORIZONS = (1, 5, 10)
OHLC = ("open", "close", "upper", "lower")
EXC = ("peak", "peak_day", "drawdown", "close_ret")


def forecasts(rows, fields, prefix, horizons=HORIZONS):
    """Both forecasts of every field per horizon, from outcomes known at the row's date."""
    out = None
    for h in horizons:
        w = R.ordered("ticker")
        known = w.rowsBetween(-19 - h, -h)
        values = [F.col(f"{prefix}{f}") for f in fields]
        mean = [F.when(F.count(c).over(known) == 20, F.avg(c).over(known)).alias(f"pred_{f}") for f, c in zip(fields, values)]
        last = [F.lag(c, h).over(w).alias(f"pred_{f}") for f, c in zip(fields, values)]
        both = F.array(
            F.struct(F.lit("trailing_mean").alias("model"), *mean), F.struct(F.lit("last_known").alias("model"), *last)
        )
        one = rows.filter(F.col("horizon") == h).withColumn("_p", both).withColumn("_p", F.explode("_p"))
        one = one.select(*rows.columns, "_p.*")
        out = one if out is None else out.unionByName(one)
    return out


def _forecast_sql(src: str, fields, prefix: str, horizons=HORIZONS) -> str:
    parts = []
    for h in horizons:
        mean = ", ".join(
            f"case when count({prefix}{f}) over k = 20 then avg({prefix}{f}) over k end pred_{f}" for f in fields
        )
        last = ", ".join(f"lag({prefix}{f}, {h}) over w pred_{f}" for f in fields)
        win = f"window w as (partition by ticker order by date), k as (partition by ticker order by date rows between {19 + h} preceding and {h} preceding)"
        parts += [
            f"select *, {mean}, 'trailing_mean' model from {src} where horizon = {h} {win}",
            f"select *, {last}, 'last_known' model from {src} where horizon = {h} {win}",
        ]
    return " union all ".join(parts)


view("v_fc0", _forecast_sql("v_labels", OHLC, "target_"))
view(
    "v_fc1",
    """
    select *, base_close * (1 + pred_open / 100.0) pred_open_price, base_close * (1 + pred_close / 100.0) pred_close_price from v_fc0
    """,
)
view(
    "v_fc2",
    """
    select *, greatest(pred_open_price, pred_close_price) + base_close * greatest(pred_upper, 0) / 100.0 pred_high_price,
      least(pred_open_price, pred_close_price) - base_close * greatest(pred_lower, 0) / 100.0 pred_low_price from v_fc1
    """,
)
view(
    "v_fc",
    "select *, "
    + ", ".join(f"(pred_{f}_price / base_close - 1) * 100 pred_{f}_ret, (actual_{f} / base_close - 1) * 100 actual_{f}_ret" for f in ("open", "high", "low", "close"))
    + """, (pred_high_price - pred_low_price) / base_close * 100 pred_range, (actual_high - actual_low) / base_close * 100 actual_range,
      case when pred_close_price > pred_open_price then 'BULLISH' when pred_close_price < pred_open_price then 'BEARISH' when pred_close_price is not null then 'DOJI' end bias
    from v_fc2""",
)


def _metrics_sql(by: str) -> str:
    return f"""
    select *, (open_mae + high_mae + low_mae + close_mae) / 4 mean_mae,
      close_mae + 0.35 * range_mae + 0.9 * upside_miss + 0.6 * downside_miss - 0.01 * hit_pct next_session_score, close_mae + 0.5 * range_mae - 0.01 * hit_pct range_score
    from (select {by}, count(*) eval_rows, {', '.join(f'avg(abs(actual_{f}_ret - pred_{f}_ret)) {f}_mae' for f in ('open', 'high', 'low', 'close'))},
      avg(abs(actual_range - pred_range)) range_mae, avg(greatest(actual_high_ret - pred_high_ret, 0)) upside_miss, avg(greatest(pred_low_ret - actual_low_ret, 0)) downside_miss,
      avg(cast(sign(actual_close_ret) = sign(pred_close_ret) as int)) * 100 hit_pct
      from v_fc where actual_close is not null and pred_close is not null group by {by})"""


view("v_om", _metrics_sql("ticker, model, horizon"))
MET = "open_mae high_mae low_mae close_mae range_mae upside_miss downside_miss hit_pct mean_mae next_session_score range_score".split()


def ohlc_forecasts(spark, d, bars=None):
    bars = bars if bars is not None else I.bars_table(spark, d)
    rows = T.horizon_targets(bars).filter(F.col("horizon").isin(*HORIZONS))
    return ME.attach_actuals(ME.reconstruct(forecasts(rows, OHLC, "target_")))


def evaluated(spark, d):
    rows = cut_lineage(ohlc_forecasts(spark, d))
    return rows.filter("actual_close is not null and pred_close is not null")


@query(
    "forecast_reconstruction",
    f"""select ticker, date, horizon, model, bias, {rd([f'pred_{f}_ret' for f in ('open', 'high', 'low', 'close')] + ['pred_range'])} from v_fc where horizon = 1""",
)
def forecast_reconstruction(spark, d):
    rows = ohlc_forecasts(spark, d).filter("horizon = 1")
    return rounded(rows.select("ticker", "date", "horizon", "model", "bias", *[f"pred_{f}_ret" for f in ("open", "high", "low", "close")], "pred_range"))


@query("ohlc_metrics_by_ticker", f"select ticker, model, horizon, eval_rows, {rd(MET)} from v_om")
def ohlc_metrics_by_ticker(spark, d):
    return rounded(ME.ohlc_metrics(evaluated(spark, d), ["ticker", "model", "horizon"]))


@query(
    "ohlc_metrics_by_model",
    f"select model, horizon, eval_rows, {rd(MET)} from ({_metrics_sql('model, horizon')})",
)
def ohlc_metrics_by_model(spark, d):
    return rounded(ME.ohlc_metrics(evaluated(spark, d), ["model", "horizon"]))


def best_order(score):
    return [F.asc(score), F.asc("close_mae"), F.asc("range_mae"), F.desc("hit_pct"), F.asc("model")]


@query(
    "best_forecast_model",
    """select ticker, horizon, model, round(next_session_score, 6) next_session_score from v_om
    qualify row_number() over (partition by ticker, horizon order by next_session_score, close_mae, range_mae, hit_pct desc, model) = 1""",
)
def best_forecast_model(spark, d):
    m = ME.ohlc_metrics(evaluated(spark, d), ["ticker", "model", "horizon"])
    best = ME.first_per_key(m, ["ticker", "horizon"], best_order("next_session_score"))
    return rounded(best.select("ticker", "horizon", "model", "next_session_score"))


view(
    "v_current",
    """
    select b.ticker, b.horizon, b.model, f.date, f.base_close, f.bias, f.pred_open_price, f.pred_high_price, f.pred_low_price, f.pred_close_price, f.pred_close_ret, f.pred_range, b.range_score
    from (select * from v_om qualify row_number() over (partition by ticker, horizon order by range_score, close_mae, range_mae, hit_pct desc, model) = 1) b
      join (select * from v_fc qualify row_number() over (partition by ticker, horizon, model order by date desc) = 1) f using (ticker, horizon, model)
    """,
)


def current_forecasts(spark, d, rows=None):
    """Forecast of the best model per (instrument, horizon) at the last date."""
    rows = rows if rows is not None else cut_lineage(ohlc_forecasts(spark, d))
    m = ME.ohlc_metrics(rows.filter("actual_close is not null and pred_close is not null"), ["ticker", "model", "horizon"])
    best = ME.first_per_key(m, ["ticker", "horizon"], best_order("range_score")).select("ticker", "horizon", "model", "range_score")
    latest = ME.first_per_key(rows, ["ticker", "horizon", "model"], [F.desc("date")])
    return best.join(latest, ["ticker", "horizon", "model"])


@query(
    "current_best_forecast",
    f"""select ticker, horizon, model, date, base_close, bias, {rd('pred_close_ret pred_range range_score'.split())}, {rd(['pred_low_price', 'pred_high_price'], 1)} from v_current""",
)
def current_best_forecast(spark, d):
    out = current_forecasts(spark, d)
    out = out.withColumns({c: F.round(c, 1) for c in ("pred_low_price", "pred_high_price")})
    return rounded(
        out.select("ticker", "horizon", "model", "date", "base_close", "bias", "pred_close_ret", "pred_range", "range_score", "pred_low_price", "pred_high_price")
    )


@query(
    "forecast_top_bottom",
    """
    with c as (select ticker, horizon, pred_close_ret from v_current where pred_close_ret is not null)
    select ticker, horizon, round(pred_close_ret, 6) pred_close_ret, position, bucket from (
      select *, row_number() over (partition by horizon order by pred_close_ret desc, ticker) position, 'TOP' bucket from c
      union all select *, row_number() over (partition by horizon order by pred_close_ret, ticker), 'BOTTOM' from c) where position <= 10
    """,
)
def forecast_top_bottom(spark, d):
    rows = current_forecasts(spark, d).select("ticker", "horizon", "pred_close_ret").filter("pred_close_ret is not null")
    return rounded(ME.top_and_bottom(rows, ["horizon"], "pred_close_ret", 10))


@query(
    "horizon_metric_rollup",
    f"select model, horizon, count(*) groups, {', '.join(f'round(avg({c}), 6) {c}' for c in ('close_mae', 'range_mae', 'hit_pct'))} from v_om group by 1, 2",
)
def horizon_metric_rollup(spark, d):
    m = ME.ohlc_metrics(evaluated(spark, d), ["ticker", "model", "horizon"])
    return rounded(ME.horizon_rollup(m, ["model", "horizon"], ["close_mae", "range_mae", "hit_pct"]))


# Timing and cycle forecasts ------------------------------------------------------------
TIMING_H = (3, 5, 10)
view("v_exc", " union all ".join(
    f"select * from (select ticker, date, {h} horizon, (max(high) over s / close - 1) * 100 peak, cast(arg_max(i, (high, -i)) over s - i as double) peak_day, "
    f"(min(low) over s / close - 1) * 100 drawdown, (lead(close, {h}) over w / close - 1) * 100 close_ret, close from (select *, row_number() over (partition by ticker order by date) i from v_bars) "
    f"window w as (partition by ticker order by date), s as (partition by ticker order by date rows between 1 following and {h} following))"
    for h in TIMING_H
))
view("v_tf", _forecast_sql("v_exc", EXC, "", TIMING_H))
view(
    "v_tm0",
    """
    select ticker, model, horizon, count(*) eval_rows, avg(abs(peak - pred_peak)) peak_mae, avg(abs(peak_day - pred_peak_day)) peak_day_mae,
      avg(abs(drawdown - pred_drawdown)) drawdown_mae, avg(abs(close_ret - pred_close_ret)) close_ret_mae,
      avg(abs((peak - abs(drawdown)) - (pred_peak - abs(pred_drawdown)))) trade_mae,
      avg(cast(sign(peak - abs(drawdown) - 0.06) = sign(pred_peak - abs(pred_drawdown) - 0.06) as int)) * 100 trade_hit_pct
    from v_tf where close_ret is not null and pred_close_ret is not null group by 1, 2, 3
    """,
)
view(
    "v_tm",
    """
    select *, peak_mae + 0.15 * peak_day_mae + 0.5 * drawdown_mae + 0.5 * close_ret_mae + 0.75 * trade_mae - 0.01 * trade_hit_pct timing_score,
      peak_mae + 0.15 * peak_day_mae + 0.5 * drawdown_mae cycle_score from v_tm0
    """,
)
view(
    "v_tnow",
    """
    select f.ticker, f.horizon, f.model, f.date, f.close, pred_peak, least(greatest(pred_peak_day, 1.0), cast(f.horizon as double)) pred_peak_day, pred_drawdown, pred_close_ret,
      pred_peak - abs(pred_drawdown) - 0.06 net_edge, case when abs(pred_drawdown) > 1e-9 then pred_peak / abs(pred_drawdown) end reward_risk, timing_score, cycle_score, peak_mae, drawdown_mae, close_ret_mae, trade_hit_pct, eval_rows
    from (select * from v_tm qualify row_number() over (partition by ticker, horizon order by timing_score, trade_mae, peak_mae, drawdown_mae, close_ret_mae, trade_hit_pct desc, model) = 1) b
      join (select * from v_tf qualify row_number() over (partition by ticker, horizon, model order by date desc) = 1) f using (ticker, horizon, model)
    """,
)
TM = "peak_mae peak_day_mae drawdown_mae close_ret_mae trade_mae trade_hit_pct timing_score cycle_score".split()


def timing_forecasts(spark, d, bars=None):
    bars = bars if bars is not None else I.bars_table(spark, d)
    rows = T.excursion_samples(bars, TIMING_H)
    return forecasts(rows, EXC, "", TIMING_H)


@query("timing_metrics", f"select ticker, model, horizon, eval_rows, {rd(TM)} from v_tm")
def timing_metrics(spark, d):
    rows = cut_lineage(timing_forecasts(spark, d)).filter("close_ret is not null and pred_close_ret is not null")
    return rounded(ME.timing_metrics(rows, ["ticker", "model", "horizon"]))


def current_timing(spark, d, rows=None):
    rows = rows if rows is not None else cut_lineage(timing_forecasts(spark, d))
    m = ME.timing_metrics(rows.filter("close_ret is not null and pred_close_ret is not null"), ["ticker", "model", "horizon"])
    order = [F.asc(c) for c in ("timing_score", "trade_mae", "peak_mae", "drawdown_mae", "close_ret_mae")] + [F.desc("trade_hit_pct"), F.asc("model")]
    best = ME.first_per_key(m, ["ticker", "horizon"], order)
    latest = ME.first_per_key(rows, ["ticker", "horizon", "model"], [F.desc("date")]).select(
        "ticker", "horizon", "model", "date", "pred_peak", "pred_peak_day", "pred_drawdown", "pred_close_ret"
    )
    _, net, reward = ME.trade_columns(F.col("pred_peak"), F.col("pred_drawdown"))
    return best.join(latest, ["ticker", "horizon", "model"]).withColumns(
        {"net_edge": net, "reward_risk": reward, "pred_peak_day": ME.clip_peak_day(F.col("pred_peak_day"), F.col("horizon"))}
    )


NOW = "pred_peak pred_peak_day pred_drawdown pred_close_ret net_edge reward_risk timing_score".split()


@query("current_timing", f"select ticker, horizon, model, date, {rd(NOW)} from v_tnow")
def current_timing_query(spark, d):
    return rounded(current_timing(spark, d).select("ticker", "horizon", "model", "date", *NOW))


@query(
    "timing_matrix",
    "select ticker, "
    + ", ".join(f"max(case when horizon = {h} then {c} end) {c}_{h}d" for h in TIMING_H for c in ("model",))
    + ", "
    + ", ".join(f"round(max(case when horizon = {h} then {c} end), 6) {c}_{h}d" for h in TIMING_H for c in ("pred_peak", "pred_drawdown", "net_edge"))
    + " from v_tnow group by ticker",
)
def timing_matrix(spark, d):
    """Chosen forecasts wide by horizon."""
    fields = ("model", "pred_peak", "pred_drawdown", "net_edge")
    wide = current_timing(spark, d).groupBy("ticker").pivot("horizon", list(TIMING_H)).agg(*[F.first(c).alias(c) for c in fields])
    return rounded(wide.select("ticker", *[F.col(f"{h}_{c}").alias(f"{c}_{h}d") for h in TIMING_H for c in fields]))


@query(
    "best_timing_pick",
    """
    select ticker, horizon best_horizon, round(net_edge, 6) best_edge, round(max(case when horizon = 10 then net_edge end) over (partition by ticker), 6) edge10
    from v_tnow where net_edge is not null qualify row_number() over (partition by ticker order by net_edge desc, horizon) = 1
    """,
)
def best_timing_pick(spark, d):
    """Best horizon per instrument and the ten-day edge in one aggregate."""
    rows = current_timing(spark, d).filter("net_edge is not null")
    best = F.max_by(F.struct("horizon", "net_edge"), F.struct("net_edge", -F.col("horizon")))
    out = rows.groupBy("ticker").agg(best.alias("b"), F.max(F.when(F.col("horizon") == 10, F.col("net_edge"))).alias("edge10"))
    return rounded(out.select("ticker", F.col("b.horizon").alias("best_horizon"), F.col("b.net_edge").alias("best_edge"), "edge10"))


@query(
    "best_cycle_horizon",
    f"""select ticker, horizon, model, {rd(['cycle_score', 'peak_mae'])} from v_tm
    qualify row_number() over (partition by ticker order by cycle_score, peak_mae, peak_day_mae, drawdown_mae, horizon, model) = 1""",
)
def best_cycle_horizon(spark, d):
    rows = cut_lineage(timing_forecasts(spark, d)).filter("close_ret is not null and pred_close_ret is not null")
    m = ME.timing_metrics(rows, ["ticker", "model", "horizon"])
    order = [F.asc(c) for c in ("cycle_score", "peak_mae", "peak_day_mae", "drawdown_mae", "horizon", "model")]
    return rounded(ME.first_per_key(m, ["ticker"], order).select("ticker", "horizon", "model", "cycle_score", "peak_mae"))


# Probabilities -------------------------------------------------------------------------
view(
    "v_prob0",
    " union all ".join(
        f"""select ticker, date, horizon, target_close ret, cast(target_close > 0 as int) y, '{name}' model, '{group}' model_group, {expr} prob
        from v_labels where horizon = {h} window k as (partition by ticker order by date rows between {n + h - 1} preceding and {h} preceding)"""
        for h in HORIZONS
        for name, group, n, expr in (
            ("baseline::share20", "baseline", 20, "case when count(target_close) over k = 20 then avg(cast(target_close > 0 as double)) over k end"),
            ("hybrid::share5", "challenger", 5, "case when count(target_close) over k = 5 then avg(cast(target_close > 0 as double)) over k end"),
        )
    ),
)
view("v_prob", "select * from v_prob0 where prob is not null and y is not null")
view(
    "v_auc",
    """
    select model, horizon, case when sum(y) > 0 and sum(1 - y) > 0 then (sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * 1.0 * sum(1 - y)) end auc
    from (select model, horizon, y, rank() over (partition by model, horizon order by prob) + (count(*) over (partition by model, horizon, prob) - 1) / 2.0 rk from v_prob) group by 1, 2
    """,
)
view(
    "v_cm",
    """
    select model, model_group, horizon, count(*) eval_rows, avg(y) base_rate, avg((prob - y) * (prob - y)) brier, avg(cast(cast(prob >= 0.5 as int) = y as int)) accuracy,
      count(case when prob >= 0.55 then 1 end) bull_rows, avg(case when prob >= 0.55 then ret end) bull_ret, avg(case when prob >= 0.55 then cast(ret > 0 as int) end) * 100 bull_hit_pct,
      count(case when prob <= 0.45 then 1 end) bear_rows, avg(case when prob <= 0.45 then ret end) bear_ret, avg(case when prob <= 0.45 then cast(ret > 0 as int) end) * 100 bear_hit_pct,
      max(auc) auc from v_prob join v_auc using (model, horizon) group by 1, 2, 3
    """,
)
CM = "base_rate brier accuracy bull_ret bull_hit_pct bear_ret bear_hit_pct auc".split()


def probabilities(spark, d):
    rows = T.horizon_targets(I.bars_table(spark, d)).filter(F.col("horizon").isin(*HORIZONS))
    rows = rows.select("ticker", "date", "horizon", F.col("target_close").alias("ret"), (F.col("target_close") > 0).cast("int").alias("y"))
    out = None
    for h in HORIZONS:
        for name, group, n in (("baseline::share20", "baseline", 20), ("hybrid::share5", "challenger", 5)):
            k = R.ordered("ticker").rowsBetween(-(n + h - 1), -h)
            one = rows.filter(F.col("horizon") == h).withColumns(
                {
                    "prob": F.when(F.count("y").over(k) == n, F.avg("y").over(k)),
                    "model": F.lit(name),
                    "model_group": F.lit(group),
                }
            )
            out = one if out is None else out.unionByName(one)
    return out


def known_probabilities(spark, d):
    rows = cut_lineage(probabilities(spark, d))
    return rows.filter("prob is not null and y is not null")


@query(
    "classification_metrics",
    f"select model, horizon, eval_rows, bull_rows, bear_rows, {rd(CM)}, round(brier + (1 - accuracy), 6) fill_score from v_cm",
)
def classification_metrics(spark, d):
    return rounded(ME.classification_metrics(known_probabilities(spark, d), ["model", "horizon"], "prob", "y", "ret"))


def class_summary(spark, d):
    return ME.classification_metrics(known_probabilities(spark, d), ["model", "model_group", "horizon"], "prob", "y", "ret")


@query(
    "model_group_comparison",
    """
    with r as (select *, row_number() over (partition by horizon order by auc desc, brier, accuracy desc, bull_ret desc, model) rn from v_cm)
    select b.horizon, w.model_group winning_group, w.model winning_model, round(w.auc, 6) winning_auc, b.model baseline_model, round(b.auc, 6) baseline_auc,
      round(b.brier, 6) baseline_brier, round(b.accuracy, 6) baseline_accuracy, round(b.bull_ret, 6) baseline_bull_ret, c.model challenger_model,
      round(c.auc, 6) challenger_auc, round(c.brier, 6) challenger_brier, round(c.accuracy, 6) challenger_accuracy, round(c.bull_ret, 6) challenger_bull_ret,
      round(c.auc - b.auc, 6) lead_auc, round(c.accuracy - b.accuracy, 6) lead_accuracy, round(c.bull_ret - b.bull_ret, 6) lead_bull_ret
    from v_cm b join v_cm c on b.horizon = c.horizon and b.model_group = 'baseline' and c.model_group = 'challenger' join r w on w.horizon = b.horizon and w.rn = 1
    """,
)
def model_group_comparison(spark, d):
    return rounded(ME.group_comparison(cut_lineage(class_summary(spark, d)), "horizon", ("baseline", "challenger")))


@query(
    "feature_set_lift",
    """
    with s as (select *, split_part(model, '::', 1) feature_set, split_part(model, '::', 2) base_model from v_cm where horizon = 5)
    select feature_set, base_model, round(auc, 6) auc, round(brier, 6) brier, round(accuracy, 6) accuracy,
      round(auc - (select auc from s where feature_set = 'baseline'), 6) auc_lift from s
    """,
)
def feature_set_lift(spark, d):
    return rounded(ME.feature_set_lift(cut_lineage(class_summary(spark, d).filter("horizon = 5"))))


@query(
    "top_k_basket",
    """
    with p as (select * from v_prob qualify row_number() over (partition by model, horizon, date order by prob desc, ticker) <= 3),
    dly as (select model, horizon, date, avg(ret) ret from p group by 1, 2, 3)
    select model, horizon, count(*) signal_days, round(avg(ret), 6) top_ret, round(avg(case when ret > 0 then 1.0 else 0 end) * 100, 6) top_hit_pct from dly group by 1, 2
    """,
)
def top_k_basket(spark, d):
    return rounded(ME.basket_returns(known_probabilities(spark, d), ["model", "horizon"], "prob", ["ret"], 3))


view(
    "v_tprob",
    """
    select ticker, horizon, model, 'GREEN' target, y, prob, ret from v_prob union all
    select ticker, horizon, model, 'RED', 1 - y, 1 - prob, -ret from v_prob
    """,
)
view(
    "v_color",
    """
    with k as (select *, rank() over (partition by ticker, horizon, model, target order by prob) + (count(*) over (partition by ticker, horizon, model, target, prob) - 1) / 2.0 rk from v_tprob)
    select ticker, horizon, model, target, (sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2.0) / nullif(sum(y) * 1.0 * sum(1 - y), 0) auc, avg((prob - y) * (prob - y)) brier,
      avg(cast(cast(prob >= 0.5 as int) = y as int)) accuracy, avg(case when prob >= 0.55 then ret end) edge, avg(case when prob >= 0.55 then cast(ret > 0 as int) end) * 100 bull_hit_pct
    from k group by 1, 2, 3, 4
    """,
)
view(
    "v_overlay",
    """
    with b as (select * from v_color qualify row_number() over (partition by ticker, horizon, target order by round(auc, 9) desc nulls last, round(brier, 9), round(accuracy, 9) desc, model) = 1),
    c0 as (select ticker, horizon, model, prob from v_prob0 qualify row_number() over (partition by ticker, horizon, model order by date desc) = 1),
    c as (select ticker, horizon, model, 'GREEN' target, prob from c0 union all select ticker, horizon, model, 'RED', 1 - prob from c0)
    select b.*, case when prob >= 0.55 then 'YES' when prob <= 0.45 then 'NO' else 'NEUTRAL' end signal,
      coalesce(auc >= 0.55 and bull_hit_pct >= 55 and edge > 0, false) usable from b left join c using (ticker, horizon, model, target)
    """,
)
view(
    "v_ovscore",
    """
    select ticker, cast(sum(case when usable then (case target when 'GREEN' then 1 else -1 end) * (case signal when 'YES' then 3 + cast(horizon >= 10 as int)
        when 'NO' then -(1 + cast(horizon >= 10 as int)) else 0 end) else 0 end) as bigint) overlay_score, count(case when usable then 1 end) usable_rows from v_overlay group by 1
    """,
)


def both_targets(rows, *keep):
    """GREEN rows and their mirrored RED rows."""
    green = rows.withColumn("target", F.lit("GREEN"))
    red = rows.withColumns({"target": F.lit("RED"), "prob": 1 - F.col("prob"), **({"y": 1 - F.col("y"), "ret": -F.col("ret")} if "y" in rows.columns else {})})
    return green.unionByName(red)


def overlay(spark, d):
    rows = cut_lineage(probabilities(spark, d))
    known = both_targets(rows.filter("prob is not null and y is not null").select("ticker", "horizon", "model", "y", "prob", "ret"))
    m = ME.classification_metrics(known, ["ticker", "horizon", "model", "target"], "prob", "y", "ret").withColumn("edge", F.col("bull_ret"))
    m = m.withColumns({f"_{c}": F.round(c, 9) for c in ("auc", "brier", "accuracy")})
    best = ME.first_per_key(
        m, ["ticker", "horizon", "target"], [F.col("_auc").desc_nulls_last(), F.asc("_brier"), F.desc("_accuracy"), F.asc("model")]
    )
    now = ME.first_per_key(rows, ["ticker", "horizon", "model"], [F.desc("date")]).select("ticker", "horizon", "model", "prob")
    now = both_targets(now)
    signal = F.when(F.col("prob") >= 0.55, "YES").when(F.col("prob") <= 0.45, "NO").otherwise("NEUTRAL")
    return ME.usable_overlay(best, now).withColumn("signal", signal)


@query(
    "model_overlay",
    f"select ticker, horizon, target, model, signal, usable, {rd(['auc', 'brier', 'edge', 'bull_hit_pct'])} from v_overlay",
)
def model_overlay(spark, d):
    return rounded(overlay(spark, d).select("ticker", "horizon", "target", "model", "signal", "usable", "auc", "brier", "edge", "bull_hit_pct"))


@query("overlay_scores", "select * from v_ovscore")
def overlay_scores(spark, d):
    return ME.overlay_score(overlay(spark, d))


view(
    "v_blend",
    """
    with f as (select ticker, horizon, pred_low_price low, pred_close_price mid, pred_high_price high from v_fc where model = 'trailing_mean' qualify row_number() over (partition by ticker, horizon order by date desc) = 1),
    r as (select ticker, horizon, pred_low_price low, pred_close_price mid, pred_high_price high, 0.75 - (least(greatest(horizon, 1), 10) - 1) * (0.35 / 9) w
      from v_fc where model = 'last_known' qualify row_number() over (partition by ticker, horizon order by date desc) = 1)
    select f.ticker, f.horizon, f.low * (1 - w) + r.low * w blend_low, f.mid * (1 - w) + r.mid * w blend_mid, f.high * (1 - w) + r.high * w blend_high
    from f join r using (ticker, horizon)
    """,
)


#: Models that stand for the variants fitted on all and on recent days.
NAIVE_VARIANTS = ("trailing_mean", "last_known")


def blended(spark, d, rows=None, variants=NAIVE_VARIANTS):
    """Range forecasts of the two variants blended by horizon."""
    rows = rows if rows is not None else cut_lineage(ohlc_forecasts(spark, d))
    latest = ME.first_per_key(rows, ["ticker", "horizon", "model"], [F.desc("date")]).select(
        "ticker", "horizon", "model", F.col("pred_low_price").alias("low"), F.col("pred_close_price").alias("mid"), F.col("pred_high_price").alias("high")
    )
    w = T.recent_weight(F.col("horizon"))
    full, recent = (latest.filter(F.col("model") == v) for v in variants)
    recent = recent.withColumns({"recent_weight": w, "full_weight": 1 - w})
    return ME.blend_variants(full, recent, ["low", "mid", "high"])


@query("range_variant_blend", f"select ticker, horizon, {rd(['blend_low', 'blend_mid', 'blend_high'], 1)} from v_blend")
def range_variant_blend(spark, d):
    return rounded(blended(spark, d), digits=1)


@query(
    "common_forecast_keys",
    "select distinct ticker, horizon from v_tnow where (ticker, horizon) in (select ticker, horizon from v_current)",
)
def common_forecast_keys(spark, d):
    """Keys present in both forecast tables."""
    a = current_timing(spark, d).select("ticker", "horizon")
    return a.intersect(current_forecasts(spark, d).select("ticker", "horizon"))


@query(
    "forecast_keys_without_ranges",
    "select distinct ticker, horizon from v_tnow where (ticker, horizon) not in (select ticker, horizon from v_current)",
)
def forecast_keys_without_ranges(spark, d):
    a = current_timing(spark, d).select("ticker", "horizon")
    return a.join(current_forecasts(spark, d).select("ticker", "horizon"), ["ticker", "horizon"], "left_anti")
