"""Feature sample and forward labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import features as FE
from barloom.operators import targets as T
from barloom.plans import inputs as I
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.sources import bars as B

view(
    "v_fj",
    "select b.ticker, b.sector, b.date, "
    + ", ".join(f'{s}."{f}" {q}_{f}' for s, q in (("b", "t"), ("i", "i"), ("p", "p")) for f in FE.FIELDS)
    + " from v_bars b join v_index i using (date) left join v_peer p using (date)",
)


def _trend_sql(s: str) -> str:
    c, v = f"{s}_close", f"{s}_volume"
    full = lambda n, x: f"case when count({x}) over f{n} = {n} then {x} end"
    pos = lambda n: f"case when count({c}) over f{n} = {n} then ({c} - min({c}) over f{n}) / nullif(max({c}) over f{n} - min({c}) over f{n}, 0) end {s}_pos{n}"
    return ", ".join(
        [
            f"({c} / nullif(lag({c}) over w, 0) - 1) * 100 {s}_ret1",
            f"({c} / nullif(lag({c}, 5) over w, 0) - 1) * 100 {s}_ret5",
            f"({c} / nullif(lag({c}, 20) over w, 0) - 1) * 100 {s}_ret20",
            f"case when count({c}) over f20 = 20 then ({c} / nullif(avg({c}) over f20, 0) - 1) * 100 end {s}_dist20",
            f"case when count({c}) over f50 = 50 then ({c} / nullif(avg({c}) over f50, 0) - 1) * 100 end {s}_dist50",
            f"({s}_open / nullif(lag({c}) over w, 0) - 1) * 100 {s}_gap",
            f"({c} - {s}_open) / nullif(lag({c}) over w, 0) * 100 {s}_body",
            f"({s}_high - {s}_low) / nullif(lag({c}) over w, 0) * 100 {s}_range",
            pos(20),
            pos(60),
            f"case when count({v}) over f20 = 20 then {v} / nullif(avg({v}) over f20, 0) end {s}_vol_ratio20",
        ]
    )


_FRAMES = "w as (partition by ticker order by date), " + ", ".join(
    f"f{n} as (partition by ticker order by date rows between {n - 1} preceding and current row)" for n in (10, 20, 50, 60)
)
view(
    "v_f1",
    f"""
    select *, (t_high - greatest(t_open, t_close)) / nullif(lag(t_close) over w, 0) * 100 t_upper_wick,
      (least(t_open, t_close) - t_low) / nullif(lag(t_close) over w, 0) * 100 t_lower_wick,
      (t_close / nullif(lag(t_close, 3) over w, 0) - 1) * 100 t_ret3, {_trend_sql('t')}, {_trend_sql('i')}, {_trend_sql('p')}
    from v_fj window {_FRAMES}
    """,
)


def _streak_sql(s: str) -> str:
    r = f"{s}_ret1"
    return f"case when {r} < 0 and lag({r}) over w < 0 then -1.0 when {r} > 0 and lag({r}) over w > 0 then 1.0 else 0.0 end {s}_streak"


def _pair_sql(x: str, y: str, out: str) -> str:
    ready = f"count(case when {x} is not null and {y} is not null then 1 end) over f20 = 20"
    return (
        f"case when {ready} then corr({x}, {y}) over f20 end corr20{out}, "
        f"case when {ready} then covar_samp({x}, {y}) over f20 / nullif(var_samp({y}) over f20, 0) end beta20{out}"
    )


view(
    "v_f2",
    f"""
    select *, case when count(t_ret1) over f10 = 10 then stddev_samp(t_ret1) over f10 end t_volatility10,
      case when count(i_ret1) over f10 = 10 then stddev_samp(i_ret1) over f10 end i_volatility10,
      t_ret5 - i_ret5 rel5, t_ret20 - i_ret20 rel20, t_ret5 - p_ret5 rel5_peer,
      {_pair_sql('t_ret1', 'i_ret1', '')}, {_pair_sql('t_ret1', 'p_ret1', '_peer')},
      {_streak_sql('t')}, {_streak_sql('i')}, {_streak_sql('p')}
    from v_f1 window {_FRAMES}
    """,
)


def _thr(name: str, x: str, n: int, q: float, floor: float, mult: float | None) -> str:
    g = f"g{n}"
    size = f"abs({x})" if mult is not None else x
    quant = f"quantile_cont({size}, {q}) over {g}"
    value = quant if mult is None else f"greatest({quant}, stddev_samp({size}) over {g} * {mult})"
    return f"case when count({x}) over {g} = {n} then greatest({value}, {floor}) end {name}"


_THRESHOLDS = [
    ("k_shock", "t_ret1", 40, 0.8, 3.0, 1.75),
    ("k_impulse", "t_ret3", 60, 0.8, 5.0, 1.5),
    ("k_wide", "t_range", 40, 0.75, 3.5, 1.25),
    ("k_trend", "t_ret5", 60, 0.75, 4.0, 1.25),
    ("k_quiet", "t_volatility10", 60, 0.35, 0.8, None),
    ("k_narrow", "t_range", 60, 0.35, 1.2, None),
    ("k_rotate", "rel5", 60, 0.75, 1.0, 1.25),
    ("k_stretch", "t_dist20", 80, 0.8, 6.0, 1.0),
    ("k_upper", "t_upper_wick", 60, 0.75, 1.5, 1.0),
    ("k_lower", "t_lower_wick", 60, 0.75, 1.5, 1.0),
]
view(
    "v_f3",
    "select *, "
    + ", ".join(_thr(*t) for t in _THRESHOLDS)
    + """, coalesce(t_dist20 >= 0, false) above, coalesce(lag(coalesce(t_dist20 >= 0, false)) over w, false) was_above,
      (t_close - t_low) / nullif(t_high - t_low, 0) in_range, abs(t_range) * sign(coalesce(t_body, 0)) signed_range from v_f2
      window w as (partition by ticker order by date), """
    + ", ".join(f"g{n} as (partition by ticker order by date rows between {n} preceding and 1 preceding)" for n in (40, 60, 80)),
)


def _three(x: str, k: str, out: str) -> str:
    return f"case when {x} >= {k} then 1.0 when {x} <= -{k} then -1.0 else 0.0 end {out}"


def _two(up: str, down: str, out: str) -> str:
    return f"case when {down} then -1.0 when {up} then 1.0 else 0.0 end {out}"


STATES = "t_limit t_shock t_impulse t_wide t_trend t_compression t_reclaim t_rotation t_exhaustion".split()
_squeeze = "t_volatility10 <= k_quiet and t_range <= k_narrow"
view(
    "v_f4",
    "select *, "
    + ", ".join(
        [
            _three("t_ret1", "6.75", "t_limit"),
            _three("t_ret1", "k_shock", "t_shock"),
            _three("t_ret3", "k_impulse", "t_impulse"),
            _three("signed_range", "k_wide", "t_wide"),
            _two("t_ret5 >= k_trend and t_pos20 >= 0.7", "t_ret5 <= -k_trend and t_pos20 <= 0.3", "t_trend"),
            _two(f"{_squeeze} and t_dist20 >= 0 and t_pos20 >= 0.45", f"{_squeeze} and t_dist20 < 0 and t_pos20 <= 0.55", "t_compression"),
            _two("above and not was_above and t_ret1 > 0", "not above and was_above and t_ret1 < 0", "t_reclaim"),
            _two("corr20 >= 0.45 and rel5 >= k_rotate", "corr20 >= 0.45 and rel5 <= -k_rotate", "t_rotation"),
            _two(
                "t_dist20 >= k_stretch and (in_range <= 0.35 or t_upper_wick >= k_upper)",
                "t_dist20 <= -k_stretch and (in_range >= 0.65 or t_lower_wick >= k_lower)",
                "t_exhaustion",
            ),
        ]
    )
    + " from v_f3",
)


def _weekly_views(s: str) -> None:
    view(
        f"v_week_{s}",
        f"""
        select ticker, wk, lag(c) over w c1, lag(c, 2) over w c2, lag(h) over w h1, lag(l) over w l1, lag(v) over w v1,
          case when row_number() over w > 4 then (lag(v) over w + lag(v, 2) over w + lag(v, 3) over w + lag(v, 4) over w) / 4.0 end m4
        from (select ticker, date_trunc('week', date + 2) wk, arg_max({s}_close, date) c, max({s}_high) h, min({s}_low) l, sum({s}_volume) v
              from v_fj group by 1, 2) window w as (partition by ticker order by wk)
        """,
    )
    view(
        f"v_wctx_{s}",
        f"""
        select ticker, date, ({s}_close / nullif(c1, 0) - 1) * 100 {s}_wtd_ret,
          (max({s}_high) over d - min({s}_low) over d) / nullif(c1, 0) * 100 {s}_wtd_range, sum({s}_volume) over d / nullif(v1, 0) * 100 {s}_wtd_volume,
          ({s}_close / nullif(h1, 0) - 1) * 100 {s}_to_week_high, ({s}_close / nullif(l1, 0) - 1) * 100 {s}_to_week_low,
          (c1 / nullif(c2, 0) - 1) * 100 {s}_week_ret, (h1 - l1) / nullif(c2, 0) * 100 {s}_week_range, v1 / nullif(m4, 0) {s}_week_vol_ratio4
        from (select *, date_trunc('week', date + 2) wk from v_fj) join v_week_{s} using (ticker, wk)
        window d as (partition by ticker, wk order by date rows between unbounded preceding and current row)
        """,
    )


_weekly_views("t")
_weekly_views("i")
view(
    "v_f5",
    "select a.*, t.* exclude (ticker, date), i.* exclude (ticker, date), t_wtd_ret - i_wtd_ret rel_wtd_ret, t_week_ret - i_week_ret rel_week_ret "
    "from v_f4 a join v_wctx_t t using (ticker, date) join v_wctx_i i using (ticker, date)",
)


def sample(spark, d):
    bars = I.bars_table(spark, d)
    return FE.feature_sample(bars, B.index_bars(bars), B.index_bars(bars, weighted=True))


def joined(spark, d):
    bars = I.bars_table(spark, d)
    return FE.join_series(bars, B.index_bars(bars), B.index_bars(bars, weighted=True))


@query("index_aligned_bars", "select * from v_fj")
def index_aligned_bars(spark, d):
    return joined(spark, d)


@query(
    "candle_anatomy",
    f"select ticker, date, {rd('t_gap t_body t_range t_upper_wick t_lower_wick'.split())} from v_f1",
)
def candle_anatomy(spark, d):
    out = FE.trend_features(joined(spark, d))
    return rounded(out.select("ticker", "date", "t_gap", "t_body", "t_range", "t_upper_wick", "t_lower_wick"))


@query("regime_states", f"select ticker, date, t_streak, {', '.join(STATES)} from v_f4")
def regime_states(spark, d):
    return FE.state_features(FE.trend_features(joined(spark, d))).select("ticker", "date", "t_streak", *STATES)


_SHOWN = ["k_shock", "k_quiet"]


@query(
    "adaptive_thresholds",
    f"select ticker, date, round(k_shock, 6) shock_limit, round(k_quiet, 6) quiet_limit from v_f3",
)
def adaptive_thresholds(spark, d):
    from barloom.functions import frames as R

    w = R.ordered("ticker")
    rows = FE.trend_features(joined(spark, d))
    return rounded(
        rows.select(
            "ticker", "date", R.adaptive_threshold("t_ret1", w, 40, 0.8, 3.0, 1.75).alias("shock_limit"),
            R.lower_quantile_threshold("t_volatility10", w, 60, 0.35, 0.8).alias("quiet_limit"),
        )
    )


@query("weekly_context", f"select ticker, date, {rd([f't_{x}' for x in FE.WEEKLY])} from v_wctx_t")
def weekly_context(spark, d):
    return rounded(FE.weekly_context(joined(spark, d), "t").select("ticker", "date", *[f"t_{x}" for x in FE.WEEKLY]))


@query(
    "feature_sample",
    f"select ticker, sector, date, t_open, t_high, t_low, t_close, {rd(FE.BASE)}, "
    + ", ".join(f"round(lag({c}, {k}) over w, 6) {c}_lag{k}" for c in FE.LAGGED for k in FE.LAGS)
    + " from v_f5 window w as (partition by ticker order by date)",
)
def feature_sample(spark, d):
    return rounded(sample(spark, d))


view(
    "v_targets",
    """
    select ticker, date, close base_close, h horizon, case h """
    + " ".join(f"when {h} then lead(date, {h}) over w" for h in range(1, 11))
    + " end forecast_date, "
    + ", ".join(
        f"case h " + " ".join(f"when {h} then lead({c}, {h}) over w" for h in range(1, 11)) + f" end actual_{c}"
        for c in ("open", "high", "low", "close")
    )
    + " from v_bars, (select unnest(range(1, 11)) h) window w as (partition by ticker, h order by date)",
)
view(
    "v_labels",
    """
    select *, (actual_open / base_close - 1) * 100 target_open, (actual_close / base_close - 1) * 100 target_close,
      case when actual_close is not null then greatest((actual_high - greatest(actual_open, actual_close)) / base_close * 100, 0) end target_upper,
      case when actual_close is not null then greatest((least(actual_open, actual_close) - actual_low) / base_close * 100, 0) end target_lower
    from v_targets
    """,
)


@query(
    "horizon_targets",
    f"""select ticker, date, base_close, cast(horizon as int) horizon, forecast_date, actual_open, actual_high, actual_low, actual_close,
      {rd('target_open target_close target_upper target_lower'.split())} from v_labels""",
)
def horizon_targets(spark, d):
    return rounded(T.horizon_targets(I.bars(spark, d)))


@query(
    "color_labels",
    """
    select cast(horizon as int) horizon, sum(cast(target_close > 0 as int)) green, sum(cast(target_close < 0 as int)) red,
      sum(cast((actual_high / base_close - 1) * 100 >= 6.75 as int)) ceiling, sum(cast((actual_low / base_close - 1) * 100 <= -6.75 as int)) floor,
      count(target_close) labelled from v_labels group by 1
    """,
)
def color_labels(spark, d):
    rows = T.color_labels(T.horizon_targets(I.bars(spark, d)))
    return rows.groupBy("horizon").agg(
        *[F.sum(f"is_{c}").alias(c) for c in ("green", "red", "ceiling", "floor")], F.count("target_close").alias("labelled")
    )


def _excursion_sql(h: int, first: int = 1) -> str:
    return f"""
    select ticker, date, {h} horizon, (max(high) over s / close - 1) * 100 peak,
      cast(arg_max(i, (high, -i)) over s - i as double) peak_day, (min(low) over l / close - 1) * 100 drawdown,
      (lead(close, {h}) over w / close - 1) * 100 close_ret
    from (select *, row_number() over (partition by ticker order by date) i from v_bars)
    window w as (partition by ticker order by date), s as (partition by ticker order by date rows between {first} following and {h} following),
      l as (partition by ticker order by date rows between 1 following and {h} following)"""


_EXC = rd("peak drawdown close_ret".split())


@query(
    "excursion_targets",
    f"select ticker, date, horizon, peak_day, {_EXC} from (" + " union all ".join(_excursion_sql(h) for h in (3, 5, 10)) + ")",
)
def excursion_targets(spark, d):
    return rounded(T.excursion_samples(I.bars(spark, d), (3, 5, 10)))


@query(
    "cycle_targets",
    f"select ticker, date, horizon, cast(horizon // 21 as int) \"months\", peak_day, {rd(['peak', 'drawdown'])} from ("
    + " union all ".join(_excursion_sql(21 * m, 3) for m in range(1, 7))
    + ")",
)
def cycle_targets(spark, d):
    return rounded(T.cycle_samples(I.bars(spark, d)))


view(
    "v_touch",
    """
    with a as (select ticker, date, close, case when count(tr) over f = 14 then avg(tr) over f end atr14,
        min(low) over (partition by ticker order by date rows between 1 following and 1 following) low1,
        min(low) over (partition by ticker order by date rows between 1 following and 5 following) low5,
        min(low) over (partition by ticker order by date rows between 1 following and 10 following) low10
      from v_ret window f as (partition by ticker order by date rows between 13 preceding and current row))
    select ticker, date, h horizon, k depth, atr14 / close * 100 atr_pct, ((close - atr14 * k) / close - 1) * 100 entry_pct,
      case when case h when 1 then low1 when 5 then low5 else low10 end <= close - atr14 * k then 1.0 else 0.0 end touched
    from a, (select unnest([1, 5, 10]) h), (select unnest([0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0]::double[]) k) where atr14 is not null
    """,
)


@query(
    "touch_label_rates",
    """select horizon, depth, count(*) row_count, round(avg(touched), 6) touch_rate, round(avg(atr_pct), 6) atr_pct, round(avg(entry_pct), 6) entry_pct
    from v_touch group by 1, 2""",
)
def touch_label_rates(spark, d):
    rows = T.touch_labels(I.bars(spark, d))
    return rounded(
        rows.groupBy("horizon", "depth").agg(
            F.count(F.lit(1)).alias("row_count"), F.avg("touched").alias("touch_rate"), F.avg("atr_pct").alias("atr_pct"),
            F.avg("entry_pct").alias("entry_pct"),
        )
    )


@query(
    "recent_variant_slice",
    """
    with c as (select *, dense_rank() over (order by date desc) r from v_bars)
    select ticker, 'full' variant, count(*) bars, min(date) first_date from c group by 1
    union all select ticker, 'recent', count(*), min(date) from c where r <= 252 group by 1
    union all select ticker, 'quarter', count(*), min(date) from c where r <= 63 group by 1
    """,
)
def recent_variant_slice(spark, d):
    """Training slices of all, the last 252 and the last 63 trading dates, stacked with a variant label."""
    bars = I.bars_table(spark, d)
    out = None
    for name, n in (("full", None), ("recent", 252), ("quarter", 63)):
        part = (T.recent_dates(bars, n) if n else bars).groupBy("ticker").agg(
            F.lit(name).alias("variant"), F.count(F.lit(1)).alias("bars"), F.min("date").alias("first_date")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "horizon_blend_weight",
    "select horizon, count(*) row_count, round(0.75 - (least(greatest(horizon, 1), 10) - 1) * (0.35 / 9), 9) recent_weight from (select cast(horizon as int) horizon from v_targets) group by 1",
)
def horizon_blend_weight(spark, d):
    rows = T.horizon_targets(I.bars(spark, d)).groupBy("horizon").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumn("recent_weight", F.round(T.recent_weight(F.col("horizon")), 9))
