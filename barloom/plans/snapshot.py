"""Technical snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import smoothing as SM
from barloom.functions.frames import full_max, full_min, full_std, non_zero, ordered
from barloom.operators import snapshot as S
from barloom.operators import universe as U
from barloom.plans import inputs as I
from barloom.plans.registry import query, view
from barloom.session import cut_lineage
from barloom.sources import bars as B


def rounded(df, *keep, digits=6):
    """Round every floating-point column except the named ones."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if t == "double" and c not in keep else F.col(c)
            for c, t in df.dtypes
        ]
    )


def per_unit(x: str) -> str:
    return f"(case when {x} < 10 then 100 when {x} < 50 then 20 when {x} is not null then 10 end)"


def snap_sql(x: str, fn: str = "round") -> str:
    steps = f"(cast(cast({x} as varchar) as decimal(24,14)) * {per_unit(x)})"
    return f"(cast({fn}({steps}) as double) / {per_unit(x)})"


def clamp_sql(x: str, low: str, high: str) -> str:
    return f"(case when {x} is not null then least(greatest({x}, {low}), {high}) end)"


def r(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) {n}" for n in names)


def live(spark, d):
    """Latest trade that was not returned, as the live quote of an instrument."""
    kept = I.trades(spark, d).filter("flag = 'N'").withColumn("at", F.col("date").cast("timestamp_ntz"))
    last = B.latest_snapshot(kept, "ticker", "at", "price", "size", ["seq"])
    return last.select("ticker", (F.col("last_price") / I.PRICE_UNIT).alias("price"), "day_volume", "day_value")


def snap(spark, d):
    bars = I.bars_table(spark, d)
    return S.snapshot(bars, B.index_bars(bars), live(spark, d), I.PRICE_UNIT)


def technical(spark, d):
    return S.technical(cut_lineage(snap(spark, d)))


def dataset(spark, d):
    """Snapshot with bands, grid, ratios and signals."""
    return S.with_signals(S.with_ratios(S.with_grid(S.with_bands(technical(spark, d)))))


def ema_sql(x: str, a: float) -> str:
    return f"list_reduce(list(cast({x} as double) order by date), lambda p, q: p * (1 - {a!r}) + q * {a!r})"


view(
    "v_live",
    """
    with k as (select *, max(date) over (partition by ticker) m from v_trades where flag = 'N')
    select ticker, first(price order by ok desc, ln desc, price desc) / 1000000.0 price, cast(sum(size) as bigint) day_volume,
      cast(sum(price * size) as bigint) day_value from k where date = m group by ticker
    """,
)
view(
    "v_ret",
    """
    select b.*, close / nullif(lag(close) over (partition by ticker order by date), 0) - 1 ret,
      close - lag(close) over (partition by ticker order by date) step,
      greatest(high - low, abs(high - lag(close) over (partition by ticker order by date)),
        abs(low - lag(close) over (partition by ticker order by date))) tr, iret,
      count(*) over (partition by ticker) n,
      row_number() over (partition by ticker order by date desc) - 1 age
    from v_bars b left join (select date, close / nullif(lag(close) over (order by date), 0) - 1 iret from v_index) using (date)
    """,
)
view(
    "v_fold",
    f"""
    select ticker, {ema_sql('close', 2 / 21)} ema20, {ema_sql('tr', 1 / 14)} atr14,
      list_reduce(list(cast(greatest(step, 0) as double) order by date) filter (step is not null), lambda p, q: p * (1 - {1 / 14!r}) + q * {1 / 14!r}) up,
      list_reduce(list(cast(greatest(-step, 0) as double) order by date) filter (step is not null), lambda p, q: p * (1 - {1 / 14!r}) + q * {1 / 14!r}) dn,
      list_reduce(list({{'f': cast(close as double), 's': cast(close as double), 'g': cast(0 as double)}} order by date),
        lambda p, q: {{'f': p.f * (1 - {2 / 13!r}) + q.f * {2 / 13!r}, 's': p.s * (1 - {2 / 27!r}) + q.s * {2 / 27!r},
          'g': p.g * 0.8 + (p.f * (1 - {2 / 13!r}) + q.f * {2 / 13!r} - p.s * (1 - {2 / 27!r}) - q.s * {2 / 27!r}) * 0.2}}) m
    from v_ret group by ticker
    """,
)
view(
    "v_snap0",
    """
    select ticker, sector, max(date) last_date, max(n) bars, max(case when age = 0 then close end) / 1e6 last_close,
      max(case when age = 1 then close end) / 1e6 prev_close, max(case when age = 0 then volume end) volume,
      case when max(n) >= 20 then avg(case when age < 20 then close end) end / 1e6 sma20,
      case when max(n) >= 50 then avg(case when age < 50 then close end) end / 1e6 sma50,
      case when max(n) >= 200 then avg(case when age < 200 then close end) end / 1e6 sma200,
      case when max(n) >= 20 then stddev_samp(case when age < 20 then close end) end / 1e6 std20,
      stddev_samp(case when age < 20 then ret end) * 100 vol20_pct, stddev_samp(case when age < 60 then ret end) * 100 vol60_pct,
      covar_samp(ret, iret) / nullif(var_samp(case when ret is not null then iret end), 0) beta, corr(ret, iret) corr,
      (max(case when age = 0 then close end) / nullif(max(case when age = 5 then close end), 0) - 1) * 100 ret5,
      (max(case when age = 0 then close end) / nullif(max(case when age = 20 then close end), 0) - 1) * 100 ret20,
      (max(case when age = 0 then close end) / nullif(max(case when age = 60 then close end), 0) - 1) * 100 ret60,
      case when max(n) >= 20 then avg(case when age < 20 then volume end) end adv20,
      max(case when age < 252 then high end) / 1e6 high252, min(case when age < 252 then low end) / 1e6 low252
    from v_ret group by ticker, sector
    """,
)
view(
    "v_snap1",
    f"""
    select s.*, case when bars >= 20 then ema20 / 1e6 end ema20, case when bars > 14 then atr14 / 1e6 end atr14,
      case when bars > 14 then 100 - 100 / (1 + up / nullif(dn, 0)) end rsi14,
      case when bars >= 26 then (m.f - m.s) / 1e6 end macd, case when bars >= 26 then m.g / 1e6 end macd_signal,
      day_volume, day_value, case when price is null then 'close' else 'intraday' end price_source,
      coalesce(price, last_close) raw_last
    from v_snap0 s join v_fold using (ticker) left join v_live using (ticker)
    """,
)
view(
    "v_snap",
    f"""
    select *, macd - macd_signal macd_hist, atr14 / nullif(last_close, 0) * 100 atr_pct,
      (last_close / nullif(high252, 0) - 1) * 100 pct_from_high, (last_close / nullif(low252, 0) - 1) * 100 pct_to_low,
      {snap_sql('raw_last')} last, ({snap_sql('raw_last')} / nullif(last_close, 0) - 1) * 100 change_pct,
      ({snap_sql('raw_last')} - sma20) / nullif(std20, 0) z20, sma20 + 2 * std20 band_up, sma20 - 2 * std20 band_down,
      case when adv20 > 0 then day_volume / adv20 end intraday_pct_adv
    from v_snap1
    """,
)
view(
    "v_tech",
    f"""
    select *, last_close ref, {snap_sql('(last_close * (1 - 0.07))', 'ceil')} floor_,
      {snap_sql('(last_close * (1 + 0.07))', 'floor')} ceil_, 1.0 / {per_unit('last_close')} tick from v_snap
    """,
)

SNAP_ROUNDED = (
    "last_close prev_close sma20 sma50 sma200 ema20 rsi14 atr14 atr_pct macd macd_signal macd_hist std20 vol20_pct vol60_pct "
    "beta corr ret5 ret20 ret60 adv20 high252 low252 pct_from_high pct_to_low last change_pct z20 band_up band_down intraday_pct_adv"
).split()


@query(
    "technical_snapshot",
    f"select ticker, sector, last_date, bars, volume, day_volume, day_value, price_source, {r(*SNAP_ROUNDED)} from v_snap",
)
def technical_snapshot(spark, d):
    return rounded(snap(spark, d))


@query(
    "technical_contract",
    f"""select ticker, sector, price_source, day_volume, day_value, {r(*'last ref change_pct sma20 sma50 sma200 ema20 rsi14 atr14 vol20_pct vol60_pct macd macd_signal beta corr z20 ret5 ret20 ret60 adv20 intraday_pct_adv high252 low252'.split())}
    from v_tech""",
)
def technical_contract(spark, d):
    return rounded(technical(spark, d))


def _tech(spark, d):
    return S.with_bands(technical(spark, d))


@query(
    "price_bands",
    'select ticker, ref, floor_ "floor", ceil_ "ceil", tick from v_tech',
)
def price_bands(spark, d):
    return _tech(spark, d).select("ticker", "ref", "floor", "ceil", "tick")


def _ladder_sql(direction: str) -> str:
    name = "below" if direction == "-" else "above"
    stages, prev, cols = [], "v_tech", []
    for i in (1, 2, 3):
        src = "last" if i == 1 else f"{name}{i - 1}"
        value = snap_sql(f"({src} {direction} 1.0 / {per_unit(src)})")
        stages.append(f"{name}_s{i} as (select *, {clamp_sql(value, 'floor_', 'ceil_')} {name}{i} from {prev})")
        prev = f"{name}_s{i}"
        cols.append(f"{name}{i}")
    return ", ".join(stages), f"select ticker, {', '.join(cols)} from {prev}"


_down, _down_sel = _ladder_sql("-")
_up, _up_sel = _ladder_sql("+")


@query(
    "tick_grid",
    f"""
    with {_down}, {_up}
    select ticker, last, {clamp_sql(snap_sql('(last - tick)'), 'floor_', 'ceil_')} bid1,
      {clamp_sql(snap_sql('(last + tick)'), 'floor_', 'ceil_')} ask1,
      round(greatest((last - floor_) / tick, 0), 4) ticks_to_floor, round(greatest((ceil_ - last) / tick, 0), 4) ticks_to_ceil,
      below1, below2, below3, above1, above2, above3
    from v_tech join ({_down_sel}) using (ticker) join ({_up_sel}) using (ticker)
    """,
)
def tick_grid(spark, d):
    g = S.with_grid(_tech(spark, d))
    return g.select(
        "ticker", "last", "bid1", "ask1", F.round("ticks_to_floor", 4).alias("ticks_to_floor"),
        F.round("ticks_to_ceil", 4).alias("ticks_to_ceil"), *[f"{n}{i}" for n in ("below", "above") for i in (1, 2, 3)],
    )


@query(
    "snapshot_ratios",
    """
    select ticker, round(atr14 / nullif(last, 0) * 100, 6) atr_pct, round(adv20 * last, 6) adtv, 100 lot_size,
      round(100 * last, 6) lot_notional, round(100 * atr14, 6) lot_atr, round(tick / nullif(last, 0) * 100, 6) slippage_pct,
      round(least(greatest((last - low252) / nullif(high252 - low252, 0), 0), 1), 6) pos52,
      cast(last > sma20 as int) above_sma20, cast(last > sma50 as int) above_sma50, cast(last > sma200 as int) above_sma200,
      round((last / nullif(ref, 0) - 1) * 100, 6) dist_ref_pct, round((last / nullif(sma20, 0) - 1) * 100, 6) dist_sma20_pct,
      round((last / nullif(sma50, 0) - 1) * 100, 6) dist_sma50_pct, coalesce(last > floor_, false) floor_valid,
      coalesce(last < ceil_, false) ceil_valid,
      rank() over (order by adv20 * last desc) * 1.0 adtv_rank,
      round(rank() over (order by adv20 * last desc) / count(adv20 * last) over () * 100, 6) adtv_rank_pct
    from v_tech
    """,
)
def snapshot_ratios(spark, d):
    out = S.with_liquidity_rank(S.with_ratios(_tech(spark, d)))
    cols = (
        "ticker atr_pct adtv lot_size lot_notional lot_atr slippage_pct pos52 above_sma20 above_sma50 above_sma200 "
        "dist_ref_pct dist_sma20_pct dist_sma50_pct floor_valid ceil_valid adtv_rank adtv_rank_pct"
    ).split()
    return rounded(out.select(*cols))


@query(
    "signal_scores",
    """
    with s as (
      select *, round(case when rsi14 >= 55 then 0.4 else 0 end + case when ret20 >= 0 then 0.3 else 0 end
          + case when macd > macd_signal then 0.3 else 0 end, 6) fit_momentum,
        case when z20 <= -0.5 then 0.5 else 0 end + case when atr14 > 0 and last - floor_ <= atr14 then 0.5 else 0 end fit_reversion
      from v_tech)
    select ticker, cast(fit_momentum as double) fit_momentum, cast(fit_reversion as double) fit_reversion,
      round(case when atr14 = 0 then 0 else least((ceil_ - last) / atr14, (last - floor_) / atr14) end, 6) band_distance,
      array_to_string(list_filter([case when adv20 is null or adv20 < 10000 then 'LOW_LIQ' end,
        case when ceil_ - last <= 1.0 / case when last < 10 then 100 when last < 50 then 20 else 10 end
          or last - floor_ <= 1.0 / case when last < 10 then 100 when last < 50 then 20 else 10 end then 'NEAR_LIMIT' end,
        case when price_source <> 'intraday' then 'STALE_SNAPSHOT' end,
        case when atr14 is null or atr14 = 0 then 'ZERO_ATR' end], lambda f: f is not null), '|') risk_flags,
      cast(round((fit_momentum + fit_reversion) / 2, 6) as double) fit_balanced
    from s
    """,
)
def signal_scores(spark, d):
    out = S.with_signals(_tech(spark, d))
    return rounded(out.select("ticker", "fit_momentum", "fit_reversion", "band_distance", "risk_flags", "fit_balanced"))


@query(
    "order_sizing",
    """
    with s as (
      select t.ticker, adv20, last, atr14, p.quantity target, (p.quantity // 3) current_ from v_tech t join v_pos p using (ticker)),
    c as (select *, abs(target - current_) delta,
        case when target = current_ then 0 when adv20 * 0.02 <= 0 then 1
          else greatest(1, ceil(abs(target - current_) / (adv20 * 0.02))) end n from s)
    select ticker, target - current_ delta_qty, cast(floor(least(adv20 * 0.1, 500000) / 100) * 100 as bigint) max_order_qty,
      cast(n as bigint) slice_count, round(adv20 * last, 6) liquidity, round(atr14 / last, 6) volatility,
      case when n > 0 then cast(round_even(delta / n / 100, 0) * 100 as bigint) else 0 end slice_qty
    from c
    """,
)
def order_sizing(spark, d):
    held = I.positions(spark, d).select(
        "ticker", F.col("quantity").alias("target"), F.expr("floor(quantity / 3)").cast("long").alias("current")
    )
    out = S.with_sizing(_tech(spark, d).join(held, "ticker"), "target", "current")
    return rounded(out.select("ticker", "delta_qty", "max_order_qty", "slice_count", "liquidity", "volatility", "slice_qty"))


def _near(side: str) -> str:
    mean = "sma20 - 0.5 * atr14" if side == "buy" else "sma20 + 0.5 * atr14"
    sign = "-" if side == "buy" else "+"
    first = "last + 1.0 / pu" if side == "buy" else "last + 2 * (1.0 / pu)"
    rest = "null" if side == "buy" else "last - 1.0 / pu"
    return (
        f"case preset when 'momentum' then {first} when 'mean_reversion' then {mean} "
        f"when 'balanced' then (last + sma20) / 2.0 {sign} 1.0 / pu else {rest} end"
    )


@query(
    "preset_levels",
    f"""
    with p as (select t.*, {per_unit('last')} pu, unnest(['momentum', 'mean_reversion', 'balanced', 'risk_off']) preset from v_tech t),
    a as (select *, {_near('buy')} rb, {_near('sell')} rs from p),
    n as (select *, {clamp_sql(snap_sql('rb'), 'floor_', 'ceil_')} near_buy, {clamp_sql(snap_sql('rs'), 'floor_', 'ceil_')} near_sell from a),
    o as (select *, case when near_buy is not null then least(near_buy, sma20 - 0.5 * atr14) end b1,
        case when near_sell is not null then greatest(near_sell, sma20 + 0.5 * atr14) end s1,
        case when near_buy is not null then least(near_buy, sma20 - 1.0 * atr14) end b2,
        case when near_sell is not null then greatest(near_sell, sma20 + 1.0 * atr14) end s2 from n)
    select ticker, preset, case preset when 'momentum' then 'BUY' when 'risk_off' then 'SELL' else 'BOTH' end side, near_buy, near_sell,
      {clamp_sql(snap_sql('b1'), 'floor_', 'ceil_')} opp1_buy, {clamp_sql(snap_sql('s1'), 'floor_', 'ceil_')} opp1_sell,
      {clamp_sql(snap_sql('b2'), 'floor_', 'ceil_')} opp2_buy, {clamp_sql(snap_sql('s2'), 'floor_', 'ceil_')} opp2_sell
    from o
    """,
)
def preset_levels(spark, d):
    return S.preset_levels(_tech(spark, d))


@query(
    "weakness_shortlist",
    """
    select ticker from v_snap where not (rsi14 <= 60 and pct_to_low <= 80 and ret20 <= 30 and ret60 <= 40) and ticker <> 'NATION_3'
      or ticker = 'NATION_7'
    """,
)
def weakness_shortlist(spark, d):
    weak = U.weakness(60.0, 80.0, 30.0, 40.0, below_averages=False)
    return U.shortlist(snap(spark, d), weak, keep=["NATION_7"], exclude=["NATION_3"]).select("ticker")


@query(
    "weakness_any",
    """
    select ticker, coalesce(rsi14 <= 40, false) or coalesce(ret20 <= -15, false) or coalesce(last < sma50 and last < sma200, false) weak
    from v_snap
    """,
)
def weakness_any(spark, d):
    weak = U.weakness(40.0, None, -15.0, None, require_all=False)
    return snap(spark, d).select("ticker", weak.alias("weak"))


@query(
    "public_snapshot",
    "select ticker, sector, price_source, last, ref, tick from v_tech",
)
def public_snapshot(spark, d):
    """Published columns only: scores and sizing are dropped, nothing else is computed for them."""
    full = S.with_signals(S.with_ratios(_tech(spark, d)))
    internal = [c for c in full.columns if c not in ("ticker", "sector", "price_source", "last", "ref", "tick")]
    return S.public_columns(full, internal)


# Whole-history series -------------------------------------------------------------------


@query(
    "moving_average_series",
    """
    select ticker, date, case when count(*) over (w rows between 19 preceding and current row) = 20
        then round(avg(close) over (w rows between 19 preceding and current row), 6) end sma20,
      case when count(*) over (w rows between 49 preceding and current row) = 50
        then round(avg(close) over (w rows between 49 preceding and current row), 6) end sma50
    from v_bars window w as (partition by ticker order by date)
    """,
)
def moving_average_series(spark, d):
    from barloom.functions.frames import full_mean

    w = ordered("ticker")
    return I.bars(spark, d).select(
        "ticker", "date", *[F.round(full_mean("close", w, n), 6).alias(f"sma{n}") for n in (20, 50)]
    )


_SERIES = """
    with recursive src as (select ticker, date, {x} x, row_number() over (partition by ticker order by date) rn from {src}),
    fold as (
      select ticker, rn, cast(x as double) s from src where rn = 1
      union all
      select f.ticker, f.rn + 1, f.s * (1 - {a!r}) + b.x * {a!r} from fold f join src b on b.ticker = f.ticker and b.rn = f.rn + 1)
    select ticker, date, round(s, 1) {out} from fold join src using (ticker, rn)
"""


@query("ema_series", _SERIES.format(x="close", src="v_bars", a=2 / 21, out="ema20"))
def ema_series(spark, d):
    return SM.with_ema(I.bars(spark, d), {"ema20": 20}).select("ticker", "date", F.round("ema20", 1).alias("ema20"))


@query("atr_series", _SERIES.format(x="tr", src="v_ret", a=1 / 14, out="atr14"))
def atr_series(spark, d):
    return SM.with_atr(I.bars(spark, d), 14, "atr14").select("ticker", "date", F.round("atr14", 1).alias("atr14"))


@query(
    "rsi_series",
    f"""
    with recursive src as (select ticker, date, greatest(step, 0) u, greatest(-step, 0) v,
        row_number() over (partition by ticker order by date) - 1 rn from v_ret),
    fold as (
      select ticker, rn, cast(u as double) su, cast(v as double) sv from src where rn = 1
      union all
      select f.ticker, f.rn + 1, f.su * (1 - {1 / 14!r}) + b.u * {1 / 14!r}, f.sv * (1 - {1 / 14!r}) + b.v * {1 / 14!r}
      from fold f join src b on b.ticker = f.ticker and b.rn = f.rn + 1)
    select s.ticker, date, round(100 - 100 / (1 + su / nullif(sv, 0)), 6) rsi14
    from src s left join fold f on s.ticker = f.ticker and s.rn = f.rn
    """,
)
def rsi_series(spark, d):
    return SM.with_rsi(I.bars(spark, d), 14, "rsi14").select("ticker", "date", F.round("rsi14", 6).alias("rsi14"))


@query(
    "macd_series",
    f"""
    with recursive src as (select ticker, date, close, row_number() over (partition by ticker order by date) rn from v_bars),
    fold as (
      select ticker, rn, cast(close as double) f, cast(close as double) s, cast(0 as double) g from src where rn = 1
      union all
      select p.ticker, p.rn + 1, p.f * (1 - {2 / 13!r}) + b.close * {2 / 13!r}, p.s * (1 - {2 / 27!r}) + b.close * {2 / 27!r},
        p.g * 0.8 + (p.f * (1 - {2 / 13!r}) + b.close * {2 / 13!r} - p.s * (1 - {2 / 27!r}) - b.close * {2 / 27!r}) * 0.2
      from fold p join src b on b.ticker = p.ticker and b.rn = p.rn + 1)
    select ticker, date, case when rn >= 26 then round(f - s, 2) end macd, case when rn >= 26 then round(g, 2) end macd_signal,
      case when rn >= 26 then round(f - s - g, 2) end macd_hist
    from fold join src using (ticker, rn)
    """,
)
def macd_series(spark, d):
    return rounded(SM.with_macd(I.bars(spark, d)).select("ticker", "date", "macd", "macd_signal", "macd_hist"), digits=2)


@query(
    "mean_based_atr_rsi",
    """
    select ticker, date, case when count(tr) over f = 14 then round(avg(tr) over f, 6) end atr14,
      case when count(step) over f = 14 then round(100 - 100 / (1 + avg(greatest(step, 0) * case when step is not null then 1 end) over f
        / nullif(avg(greatest(-step, 0) * case when step is not null then 1 end) over f, 0)), 6) end rsi14
    from v_ret window f as (partition by ticker order by date rows between 13 preceding and current row)
    """,
)
def mean_based_atr_rsi(spark, d):
    from barloom.operators.panel import mean_atr, mean_rsi

    w = ordered("ticker")
    rows = I.bars(spark, d).withColumn("_tr", SM.true_range(w)).withColumn(
        "_step", F.col("close") - F.lag("close").over(w)
    )
    return rounded(rows.select("ticker", "date", mean_atr("_tr", w).alias("atr14"), mean_rsi("_step", w).alias("rsi14")))


@query(
    "bollinger_series",
    """
    select ticker, date, round((close - m) / nullif(s, 0), 6) z20, round(m + 2 * s, 2) band_up, round(m - 2 * s, 2) band_down
    from (select ticker, date, close, case when count(*) over f = 20 then avg(close) over f end m,
            case when count(*) over f = 20 then stddev_samp(close) over f end s
          from v_bars window f as (partition by ticker order by date rows between 19 preceding and current row))
    """,
)
def bollinger_series(spark, d):
    from barloom.functions.frames import full_mean

    w = ordered("ticker")
    rows = I.bars(spark, d).withColumns({"m": full_mean("close", w, 20), "s": full_std("close", w, 20)})
    return rows.select(
        "ticker", "date", F.round((F.col("close") - F.col("m")) / non_zero("s"), 6).alias("z20"),
        F.round(F.col("m") + 2 * F.col("s"), 2).alias("band_up"), F.round(F.col("m") - 2 * F.col("s"), 2).alias("band_down"),
    )


@query(
    "year_range_series",
    """
    select ticker, date, max(high) over f high252, min(low) over f low252,
      round((close / max(high) over f - 1) * 100, 6) pct_from_high, round((close / min(low) over f - 1) * 100, 6) pct_to_low
    from v_bars window f as (partition by ticker order by date rows between 251 preceding and current row)
    """,
)
def year_range_series(spark, d):
    f = ordered("ticker").rowsBetween(-251, 0)
    rows = I.bars(spark, d).withColumns({"high252": F.max("high").over(f), "low252": F.min("low").over(f)})
    return rows.select(
        "ticker", "date", "high252", "low252",
        F.round((F.col("close") / F.col("high252") - 1) * 100, 6).alias("pct_from_high"),
        F.round((F.col("close") / F.col("low252") - 1) * 100, 6).alias("pct_to_low"),
    )


@query(
    "drawdown_breakout",
    """
    select ticker, date, case when count(*) over f60 = 60 then round(close / max(close) over f60 - 1, 6) end dd60,
      case when count(*) over f120 = 120 then round(close / max(close) over f120 - 1, 6) end dd120,
      case when count(*) over p20 = 20 then max(high) over p20 end prior_high20
    from v_bars window f60 as (partition by ticker order by date rows between 59 preceding and current row),
      f120 as (partition by ticker order by date rows between 119 preceding and current row),
      p20 as (partition by ticker order by date rows between 20 preceding and 1 preceding)
    """,
)
def drawdown_breakout(spark, d):
    from barloom.functions.frames import full_frame

    w = ordered("ticker")
    return I.bars(spark, d).select(
        "ticker", "date",
        *[F.round(F.col("close") / full_max("close", w, n) - 1, 6).alias(f"dd{n}") for n in (60, 120)],
        full_frame(F.max, "high", w, 20, shift=1).alias("prior_high20"),
    )
