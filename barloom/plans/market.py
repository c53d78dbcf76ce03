"""Breadth, sectors, portfolio, flows, factors, point-in-time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import factors as FA
from barloom.operators import market as M
from barloom.operators import snapshot as S
from barloom.plans import ingest as G
from barloom.plans import inputs as I
from barloom.plans import snapshot as SN
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage
from barloom.sources import bars as B
from barloom.sources import flows as FL
from barloom.sources import statements as ST

view(
    "v_ranges",
    "select "
    + ", ".join(
        f"""least(greatest(case when h{n} = l{n} then 0.5 else (close - l{n}) / nullif(h{n} - l{n}, 0) end, 0), 1) range_pos{n},
        (h{n} - close) / nullif(close, 0) * 100 to_upper{n}, (close - l{n}) / nullif(close, 0) * 100 to_lower{n},
        (close / nullif(h{n}, 0) - 1) * 100 drawdown{n}, (close / nullif(l{n}, 0) - 1) * 100 rebound{n}"""
        for n in (20, 60, 120)
    )
    + " from (select close, "
    + ", ".join(
        f"case when count(*) over f{n} = {n} then max(close) over f{n} end h{n}, case when count(*) over f{n} = {n} then min(close) over f{n} end l{n}"
        for n in (20, 60, 120)
    )
    + ", row_number() over (order by date desc) rn from v_index window "
    + ", ".join(f"f{n} as (order by date rows between {n - 1} preceding and current row)" for n in (20, 60, 120))
    + ") where rn = 1",
)
view(
    "v_regime",
    f"""
    select case when close > sma50 and sma50 > sma200 then 'Bull' when close < sma50 and sma50 < sma200 then 'Bear' else 'Sideway' end regime, rk atr_pct_rank
    from (
      select date, close, avg(close) over (order by date rows between 49 preceding and current row) sma50,
        avg(close) over (order by date rows between 199 preceding and current row) sma200 from v_index) l,
      (with s as (select date, close, row_number() over (order by date) rn,
          greatest(high - low, abs(high - lag(close) over (order by date)), abs(low - lag(close) over (order by date))) tr from v_index),
       a as (select date, close, list_reduce(list(cast(tr as double)) over (order by date rows between 500 preceding and current row),
              lambda p, q: p * (1 - {1 / 14!r}) + q * {1 / 14!r}) / close * 100 ap from s)
       select avg(cast(ap <= (select ap from a order by date desc limit 1) as int)) * 100 rk from a) r
    where date = (select max(date) from v_index)
    """,
)
view(
    "v_comove",
    """
    select ticker, avg(cast((ret > 0) = (iret > 0) as int)) * 100 comove20,
      case when count(*) >= 5 and var_samp(iret) > 0 then corr(ret, iret) end corr20,
      case when count(*) >= 5 and var_samp(iret) > 0 then covar_samp(ret, iret) / var_samp(iret) end beta20
    from (select ticker, ret, iret, row_number() over (partition by ticker order by date desc) rn from v_ret where ret is not null and iret is not null)
    where rn <= 20 group by ticker
    """,
)
RANGE_COLS = [f"{m}{n}" for n in (20, 60, 120) for m in ("range_pos", "to_upper", "to_lower", "drawdown", "rebound")]


@query("index_range_metrics", f"select {rd(RANGE_COLS)} from v_ranges")
def index_range_metrics(spark, d):
    return rounded(M.index_range_metrics(I.index(spark, d)))


@query("index_regime", "select regime, round(atr_pct_rank, 6) atr_pct_rank from v_regime")
def index_regime(spark, d):
    return rounded(M.index_regime(I.index(spark, d)))


@query("index_comovement", f"select ticker, {rd(['comove20', 'corr20', 'beta20'])} from v_comove")
def index_comovement(spark, d):
    bars = I.bars_table(spark, d)
    return rounded(M.comovement(bars, B.index_bars(bars)))


SUMMARY_RANGE = [c for c in RANGE_COLS if c not in ("drawdown20", "rebound20", "drawdown120", "rebound120")]


@query(
    "market_breadth_summary",
    f"""
    with w as (select ticker, date, close,
        case when count(*) over f20 = 20 then avg(close) over f20 end m20, case when count(*) over f50 = 50 then avg(close) over f50 end m50,
        case when count(*) over f200 = 200 then avg(close) over f200 end m200, case when count(*) over f20 = 20 then max(close) over f20 end h20,
        case when count(*) over f20 = 20 then min(close) over f20 end l20, close / lag(close, 1) over o - 1 r1, close / lag(close, 5) over o - 1 r5,
        close / lag(close, 20) over o - 1 r20 from v_bars window o as (partition by ticker order by date),
        f20 as (partition by ticker order by date rows between 19 preceding and current row),
        f50 as (partition by ticker order by date rows between 49 preceding and current row),
        f200 as (partition by ticker order by date rows between 199 preceding and current row)),
    l as (select max(date) date, count(*) breadth_count, avg(cast(close > m20 as int)) * 100 above_sma20_pct, avg(cast(close > m50 as int)) * 100 above_sma50_pct,
        avg(cast(close > m200 as int)) * 100 above_sma200_pct, avg(cast(r1 > 0 as int)) * 100 positive1_pct, avg(cast(r5 > 0 as int)) * 100 positive5_pct,
        case when count(case when r1 < 0 then 1 end) = 0 then nullif(count(case when r1 > 0 then 1 end), 0)
          else count(case when r1 > 0 then 1 end) / count(case when r1 < 0 then 1 end) end advance_decline,
        avg(cast(close >= h20 as int)) * 100 new_high20_pct, avg(cast(close <= l20 as int)) * 100 new_low20_pct, stddev_samp(r20) * 100 dispersion20
      from w where date = (select max(date) from v_bars))
    select date, breadth_count, {rd('above_sma20_pct above_sma50_pct above_sma200_pct positive1_pct positive5_pct advance_decline new_high20_pct new_low20_pct dispersion20'.split())},
      (select count(distinct ticker) from v_bars) universe_count, 'working_universe' breadth_source, round(avg_co, 6) comove20, round(med_c, 6) median_corr20,
      {rd(SUMMARY_RANGE)}, regime, round(atr_pct_rank, 6) atr_pct_rank
    from l, (select avg(comove20) avg_co, median(corr20) med_c from v_comove), v_ranges, v_regime
    """,
)
def market_breadth_summary(spark, d):
    bars = I.bars_table(spark, d)
    basket = I.instruments(spark, d)
    return rounded(M.breadth_summary(bars, B.index_bars(bars), basket))


view(
    "v_rel",
    """
    select s.*, ret20 - i20 rel20, ret60 - i60 rel60 from v_tech s,
      (select (close / lag(close, 20) over (order by date) - 1) * 100 i20, (close / lag(close, 60) over (order by date) - 1) * 100 i60,
         row_number() over (order by date desc) rn from v_index) i where rn = 1
    """,
)
view(
    "v_foreign",
    """
    select ticker, date, sum(case when is_sell then -size else size end) net_shares, sum(case when is_sell then -size * price else size * price end) net_value
    from v_flow_trades where is_foreign group by 1, 2
    """,
)
view(
    "v_prop",
    """
    select ticker, date, sum(case when is_sell then -size else size end) net_shares, sum(case when is_sell then -size * price else size * price end) net_value
    from v_flow_trades where is_prop group by 1, 2
    """,
)


def _flow_sql(prefix: str, src: str) -> str:
    cols = ", ".join(
        f"cast(sum(case when rn <= {n} then net_shares end) as bigint) {prefix}shares_{n}d, cast(sum(case when rn <= {n} then net_value end) as bigint) {prefix}value_{n}d"
        for n in (1, 5, 20)
    )
    return f"""select ticker, max(date) {prefix}flow_date, {cols}
      from (select *, row_number() over (partition by ticker order by date desc) rn from {src}) where rn <= 20 group by ticker"""


view("v_flows", f"select * from ({_flow_sql('foreign_', 'v_foreign')}) full join ({_flow_sql('prop_', 'v_prop')}) using (ticker)")


def flow_layers(spark, d):
    t = I.flow_trades(spark, d)
    f = FL.last_n_sums(FL.daily_flows(t, F.col("is_foreign"), F.col("is_sell")), prefix="foreign_")
    p = FL.last_n_sums(FL.daily_flows(t, F.col("is_prop"), F.col("is_sell")), prefix="prop_")
    return f.join(p, "ticker", "full")


@query("flow_horizon_sums", "select * from v_flows")
def flow_horizon_sums(spark, d):
    return flow_layers(spark, d)


def members(spark, d, bars=None):
    """Snapshot rows with relative strength, co-movement and flows: input of the sector tables."""
    bars = bars if bars is not None else I.bars_table(spark, d)
    index = B.index_bars(bars)
    snap = cut_lineage(S.snapshot(bars, index, SN.live(spark, d), I.PRICE_UNIT))
    tech = S.with_ratios(S.with_grid(S.with_bands(S.technical(snap))))
    moves = M.comovement(bars, index)
    return M.enrich(M.relative_strength(tech, index), moves, flow_layers(spark, d))


@query(
    "relative_strength",
    """
    select ticker, round(rel20, 6) rel20, round(rel60, 6) rel60,
      round((rank() over (order by rel20) + (count(*) over (partition by rel20) - 1) / 2.0) / count(*) over () * 100, 6) rel20_rank,
      round((rank() over (order by rel60) + (count(*) over (partition by rel60) - 1) / 2.0) / count(*) over () * 100, 6) rel60_rank
    from v_rel
    """,
)
def relative_strength(spark, d):
    bars = I.bars_table(spark, d)
    index = B.index_bars(bars)
    snap = S.snapshot(bars, index, SN.live(spark, d), I.PRICE_UNIT).select("ticker", "ret20", "ret60")
    return rounded(M.relative_strength(snap, index).select("ticker", "rel20", "rel60", "rel20_rank", "rel60_rank"))


view(
    "v_members",
    """
    select r.*, (last / nullif(sma20, 0) - 1) * 100 dist_sma20_pct, (last / nullif(sma50, 0) - 1) * 100 dist_sma50_pct, comove20, corr20, beta20,
      foreign_value_5d, foreign_value_20d, prop_value_5d, prop_value_20d, foreign_shares_5d, foreign_flow_date
    from v_rel r left join v_comove using (ticker) left join v_flows using (ticker)
    """,
)
MED = "ret5 ret20 ret60 rel20 rel60".split()
SECTOR_COLS = [f"median_{c}" for c in MED] + ["breadth20", "breadth50", "positive5", "mean_comove20"]
FLOW_MED = "foreign_value_5d foreign_value_20d prop_value_5d prop_value_20d".split()


@query(
    "sector_summary",
    f"""
    with s as (select sector, count(*) members, avg(case when dist_sma20_pct > 0 then 1.0 else 0 end) * 100 breadth20,
      avg(case when dist_sma50_pct > 0 then 1.0 else 0 end) * 100 breadth50, avg(case when ret5 > 0 then 1.0 else 0 end) * 100 positive5,
      {', '.join(f'median({c}) median_{c}' for c in MED)}, avg(comove20) mean_comove20, {', '.join(f'median({c}) median_{c}' for c in FLOW_MED)},
      nullif(sum(adv20), 0) adtv from v_members group by sector)
    select sector, members, {rd(SECTOR_COLS)}, {', '.join(f'round(median_{c}, 1) median_{c}' for c in FLOW_MED)}, round(adtv, 6) adtv,
      round(rank() over (order by adtv desc) / count(adtv) over () * 100, 6) adtv_rank_pct from s
    """,
)
def sector_summary(spark, d):
    out = M.sector_summary(members(spark, d))
    out = out.withColumns({f"median_{c}": F.round(f"median_{c}", 1) for c in FLOW_MED})
    return rounded(out, *[f"median_{c}" for c in FLOW_MED])


@query(
    "sector_regimes",
    """
    with s as (select sector, median(ret20) median_ret20, nullif(sum(adv20), 0) adtv from v_tech group by sector)
    select sector, round(median_ret20, 6) median_ret20, round(adtv, 6) adtv,
      case when median_ret20 >= 1 then 'Bull' when median_ret20 <= -1 then 'Bear' else 'Sideway' end regime,
      round(rank() over (order by adtv desc) / count(adtv) over () * 100, 6) adtv_rank_pct from s
    """,
)
def sector_regimes(spark, d):
    return rounded(M.sector_regimes(SN.snap(spark, d).select("sector", "ret20", "adv20")))


view(
    "v_report",
    """
    select ticker, p.sector, quantity, avg_price, last, quantity * coalesce(last, 0) market_value, quantity * avg_price cost,
      quantity * coalesce(last, 0) - quantity * avg_price unrealized,
      (quantity * coalesce(last, 0) - quantity * avg_price) / nullif(quantity * avg_price, 0) pnl
    from v_pos p left join (select ticker, last from v_tech) using (ticker) where quantity <> 0
    """,
)


@query(
    "portfolio_positions",
    f"select ticker, sector, quantity, {rd('avg_price last market_value cost unrealized pnl'.split(), 4)} from v_report",
)
def portfolio_positions(spark, d):
    return rounded(M.position_report(I.positions(spark, d), SN.snap(spark, d)), digits=4)


@query(
    "sector_exposure",
    """
    select sector, round(sum(market_value), 3) market_value, round(sum(market_value) / (select sum(market_value) from v_report), 6) weight,
      round((sum(market_value) - sum(cost)) / nullif(sum(cost), 0), 6) pnl from v_report group by sector
    """,
)
def sector_exposure(spark, d):
    report = cut_lineage(M.position_report(I.positions(spark, d), SN.snap(spark, d)))
    return rounded(M.sector_exposure(report).withColumn("market_value", F.round("market_value", 3)), "market_value")


@query(
    "book_weights",
    """
    with t as (select sum(market_value) tot from v_report),
    r as (select s.ticker, s.sector, s.adv20, s.atr14, s.beta, coalesce(quantity, 0) quantity, coalesce(market_value, 0) market_value
      from v_tech s left join v_report using (ticker))
    select ticker, sector, quantity, round(quantity / nullif(adv20, 0) * 100, 6) position_pct_adv, round(atr14 * quantity, 4) position_atr,
      round(tot, 3) book_value, round(market_value / nullif(tot, 0) * 100, 6) weight_pct,
      round(sum(market_value) over (partition by sector) / nullif(tot, 0) * 100, 6) sector_weight_pct,
      round(market_value / nullif(tot, 0) * coalesce(beta, 0), 6) beta_contribution
    from r, t
    """,
)
def book_weights(spark, d):
    tech = cut_lineage(SN.technical(spark, d))
    report = cut_lineage(M.position_report(I.positions(spark, d), tech))
    out = M.book_weights(tech.drop("last"), report)
    out = out.withColumns({"position_atr": F.round("position_atr", 4), "book_value": F.round("book_value", 3)})
    return rounded(
        out.select(
            "ticker", "sector", "quantity", "position_pct_adv", "position_atr", "book_value", "weight_pct", "sector_weight_pct",
            "beta_contribution",
        ),
        "position_atr", "book_value",
    )


@query(
    "snapshot_enrichment",
    """
    with b as (select s_nationkey k, avg(s_acctbal) pb from supplier group by 1)
    select ticker, round(coalesce(pb, last), 6) pb, round(comove20, 6) comove20, foreign_flow_date, cast(foreign_shares_5d as bigint) foreign_shares_5d
    from v_members m join v_inst using (ticker) left join b on b.k = n_nationkey
    """,
)
def snapshot_enrichment(spark, d):
    """Layers joined to the snapshot; a fundamental value wins over the existing one."""
    base = members(spark, d).withColumn("pb", F.col("last"))
    book = (
        I.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.avg("s_acctbal").alias("pb"))
        .join(I.instruments(spark, d), "n_nationkey").select("ticker", "pb")
    )
    out = M.enrich(base, prefer=book, fields=["pb"])
    return rounded(out.select("ticker", "pb", "comove20", "foreign_flow_date", "foreign_shares_5d"))


@query(
    "point_in_time_facts",
    """
    select b.ticker, b.date, b.close, f.available_date matched_available_date, f.period_end, f.revenue, f.units
    from (select ticker, date, close from v_bars) b asof left join v_statement f on b.ticker = f.ticker and f.available_date <= b.date
    """,
)
def point_in_time_facts(spark, d):
    """Daily bars with the last statement published by that day."""
    facts = I.quarters(spark, d).withColumn("available_date", ST.available_date(F.col("period_end")))
    return ST.asof_backward(I.bars(spark, d).select("ticker", "date", "close"), facts, "ticker", "date", "available_date")


view(
    "v_filled",
    """
    select factor, date, last_value("value" ignore nulls) over (partition by factor order by date rows between unbounded preceding and current row) "value"
    from (select distinct factor from v_factors) cross join (select distinct date from v_bars) left join v_factors using (factor, date)
    """,
)
view(
    "v_fret",
    """
    select *, case when count(fret) over f20 = 20 then stddev_samp(fret) over f20 end * 100 fvol20
    from (select *, "value" / nullif(lag("value") over w, 0) - 1 fret, ("value" / nullif(lag("value", 5) over w, 0) - 1) * 100 fret5,
            ("value" / nullif(lag("value", 20) over w, 0) - 1) * 100 fret20
          from v_filled window w as (partition by factor order by date))
    window f20 as (partition by factor order by date rows between 19 preceding and current row)
    """,
)
view(
    "v_pairs",
    """
    select ticker, date, r, fwd5, age, factor, fret from (
      select ticker, date, close / lag(close) over w - 1 r, lead(close, 5) over w / close - 1 fwd5,
        row_number() over (partition by ticker order by date desc) - 1 age from v_bars window w as (partition by ticker order by date))
      join v_fret using (date)
    """,
)
view(
    "v_sens",
    """
    select ticker, factor, case when count(case when age < 20 and r is not null and fret is not null then 1 end) = 20 then (covar_samp(r, fret) filter (age < 20)) / nullif((stddev_samp(r) filter (age < 20)) * (stddev_samp(fret) filter (age < 20)), 0) end corr20,
      case when count(case when age < 20 and r is not null and fret is not null then 1 end) = 20 then (covar_samp(r, fret) filter (age < 20)) / nullif(var_samp(fret) filter (age < 20), 0) end beta20,
      case when count(case when age < 60 and r is not null and fret is not null then 1 end) = 60 then (covar_samp(r, fret) filter (age < 60)) / nullif((stddev_samp(r) filter (age < 60)) * (stddev_samp(fret) filter (age < 60)), 0) end corr60,
      case when count(case when age < 60 and r is not null and fret is not null then 1 end) = 60 then (covar_samp(r, fret) filter (age < 60)) / nullif(var_samp(fret) filter (age < 60), 0) end beta60,
      max(g.fret20) fret20
    from v_pairs join (select factor, arg_max(fret20, date) fret20 from v_fret group by 1) g using (factor) group by 1, 2
    """,
)


def factor_parts(spark, d):
    bars = I.bars_table(spark, d)
    returns = cut_lineage(FA.factor_returns(FA.fill_on_calendar(I.factors(spark, d), bars)))
    return bars, returns


@query(
    "factor_calendar_fill",
    f"""select factor, date, "value", {rd('fret fret5 fret20 fvol20'.split())} from v_fret""",
)
def factor_calendar_fill(spark, d):
    return rounded(FA.factor_returns(FA.fill_on_calendar(I.factors(spark, d), I.bars_table(spark, d))))


@query(
    "factor_regime",
    f"""select factor, date, "value", {rd('fret5 fret20 fvol20'.split())} from v_fret where date = (select max(date) from v_bars)""",
)
def factor_regime(spark, d):
    return rounded(FA.factor_regime(FA.factor_returns(FA.fill_on_calendar(I.factors(spark, d), I.bars_table(spark, d)))))


@query(
    "factor_sensitivity",
    f"""select ticker, factor, {rd('corr20 beta20 corr60 beta60 fret20'.split())}, round(corr60 * fret20, 6) alignment20,
      row_number() over (partition by ticker order by abs(corr60) desc nulls last, corr60 * fret20 desc nulls last, factor) factor_rank from v_sens""",
)
def factor_sensitivity(spark, d):
    bars, returns = factor_parts(spark, d)
    return rounded(FA.rank_factors(FA.sensitivities(FA.pair_with_factors(bars, returns), FA.factor_regime(returns))))


@query(
    "factor_shocks",
    """
    with u as (select * from v_pairs where r is not null and fwd5 is not null and fret is not null),
    l as (select ticker, factor, case when count(case when fret > 0 then 1 end) >= 10 then quantile_cont(case when fret > 0 then fret end, 0.9) end ua,
        case when count(case when fret < 0 then 1 end) >= 10 then quantile_cont(case when fret < 0 then fret end, 0.1) end da from u group by 1, 2)
    select ticker, factor, count(case when fret >= ua then 1 end) up_shocks, count(case when fret <= da then 1 end) down_shocks,
      round(avg(case when fret >= ua then r end) * 100, 6) r_on_up, round(avg(case when fret >= ua then fwd5 end) * 100, 6) fwd5_on_up,
      round(avg(case when fret <= da then r end) * 100, 6) r_on_down, round(avg(case when fret <= da then fwd5 end) * 100, 6) fwd5_on_down
    from u join l using (ticker, factor) group by 1, 2
    """,
)
def factor_shocks(spark, d):
    bars, returns = factor_parts(spark, d)
    return rounded(FA.factor_shocks(cut_lineage(FA.pair_with_factors(bars, returns))))


@query(
    "benchmark_first_order",
    """
    select ticker, last_close from (select ticker, arg_max(close, date) last_close from v_bars group by 1
      union all select 'VNINDEX', arg_max(close, date) from v_index)
    """,
)
def benchmark_first_order(spark, d):
    """Index row stacked on the instruments and sorted first."""
    bars = I.bars_table(spark, d)
    last = bars.groupBy("ticker").agg(F.max_by("close", "date").alias("last_close"))
    top = B.index_bars(bars).agg(F.lit("VNINDEX").alias("ticker"), F.max_by("close", "date").alias("last_close"))
    return M.benchmark_first(top.unionByName(last), ["VNINDEX"])
