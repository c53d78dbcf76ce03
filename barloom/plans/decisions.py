"""Ladders, watchlist, verdicts, tranches, allocation and instrument state."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import decisions as D
from barloom.operators import features as FE
from barloom.operators import intraday as ID
from barloom.operators import market as M
from barloom.plans import features as PF
from barloom.plans import inputs as I
from barloom.plans import intraday as PI  # noqa: F401  (named sub-selects)
from barloom.plans import market as PM
from barloom.plans import metrics as PX
from barloom.plans import trades as PT
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import _down, _down_sel, _up, _up_sel, clamp_sql, rounded, snap_sql
from barloom.operators import trades as TR
from barloom.session import cut_lineage
from barloom.sources import bars as B

BUDGET = 50_000.0
UNIT = I.PRICE_UNIT

view("v_below", f"with {_down} {_down_sel}")
view(
    "v_lbase",
    f"""
    select t.ticker, last, atr14, tick, floor_, ceil_, {clamp_sql(snap_sql('(last - tick)'), 'floor_', 'ceil_')} bid1, below1, below2, below3,
      o.pred_low_price / 1e6 low_t1, o.pred_close_price / 1e6 close_t1, o.pred_close_ret forecast_ret, b5.blend_low / 1e6 low_t5, b10.blend_low / 1e6 low_t10,
      c.close * (1 + c.pred_peak / 100) / 1e6 cycle_peak_price, c.close * (1 + c.pred_drawdown / 100) / 1e6 cycle_drawdown_price, c.pred_peak cycle_peak, c.pred_drawdown cycle_drawdown
    from v_tech t join v_below using (ticker) left join (select * from v_current where horizon = 1) o using (ticker)
      left join (select * from v_blend where horizon = 5) b5 using (ticker) left join (select * from v_blend where horizon = 10) b10 using (ticker)
      left join (select * from v_tnow where horizon = 10) c using (ticker)
    """,
)
_anchor_sql = ", ".join(
    f"{{'pos': {i}, 'anchor': '{n}', 'raw': {x}}}"
    for i, (n, x) in enumerate(
        zip(
            (*D.TACTICAL, *D.HISTORICAL),
            ("bid1", "below1", "below2", "below3", "low_t1", "low_t5", "low_t10", "cycle_drawdown_price", "last - atr14", "last - 1.5 * atr14"),
        )
    )
)
view(
    "v_lcand",
    f"""
    with a as (select ticker, last, tick, floor_, ceil_, unnest([{_anchor_sql}]) x from v_lbase),
    s as (select ticker, last, x.pos pos, x.anchor anchor, least(greatest(cast(floor(cast(cast(x.raw as varchar) as decimal(24,14)) * cast(round(1.0 / tick) as int)) as double) / round(1.0 / tick), floor_), ceil_) limit_price
      from a where x.raw > 0),
    m as (select ticker, limit_price, string_agg(anchor, '|' order by pos) anchors, max(pos >= 4) old, max(pos < 4) tac from s where limit_price <= last + 1e-9 group by 1, 2)
    select ticker, limit_price, anchors, case when old and tac then 'mixed' when old then 'historical' else 'tactical' end anchor_class,
      row_number() over (partition by ticker order by limit_price desc) price_rank from m
    """,
)


def _fill(ref: str) -> str:
    return f"(case when {ref} is not null then least(greatest(100.0 / (1 + exp(-(limit_price - {ref}) / greatest(greatest(atr14 * 0.5, tick * 2), 1e-6))), 1), 99) end)"


view(
    "v_ladder0",
    f"""
    with o as (
      select l.ticker, l.limit_price, t.horizon, (t.close * (1 + t.pred_peak / 100) / 1e6 / l.limit_price - 1) * 100 pk, (t.close * (1 + t.pred_drawdown / 100) / 1e6 / l.limit_price - 1) * 100 dd, t.pred_peak_day
      from v_lcand l join v_tnow t using (ticker)),
    e as (select *, pk - abs(least(dd, 0)) - 0.06 edge from o where pk is not null and dd is not null),
    b as (select *, case when abs(dd) > 1e-9 then pk / abs(dd) end rr from e
      qualify row_number() over (partition by ticker, limit_price order by edge / greatest(pred_peak_day, 1) desc, edge desc, horizon) = 1)
    select l.* exclude (ticker, limit_price), ticker, limit_price, atr14, tick, b.horizon timing_horizon, b.edge timing_edge, b.rr timing_reward_risk, (close_t1 / limit_price - 1) * 100 - 0.06 next_close_edge,
      (cycle_peak_price / limit_price - 1) * 100 - abs(least((cycle_drawdown_price / limit_price - 1) * 100, 0)) - 0.06 cycle_edge,
      {_fill('low_t1')} fill_t1, {_fill('low_t5')} fill_t5, {_fill('low_t10')} fill_t10, {_fill('cycle_drawdown_price')} fill_cycle
    from v_lcand l join v_lbase using (ticker) left join b using (ticker, limit_price)
    """,
)
view(
    "v_ladder",
    """
    with f as (select *, list_avg(list_filter([fill_t1, fill_t5, fill_t10, fill_cycle], lambda x: x is not null)) fill from v_ladder0),
    s as (select *, (0.5 * timing_edge + 0.3 * cycle_edge + 0.2 * next_close_edge) * coalesce(least(greatest(fill, 0), 100), 0) / 100 entry_score from f)
    select *, row_number() over (partition by ticker order by entry_score desc nulls last, price_rank) entry_rank from s
    """,
)


def shared_inputs(spark, d):
    """(members, OHLC forecast rows, timing rows) over bars written once."""
    bars = I.bars_table(spark, d)
    people = cut_lineage(PM.members(spark, d, bars))
    ohlc = cut_lineage(PX.ohlc_forecasts(spark, d, bars))
    timing = cut_lineage(PX.timing_forecasts(spark, d, bars))
    return bars, people, ohlc, timing


def ladder_parts(spark, d, people, ohlc, timing_rows, variants=PX.NAIVE_VARIANTS):
    """(base, ladder, current timing) from shared inputs; ``variants`` are the models blended for the range."""
    closes = people.select("ticker", F.col("ref").alias("_c"))
    now = cut_lineage(PX.current_timing(spark, d, timing_rows).join(closes, "ticker")
    )
    t1 = PX.current_forecasts(spark, d, ohlc).filter("horizon = 1").select(
        "ticker", (F.col("pred_low_price") / UNIT).alias("low_t1"), (F.col("pred_close_price") / UNIT).alias("close_t1"),
        F.col("pred_close_ret").alias("forecast_ret"),
    )
    blend = PX.blended(spark, d, ohlc, variants)
    lows = blend.groupBy("ticker").agg(
        *[F.max(F.when(F.col("horizon") == h, F.col("blend_low") / UNIT)).alias(f"low_t{h}") for h in (5, 10)]
    )
    prices = now.select(
        "ticker", "horizon", F.col("pred_peak_day").alias("peak_day"), "pred_peak", "pred_drawdown", "net_edge",
        (F.col("_c") * (1 + F.col("pred_peak") / 100)).alias("peak_price"),
        (F.col("_c") * (1 + F.col("pred_drawdown") / 100)).alias("drawdown_price"),
        (F.col("_c") * (1 + F.col("pred_close_ret") / 100)).alias("close_price"),
    )
    cycle = prices.filter("horizon = 10").select(
        "ticker", F.col("peak_price").alias("cycle_peak_price"), F.col("drawdown_price").alias("cycle_drawdown_price"),
        F.col("pred_peak").alias("cycle_peak"), F.col("pred_drawdown").alias("cycle_drawdown"),
    )
    people_base = people.select(
        "ticker", "last", "atr14", "tick", "floor", "ceil", "floor_valid", "ceil_valid", "bid1", "below1", "below2", "below3"
    )
    base = cut_lineage(M.enrich(people_base, t1, lows, cycle))
    ladder = cut_lineage(D.entry_ladder(D.limit_candidates(base), base, prices))
    return base, ladder, prices


def ladder_of(spark, d):
    _, people, ohlc, timing = shared_inputs(spark, d)
    return ladder_parts(spark, d, people, ohlc, timing)


LAD = "timing_edge timing_reward_risk next_close_edge cycle_edge fill_t1 fill_t5 fill_t10 fill_cycle fill entry_score".split()


@query(
    "entry_ladder",
    f"select ticker, limit_price, anchors, anchor_class, price_rank, entry_rank, timing_horizon, {rd(LAD)} from v_ladder",
)
def entry_ladder(spark, d):
    return rounded(ladder_of(spark, d)[1], "limit_price")


view(
    "v_entry",
    """
    select ticker, limit_price, entry_score, fill, anchor_class from v_ladder
    qualify row_number() over (partition by ticker order by case when anchor_class in ('historical', 'mixed') then 0 else 1 end, entry_rank, limit_price) = 1
    """,
)


@query("best_entry", f"select ticker, limit_price, anchor_class, {rd(['entry_score', 'fill'])} from v_entry")
def best_entry(spark, d):
    return rounded(D.best_entry(ladder_of(spark, d)[1]), "limit_price")


view(
    "v_tranches",
    """
    with c as (select *, max(anchor_class in ('historical', 'mixed')) over (partition by ticker) any_old from v_ladder),
    k as (select *, row_number() over (partition by ticker order by entry_rank, price_rank) rn from c where not any_old or anchor_class in ('historical', 'mixed')),
    r as (select *, greatest(coalesce(entry_score, 0), 0) * (1 + 0.015 * least(greatest(coalesce(fill, 0), 0), 100)) / sqrt(greatest(entry_rank, 1)) raw from k where rn <= 3),
    w as (select *, sum(raw) over (partition by ticker) tot, count(*) over (partition by ticker) n, row_number() over (partition by ticker order by limit_price desc) pos from r),
    s as (select *, round_even(case when tot > 0 then 100.0 * raw / nullif(tot, 0) else 100.0 / n end, 2) sh from w)
    select ticker, case pos when 1 then 'shallow_core' when 2 then 'mid_core' else 'deep_core' end role_, limit_price, entry_rank,
      round(sh + case when pos = n then round(100.0 - sum(sh) over (partition by ticker), 2) else 0 end, 2) share_pct from s
    """,
)


view(
    "v_plan",
    f"""
    with p as (select ticker, role_, limit_price, share_pct w, share_pct / sum(share_pct) over (partition by ticker) * 100 share_pct, last from v_tranches join (select ticker, last from v_tech) using (ticker)),
    c as (select *, cast(round_even({BUDGET * 100} * share_pct / 100.0, 0) as bigint) capital from p),
    q as (select *, cast(floor(capital / (limit_price * 1000 * 10)) * 10 as bigint) quantity from c)
    select *, cast(round_even(quantity * limit_price * 1000, 0) as bigint) order_value, last <= limit_price actionable from q
    """,
)


def plan_of(spark, d):
    base, ladder, _ = ladder_of(spark, d)
    tranches = D.core_tranches(ladder).join(base.select("ticker", "last"), "ticker")
    tranches = tranches.withColumns({"allocated": F.col("share_pct"), "cap": F.lit(None).cast("double")})
    return D.budget_plan(tranches, BUDGET * 100, 10)


@query(
    "budget_plan",
    'select ticker, role_ "role", limit_price, round(share_pct, 4) share_pct, capital, quantity, order_value, actionable from v_plan',
)
def budget_plan(spark, d):
    return plan_of(spark, d).select(
        "ticker", "role", "limit_price", F.round("share_pct", 4).alias("share_pct"), "capital", "quantity", "order_value", "actionable"
    )


@query(
    "budget_deploy_now",
    """select ticker, round(coalesce(sum(case when actionable then share_pct end), 0), 4) now_pct, cast(coalesce(sum(case when actionable then order_value end), 0) as bigint) now_value,
      cast(coalesce(sum(case when actionable then quantity end), 0) as bigint) now_quantity from v_plan group by 1""",
)
def budget_deploy_now(spark, d):
    return D.deploy_now(plan_of(spark, d)).withColumn("now_pct", F.round("now_pct", 4))


# Watchlist -----------------------------------------------------------------------------
view(
    "v_crowd",
    """
    select r.range_pos20 >= 0.95 and b.b20 >= 75 and b.p5 >= 55 crowded from v_ranges r, (
      select avg(cast(close > m as int)) * 100 b20, avg(cast(r5 > 0 as int)) * 100 p5 from (
        select date, close, case when count(*) over f = 20 then avg(close) over f end m, close / lag(close, 5) over (partition by ticker order by date) - 1 r5 from v_bars
        window f as (partition by ticker order by date rows between 19 preceding and current row)) where date = (select max(date) from v_bars)) b
    """,
)
view(
    "v_pbest",
    """
    select ticker, robust_score, all_score from v_playbook qualify row_number() over (partition by ticker order by round(robust_score, 9) desc, round(test_score, 9) desc,
      round(train_score, 9) desc, round(all_score, 9) desc, config_id) = 1
    """,
)
view(
    "v_tbest",
    """
    select ticker, net_edge best_edge, max(case when horizon = 10 then net_edge end) over (partition by ticker) edge10, horizon from v_tnow where net_edge is not null
    qualify row_number() over (partition by ticker order by net_edge desc, horizon) = 1
    """,
)
view(
    "v_cand0",
    f"""
    select m.ticker, m.sector, m.last, m.rsi14, m.dist_sma20_pct dist, m.rel20, m.rel60, m.adv20, least(greatest((m.last - low252) / nullif(high252 - low252, 0), 0), 1) pos52,
      sp.p5 sector_positive5, p.robust_score, p.all_score, t.best_edge, t.edge10, l.forecast_ret, e.entry_score, e.limit_price, case when e.limit_price is not null then greatest(e.limit_price - 2 * m.tick, 0) end zl, e.limit_price zh,
      l.below1, l.below2, l.below3, o.overlay_score, m.foreign_value_20d / 1e12 foreign_bn, crowded, {BUDGET} / (m.last * 1000 * m.adv20) * 100 pct_adv
    from v_members m join (select sector, avg(case when ret5 > 0 then 1.0 else 0 end) * 100 p5 from v_members group by 1) sp using (sector)
      left join v_lbase l using (ticker) left join v_entry e using (ticker) left join v_pbest p using (ticker) left join v_tbest t using (ticker) left join v_ovscore o using (ticker), v_crowd
    """,
)
view(
    "v_cand1",
    """
    select *, coalesce(zl, least(below1, below2, below3)) zone_low, coalesce(zh, greatest(below1, below2, below3)) zone_high, case when zh is not null then 'ladder' else 'grid' end zone_source from v_cand0
    """,
)
view(
    "v_cand2",
    """
    select *, case when last between zone_low and zone_high then 'inside' when last > zone_high then 'above' else 'below' end zone_status,
      case when last between zone_low and zone_high then 0 when last > zone_high then (last / zone_high - 1) * 100 else (zone_low / last - 1) * 100 end gap from v_cand1
    """,
)


def _t(x: str, lo: float, hi: float) -> str:
    return f"coalesce(case when {x} is not null then least(greatest({x}, {lo}), {hi}) end, 0)"


view(
    "v_cand3",
    f"""
    select *, least(greatest(50 + {_t('coalesce(all_score, 0) * 0.3', -12, 12)} + {_t('coalesce(robust_score, 0) * 0.3', -15, 15)} + {_t('rel20 * 0.25', -8, 8)} + {_t('rel60 * 0.15', -5, 5)}
      + {_t('(sector_positive5 - 50) * 0.12', -6, 6)} + case when pct_adv <= 5 then 10 when pct_adv <= 10 then 6 when pct_adv <= 15 then 1.5 when pct_adv <= 20 then -4 when pct_adv is null then -4 else greatest(-16, -4 - (pct_adv - 20) * 0.6) end
      + {_t('foreign_bn / 200', -4, 4)}
      + case when zone_source <> 'ladder' then 0 when zone_status = 'inside' then 10 when zone_status = 'above' then case when gap <= 3 then 2 when gap <= 8 then -2 else -6 end else case when gap <= 2 then 1 else -4 end end
      - case when dist > 8 then {_t('(dist - 8) * 1.3', 0, 16)} else 0 end - case when rsi14 > 65 then {_t('(rsi14 - 65) * 0.9', 0, 12)} else 0 end
      - case when pos52 >= 0.75 then {_t('(pos52 - 0.75) * 36', 0, 9)} else 0 end + {_t('best_edge * 0.8', -12, 12)} + {_t('edge10 * 0.3', -6, 6)} + {_t('forecast_ret * 1.3', -6, 6)}
      + {_t('entry_score * 1.5', 0, 10)} + {_t('cast(overlay_score as double)', -6, 6)} - case when crowded then case zone_status when 'above' then 8 else 4 end else 0 end, 0), 100) score,
      coalesce(dist >= 18 or rsi14 >= 74, false) very, coalesce(dist >= 12 or rsi14 >= 68, false) str, coalesce(best_edge < -1.5 and (edge10 is null or edge10 < 0), false) tbad,
      coalesce(forecast_ret < -1, false) fbad, coalesce(pct_adv > 20, false) lbad, coalesce(robust_score, 0) < 0 and coalesce(all_score, 0) < 20 pbad from v_cand2
    """,
)
view(
    "v_cand4",
    """
    select *, case when lbad or very and tbad or pbad and tbad then 'không_mua'
      when zone_status = 'inside' then case when zone_source = 'ladder' and score >= 62 and not very and not tbad and not fbad then 'mua_ngay'
        when zone_source = 'ladder' and score >= 58 and best_edge is null and forecast_ret is null and not str then 'mua_ngay' when score >= 52 then 'chờ' else 'không_mua' end
      when zone_status = 'above' then case when score >= 48 and not (very and tbad) then 'chờ' else 'không_mua' end
      else case when score >= 55 then 'chờ' else 'không_mua' end end d0 from v_cand3
    """,
)
ORACLE_WATCH = """
    with r as (select *, case when decision = 'mua_ngay' and zone_status = 'inside' then last else zone_low end reference_price from v_watch)
    select ticker, sector, decision, round(score, 6) score, zone_source, zone_status, round(gap, 6) zone_gap, reference_price,
      coalesce(cast(floor(50000 / (reference_price * 1000 * 100)) * 100 as bigint), 0) reference_quantity, round(pct_adv, 6) pct_adv,
      row_number() over (partition by decision order by round_even(score, 2) desc, ticker) decision_rank from r
"""
view("v_watch", "select *, case when d0 = 'mua_ngay' and (crowded and zone_status <> 'inside' or zone_source <> 'ladder' or very or tbad) then 'chờ' else d0 end decision from v_cand4")


@query("candidate_watchlist", ORACLE_WATCH)
def candidate_watchlist(spark, d):
    """Scores and decisions over snapshot, playbook, timing, forecasts, ladder and overlays."""
    bars, people, ohlc, timing = shared_inputs(spark, d)
    return watchlist(spark, d, bars, people, *ladder_parts(spark, d, people, ohlc, timing))


def watchlist(spark, d, bars, people, base, ladder, prices):
    indicators = cut_lineage(TR.playbook_indicators(bars))
    configs = TR.catalogue_table(spark)
    labels = TR.label_trades(indicators, configs)
    scores = TR.playbook_scores(TR.trade_metrics(TR.non_overlapping(labels)), people.select("ticker"), configs)
    scores = scores.withColumns({s: F.round(s, 9) for s in PT.SCORES})
    book = TR.best_playbook(scores).select("ticker", "robust_score", "all_score")
    best = prices.filter("net_edge is not null").groupBy("ticker").agg(
        F.max("net_edge").alias("best_edge"), F.max(F.when(F.col("horizon") == 10, F.col("net_edge"))).alias("edge10")
    )
    from barloom.operators import metrics as ME

    overlay = ME.overlay_score(PX.overlay(spark, d)).select("ticker", "overlay_score")
    sectors = people.groupBy("sector").agg((F.avg(F.when(F.col("ret5") > 0, 1.0).otherwise(0.0)) * 100).alias("sector_positive5"))
    rows = people.join(sectors, "sector")
    forecast = base.select("ticker", "forecast_ret")
    rows = M.enrich(rows, forecast, D.best_entry(ladder).select("ticker", "limit_price", "entry_score"), book, best, overlay)
    rows = rows.withColumns(
        {
            "state_low": F.lit(None).cast("double"),
            "state_high": F.lit(None).cast("double"),
            "latest_signal": F.lit(False),
            "archetype_score": F.lit(0),
            "foreign_bn": F.col("foreign_value_20d") / 1e12,
        }
    )
    summary = M.breadth_summary(bars, B.index_bars(bars))
    crowded = summary.select(
        (F.col("range_pos20") >= 0.95) & (F.col("above_sma20_pct") >= 75) & (F.col("positive5_pct") >= 55)
    ).scalar()
    out = D.rank_decisions(D.candidate_scores(D.preferred_zone(rows), BUDGET, crowded))
    return rounded(
        out.select(
            "ticker", "sector", "decision", "score", "zone_source", "zone_status", "zone_gap", "reference_price",
            "reference_quantity", "pct_adv", "decision_rank",
        ),
        "reference_price",
    )


@query(
    "state_in_words",
    "select ticker, date, case when w <> '' then w else 'neutral' end state from (select ticker, date, array_to_string(list_filter(["
    + ", ".join(f"case when {c} >= 0.5 then '{a}' when {c} <= -0.5 then '{b}' end" for c, (a, b) in D.STATE_WORDS.items())
    + "], lambda x: x is not null), ', ') w from v_f4)",
)
def state_in_words(spark, d):
    rows = FE.state_features(FE.trend_features(PF.joined(spark, d)))
    return rows.select("ticker", "date", D.state_summary().alias("state"))


# Regimes, conviction, allocation -------------------------------------------------------
view(
    "v_sreg",
    """
    select sector, case when count(*) <= 1 then 'mixed'
      when avg(case when dist_sma20_pct > 0 then 1.0 else 0 end) * 100 >= 60 and avg(case when dist_sma50_pct > 0 then 1.0 else 0 end) * 100 >= 50 and coalesce(median(rel20), 0) >= 5 then 'leader'
      when avg(case when dist_sma20_pct > 0 then 1.0 else 0 end) * 100 <= 40 and avg(case when dist_sma50_pct > 0 then 1.0 else 0 end) * 100 <= 35 and coalesce(median(rel20), 0) <= -3 then 'laggard'
      else 'mixed' end sector_regime from v_members group by 1
    """,
)
view(
    "v_arch",
    """
    with f as (select ticker, eps / nullif(bvps, 0) * 100 roe, price / nullif(bvps, 0) * 1000 pb, price / nullif(eps, 0) * 1000 pe from (
        select ticker, n_nationkey, arg_max(close, date) / 1e6 price from v_bars join v_inst using (ticker) group by 1, 2) p
        left join (select c_nationkey k, avg(c_acctbal) eps from customer group by 1) c on c.k = n_nationkey left join (select s_nationkey k2, avg(s_acctbal) bvps from supplier group by 1) s on s.k2 = n_nationkey),
    m as (select m.*, f.roe roe_, f.pb pb_, f.pe pe_, sector_regime from v_members m left join f using (ticker) left join v_sreg using (sector))
    select *, case when sector = 'ASIA' and (coalesce(roe_, 0) <= 8 or coalesce(pb_, 0) <= 1) and (vol20_pct >= 3 or coalesce(atr14 / last * 100, 0) >= 4) then 'special_situation'
      when sector = 'EUROPE' and coalesce(roe_, 0) >= 18 and coalesce(pb_, 0) >= 1.5 then 'quality_financial_trend' when sector = 'AMERICA' and coalesce(beta, 0) >= 0.8 then 'cyclical_beta'
      when coalesce(roe_, 0) >= 18 and coalesce(pe_, 0) > 0 and coalesce(pe_, 0) <= 18 and coalesce(vol20_pct, 0) <= 3 then 'quality_trend'
      when coalesce(rel20, 0) >= 10 and coalesce(atr14 / last * 100, 0) >= 3 then 'momentum_high_beta' else 'balanced_swing' end archetype from m
    """,
)
view(
    "v_conv0",
    "select a.*, best_edge, edge10, l.cycle_peak, l.cycle_drawdown, case archetype "
    + " ".join(f"when '{a[0]}' then {a[4]}" for a in D.ARCHETYPES)
    + " end bmin, case archetype "
    + " ".join(f"when '{a[0]}' then {a[5]}" for a in D.ARCHETYPES)
    + " end bmax, sector_regime = 'leader' and rel20 >= 5 and best_edge > 0 up from v_arch a left join v_tbest t using (ticker) left join v_lbase l using (ticker)",
)
view(
    "v_conv1",
    """
    select *, least(greatest(1 + case sector_regime when 'leader' then 0.25 when 'laggard' then -0.2 else 0 end + case when best_edge > 1 then 0.15 when best_edge < 0 then -0.15 else 0 end
        + case when edge10 < 0 then -0.2 else 0 end + case when rel20 >= 8 then 0.1 when rel20 <= -5 then -0.1 else 0 end + case when rsi14 >= 75 then -0.1 else 0 end
        + case when cycle_peak >= 8 and cycle_drawdown >= -6 then 0.1 when cycle_peak <= 4 or cycle_drawdown <= -10 then -0.1 else 0 end, 0.35), 1.8) conviction,
      least(greatest(bmin + case when up then 2 when sector_regime = 'laggard' then -2 else 0 end + case when best_edge < 0 then -1 else 0 end + case when edge10 < 0 then -1 else 0 end + case when rsi14 >= 75 then -1 else 0 end, 4), 28) target_min,
      bmax + case when up then 2 when sector_regime = 'laggard' then -2 else 0 end + case when best_edge > 1 then 1 when best_edge < 0 then -1 else 0 end + case when edge10 < 0 then -2 else 0 end + case when rsi14 >= 75 then -1 else 0 end hi
    from v_conv0
    """,
)
view("v_conv", "select *, least(greatest(hi, target_min + 4), 40) target_max from v_conv1")


def research_rows(spark, d):
    """Members with archetype, sector regime, timing, cycle outlook and conviction; and the ladder."""
    bars, people, ohlc, timing = shared_inputs(spark, d)
    base, ladder, prices = ladder_parts(spark, d, people, ohlc, timing)
    return researched(spark, d, bars, people, base, prices), ladder


def researched(spark, d, bars, people, base, prices):
    eps = I.table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.avg("c_acctbal").alias("eps"))
    book = I.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.avg("s_acctbal").alias("bvps"))
    facts = I.instruments(spark, d).join(eps, "n_nationkey", "left").join(book, "n_nationkey", "left").select("ticker", "eps", "bvps")
    rows = people.join(facts, "ticker", "left").withColumns(
        {
            "roe": F.col("eps") / F.nullif("bvps", F.lit(0.0)) * 100,
            "pb": F.col("ref") / F.nullif("bvps", F.lit(0.0)) * 1000,
            "pe": F.col("ref") / F.nullif("eps", F.lit(0.0)) * 1000,
        }
    )
    met = lambda c: F.avg(F.when(F.col(c) > 0, 1.0).otherwise(0.0)) * 100
    sectors = people.groupBy("sector").agg(
        F.count(F.lit(1)).alias("m"), met("dist_sma20_pct").alias("b20"), met("dist_sma50_pct").alias("b50"), F.median("rel20").alias("r20")
    )
    sectors = sectors.select("sector", D.sector_regime(F.col("m"), F.col("b20"), F.col("b50"), F.col("r20")).alias("sector_regime"))
    best = prices.filter("net_edge is not null").groupBy("ticker").agg(
        F.max("net_edge").alias("best_edge"), F.max(F.when(F.col("horizon") == 10, F.col("net_edge"))).alias("edge10")
    )
    rows = rows.join(sectors, "sector", "left").withColumn("archetype", D.archetype("asia", "europe", "america"))
    rows = M.enrich(rows, best, base.select("ticker", "cycle_peak", "cycle_drawdown", "low_t1", "close_t1"), ID.burst_patterns(bars))
    rows = rows.join(F.broadcast(D.archetype_table(spark)), "archetype").withColumns(
        {
            "latest_signal": F.lit(False),
            "target_price": F.lit(None).cast("double"),
            "bias": F.when(F.col("third_negative_pct") >= 50, "distribution").otherwise("absorption"),
            "squeeze_failure": F.coalesce(F.col("next_positive_pct") < 40, F.lit(False)),
            "burst_bias": F.lit("neutral"),
            "trim": F.lit("moderate"),
        }
    )
    return D.conviction(rows)


@query("sector_regime_labels", "select * from v_sreg")
def sector_regime_labels(spark, d):
    people = PM.members(spark, d)
    met = lambda c: F.avg(F.when(F.col(c) > 0, 1.0).otherwise(0.0)) * 100
    s = people.groupBy("sector").agg(
        F.count(F.lit(1)).alias("m"), met("dist_sma20_pct").alias("b20"), met("dist_sma50_pct").alias("b50"), F.median("rel20").alias("r20")
    )
    return s.select("sector", D.sector_regime(F.col("m"), F.col("b20"), F.col("b50"), F.col("r20")).alias("sector_regime"))


@query(
    "market_regime_targets",
    """
    with nh as (
      select date, avg(cast(close >= h20 as int)) * 100 new_high from (
        select date, close, case when count(*) over f = 20 then max(close) over f end h20 from v_bars
        window f as (partition by ticker order by date rows between 19 preceding and current row)) group by date
    ),
    a as (
      select date, row_number() over (order by date) n,
        list_reduce(list(cast(tr as double)) over (order by date rows between 500 preceding and current row), lambda p, q: p * 13 / 14 + q / 14) / close * 100 ap
      from (select date, close, greatest(high - low, abs(high - lag(close) over (order by date)), abs(low - lag(close) over (order by date))) tr from v_index)
    ),
    k as (select x.date, case when x.n >= 20 then avg(cast(y.ap <= x.ap as int)) * 100 end rk from a x join a y on y.date <= x.date group by x.date, x.n),
    b as (select date, breadth20, breadth50, positive5, coalesce(new_high, 0) nh, coalesce(rk, 0) rk from v_market left join nh using (date) left join k using (date)),
    r as (select *, case when breadth20 >= 65 and breadth50 >= 55 and positive5 >= 55 and nh >= 15 then 'risk_on'
      when breadth20 <= 35 and breadth50 <= 30 and positive5 <= 40 then 'risk_off' else 'balanced' end regime from b)
    select date, regime, case regime when 'risk_on' then case when rk >= 80 then 65.0 else 70.0 end when 'risk_off' then case when breadth20 <= 25 then 30.0 else 35.0 end
        else case when rk >= 80 then 50.0 else 55.0 end end target_pct,
      case regime when 'risk_on' then 0.35 when 'risk_off' then 0.10 else 0.25 end strength_share from r
    """,
)
def market_regime_targets(spark, d):
    """Regime and invested target of every date in history, from that date's breadth, new highs and volatility rank."""
    from barloom.operators import panel as P
    from barloom.plans.panel import parts

    bars = I.bars_table(spark, d)
    m = P.market_panel(*parts(spark, d)).join(M.regime_history(bars, B.index_bars(bars)), "date", "left")
    regime = D.market_regime(F.col("breadth20"), F.col("breadth50"), F.col("positive5"), F.col("new_high20_pct"))
    rows = m.select("date", "breadth20", "atr_pct_rank", regime.alias("regime"))
    target, share = D.invested_target(F.col("regime"), F.col("atr_pct_rank"), F.col("breadth20"))
    return rows.select("date", "regime", target.alias("target_pct"), share.alias("strength_share"))


_SCORE_SQL = """
    case archetype when 'momentum_high_beta' then (case when signal_age <= 1 then -2 else 0 end) + (case when signal_age between 2 and 4 then -1 else 0 end)
        + (case when third_negative_pct >= 50 then -2 else 0 end) + (case when edge10 < 0 then -2 else 0 end) + (case when drawdown3_pct <= -2 then -1 else 0 end)
      when 'cyclical_beta' then (case when best_edge >= 3 then 3 when best_edge > 0 then 1 else 0 end) + (case when edge10 >= 0 then 1 else 0 end) + (case when signal_age >= 10 then 1 else 0 end)
        + (case when next_positive_pct >= 70 then 1 else 0 end) + (case when drawdown3_pct > -1 then 1 else 0 end)
      when 'quality_trend' then (case when best_edge > 0 then 1 else 0 end) + (case when edge10 > 0 then 2 else 0 end) + (case when signal_age >= 10 then 1 else 0 end)
        + (case when next_positive_pct >= 75 then 1 else 0 end) + (case when drawdown3_pct > -1 then 1 else 0 end)
      when 'special_situation' then (case when best_edge >= 2 then 2 else 0 end) + (case when edge10 < 0 then -3 else 0 end) + (case when signal_age <= 10 then -1 else 0 end)
        + (case when third_negative_pct >= 35 then -1 else 0 end) + (case when drawdown3_pct <= -2 then -1 else 0 end)
      else coalesce(least(greatest(best_edge * 0.3, -2), 2), 0) + coalesce(least(greatest(edge10 * 0.2, -2), 2), 0) end
"""


@query(
    "conviction_and_bands",
    f"""select c.ticker, archetype, sector_regime, round(conviction, 6) conviction, target_min, target_max,
      cast(round_even(least(greatest({_SCORE_SQL}, -6), 6), 0) as int) archetype_score from v_conv c left join v_burst using (ticker)""",
)
def conviction_and_bands(spark, d):
    rows, _ = research_rows(spark, d)
    return rows.select(
        "ticker", "archetype", "sector_regime", F.round("conviction", 6).alias("conviction"), "target_min", "target_max",
        D.archetype_score().alias("archetype_score"),
    )


view(
    "v_guide",
    """
    with b as (select *, case when third_negative_pct >= 50 then 'distribution' else 'absorption' end bias, coalesce(next_positive_pct < 40, false) failed from v_burst)
    select ticker, signal_age, case when signal_age is null then 'neutral' when signal_age <= 1 and failed then 'failed_day2_followthrough' when signal_age <= 1 then 'respect_day2_followthrough'
        when bias = 'distribution' then 'respect_t25_supply' else 'keep_core_trim_selectively' end guide_bias,
      case when signal_age is null then 'moderate' when signal_age <= 1 and failed or signal_age > 1 and bias = 'distribution' then 'high' when signal_age <= 1 and bias = 'absorption' then 'light' else 'moderate' end guide_trim,
      case when signal_age is null or signal_age <= 1 and not failed and bias = 'absorption' then 'none' when signal_age <= 1 and failed or signal_age > 1 and bias = 'distribution' then 'frontload_sell' else 'staggered_trim' end urgent_trim,
      case when signal_age is null or signal_age <= 1 and not failed and bias = 'absorption' then 0.0 when signal_age <= 1 and failed then 35.0 when signal_age > 1 and bias = 'distribution' then 30.0 else 15.0 end must_sell_pct
    from (select * replace (case when bias = 'distribution' and signal_age <= 1 and not failed then 'absorption' else bias end as bias) from b)
    """,
)


@query("burst_guidance", "select ticker, signal_age, guide_bias, guide_trim, urgent_trim, must_sell_pct from v_guide")
def burst_guidance(spark, d):
    rows = ID.burst_patterns(I.bars(spark, d)).withColumns(
        {"squeeze_failure": F.coalesce(F.col("next_positive_pct") < 40, F.lit(False)), "burst_bias": F.lit("neutral"), "trim": F.lit("moderate")}
    )
    spread = F.col("third_negative_pct") >= 50
    fresh = (F.col("signal_age") <= 1) & ~F.col("squeeze_failure")
    rows = rows.withColumn("bias", F.when(spread & ~fresh, "distribution").otherwise("absorption"))
    return D.burst_guidance(rows).select("ticker", "signal_age", "guide_bias", "guide_trim", "urgent_trim", "must_sell_pct")


view(
    "v_claims",
    """
    select ticker book, l_suppkey item, cast(sum(size) as double) score, cast(sum(case when flag = 'R' then size * 3 else size end) as double) cap, cast(count(*) * 2 as double) floor_
    from v_trades group by 1, 2
    """,
)
view("v_budgets", "select book, sum(cap) * 0.6 budget from v_claims group by 1")
view(
    "v_level",
    """
    with o as (select book, item, score, cap, cap / score r, sum(cap) over w cc, sum(score) over (partition by book) - sum(score) over w left_, budget
      from v_claims join v_budgets using (book) window w as (partition by book order by cap / score range between unbounded preceding and current row)),
    k as (select *, cc + r * left_ <= budget is_full from o)
    select book, (max(budget) - coalesce(max(case when is_full then cc end), 0)) / nullif(coalesce(min(case when is_full then left_ end), max(tot)), 0) lvl, count(case when not is_full then 1 end) n_open
    from (select *, sum(score) over (partition by book) tot from k) group by book
    """,
)


def claims(spark, d):
    t = I.trades(spark, d)
    capped = F.when(F.col("flag") == "R", F.col("size") * 3).otherwise(F.col("size"))
    rows = t.groupBy(F.col("ticker").alias("book"), F.col("l_suppkey").alias("item")).agg(
        F.sum("size").cast("double").alias("score"), F.sum(capped).cast("double").alias("cap"),
        (F.count(F.lit(1)) * 2).cast("double").alias("floor"),
    )
    return cut_lineage(rows)


@query(
    "capped_allocation",
    "select book, item, score, cap, round(case when n_open > 0 then least(cap, lvl * score) else cap end, 6) allocated from v_claims join v_level using (book)",
)
def capped_allocation(spark, d):
    """Every nation's budget shared over its suppliers by traded size under caps."""
    rows = claims(spark, d)
    budgets = rows.groupBy("book").agg((F.sum("cap") * 0.6).alias("budget"))
    out = D.allocate_with_caps(rows, budgets)
    return out.select("book", "item", "score", "cap", F.round("allocated", 6).alias("allocated"))


def _level_sql(src: str, by: str, budget: str) -> str:
    """Water level of every ``by`` over claims (score, cap): null where all caps fit."""
    return f"""
    select {by}, case when n_open > 0 then (budget - done) / nullif(coalesce(left_, tot), 0) end lvl from (
      select {by}, max(budget) budget, coalesce(max(case when is_full then cc end), 0) done, min(case when is_full then left_ end) left_, max(tot) tot, count(case when not is_full then 1 end) n_open
      from (select *, cc + r * left_ <= budget is_full from (
        select {by}, cap / score r, sum(cap) over w cc, sum(score) over (partition by {by}) - sum(score) over w left_, sum(score) over (partition by {by}) tot, budget
        from {src} join {budget} using ({by}) where score > 0 and cap > 0
        window w as (partition by {by} order by cap / score range between unbounded preceding and current row))) group by 1)
    """


view("v_floors", "select c.*, least(floor_, cap) * least(1, budget / nullif(sum(least(floor_, cap)) over (partition by book), 0)) part, greatest(budget - sum(least(floor_, cap)) over (partition by book), 0) rest from v_claims c join v_budgets using (book)")
view("v_frest", "select book, item, score, cap - part cap, part, cap whole from v_floors")
view("v_fbudget", "select book, max(rest) budget from v_floors group by 1")
view("v_flevel", _level_sql("v_frest", "book", "v_fbudget"))


@query(
    "floors_then_allocation",
    """select book, item, whole cap, part floor_part, round(part + case when score > 0 and cap > 0 then greatest(least(cap, coalesce(lvl * score, cap)), 0) else 0 end, 6) allocated
    from v_frest left join v_flevel using (book)""",
)
def floors_then_allocation(spark, d):
    """Mandatory floors first, then the rest by score under what is left of the caps."""
    rows = claims(spark, d)
    budgets = rows.groupBy("book").agg((F.sum("cap") * 0.6).alias("budget"))
    out = D.floors_first(rows, budgets)
    return out.select("book", "item", "cap", "floor_part", F.round("allocated", 6).alias("allocated"))


view("v_nclaims", "select sector, book, item, score, cap from v_claims join v_inst on ticker = book")
view("v_ngroups", "select book, sum(cap) * case when book < 'K' then 0.3 else 0.8 end budget from v_nclaims group by book")
view("v_nlevel", _level_sql("v_nclaims", "book", "v_ngroups"))
view("v_ninner", "select sector, book, item, score, cap whole, case when score > 0 and cap > 0 then greatest(least(cap, coalesce(lvl * score, cap)), 0) else 0 end cap from v_nclaims left join v_nlevel using (book)")
view("v_nbudgets", "select sector, sum(whole) * 0.4 budget from v_ninner group by 1")
view("v_nouter", _level_sql("v_ninner", "sector", "v_nbudgets"))


@query(
    "nested_caps_allocation",
    """select sector, book, item, score, whole cap, round(case when score > 0 and cap > 0 then greatest(least(cap, coalesce(lvl * score, cap)), 0) else 0 end, 6) allocated
    from v_ninner left join v_nouter using (sector)""",
)
def nested_caps_allocation(spark, d):
    """Every sector's budget over its suppliers by traded size, under caps of suppliers and of nations."""
    rows = claims(spark, d).join(I.instruments(spark, d).select(F.col("ticker").alias("book"), "sector"), "book")
    rows = cut_lineage(rows.select("sector", "book", "item", "score", "cap"))
    caps = rows.groupBy("book").agg((F.sum("cap") * F.when(F.col("book") < "K", 0.3).otherwise(0.8)).alias("group_cap"))
    budgets = rows.groupBy("sector").agg((F.sum("cap") * 0.4).alias("budget"))
    out = D.nested_caps(rows, caps, budgets, "book", "sector")
    return out.select("sector", "book", "item", "score", "cap", F.round("allocated", 6).alias("allocated"))


# Session plan --------------------------------------------------------------------------
view("v_above", f"with {_up} {_up_sel}")
view(
    "v_sctx",
    f"""
    select c.ticker, c.last, {clamp_sql(snap_sql('(c.last + c.tick)'), 'b.floor_', 'b.ceil_')} ask1, above1, signal_age, guide_bias, guide_trim, conviction, edge10, best_edge, archetype, target_min, target_max, bias tape_bias,
      archetype in ({', '.join(f"'{a[0]}'" for a in D.ARCHETYPES if a[2])}) and sector_regime <> 'laggard' weakness,
      archetype in ({', '.join(f"'{a[0]}'" for a in D.ARCHETYPES if a[1])}) and coalesce(best_edge > 0, false) strength,
      greatest(quantity, 0) * c.last / sum(greatest(quantity, 0) * c.last) over () * 100 weight
    from v_conv c join v_lbase b using (ticker) join v_above using (ticker) join v_guide using (ticker) join v_pos using (ticker)
      join (select ticker, case when third_negative_pct >= 50 and not (signal_age <= 1 and not coalesce(next_positive_pct < 40, false)) then 'distribution' else 'absorption' end bias from v_burst) using (ticker)
    """,
)
view(
    "v_blue0",
    """
    with c as (select ticker, limit_price, anchor_class, entry_rank, price_rank, greatest(coalesce(entry_score, 0), 0) sc, greatest(coalesce(fill, 0), 0) fl,
        max(anchor_class in ('historical', 'mixed')) over (partition by ticker) any_old from v_ladder),
    k as (select *, row_number() over (partition by ticker order by entry_rank, price_rank) <= 3 core from c where not any_old or anchor_class in ('historical', 'mixed')),
    h as (select *, max(case when core then limit_price end) over (partition by ticker) core_high, max(case when core then fl end) over (partition by ticker) core_fill, max(case when core then sc end) over (partition by ticker) core_score from k),
    b as (select * from h where limit_price > core_high qualify row_number() over (partition by ticker order by limit_price, entry_rank) = 1),
    g as (select x.*, h.core_high, h.core_fill, h.core_score, b.limit_price b_price, b.entry_rank b_rank, b.sc b_sc, b.fl b_fl,
        least(case when ask1 > greatest(h.core_high, 0) then ask1 end, case when above1 > greatest(h.core_high, 0) then above1 end) reserve,
        coalesce((weakness or strength) and h.core_high > 0 and last > h.core_high * 1.02, false) gate
      from (select distinct ticker, core_high, core_fill, core_score from h) h join v_sctx x using (ticker) left join b using (ticker)),
    r as (select *, case when guide_bias in ('respect_day2_followthrough', 'keep_core_trim_selectively') then case when strength then 9.0 else 7.0 end
        when guide_bias = 'normal_tactical_management' then case when strength then 7.0 else 5.5 end
        when guide_bias in ('failed_followthrough', 'failed_day2_followthrough') and weakness then 4.0 else 0.0 end r0 from g)
    select *, case when gate and reserve <= last * 1.02 then least(case when guide_trim = 'high' then greatest(r0 - 0.5, 0) else r0 end, 10) else 0 end reserve_pct,
      case when gate and b_price is not null then least(7.5 + case when signal_age <= 1 then 1.5 else 0 end + case when b_fl - core_fill >= 15 then 1 else 0 end + case when (last / core_high - 1) * 100 >= 4 then 1 else 0 end
        + case when guide_trim = 'high' and guide_bias in ('failed_followthrough', 'failed_day2_followthrough') then 0.5 else 0 end, 10) else 0 end bridge_pct
    from r
    """,
)
view(
    "v_bluecore",
    """
    with c as (select *, max(anchor_class in ('historical', 'mixed')) over (partition by ticker) any_old from v_ladder),
    k as (select *, row_number() over (partition by ticker order by entry_rank, price_rank) rn from c where not any_old or anchor_class in ('historical', 'mixed')),
    r as (select ticker, limit_price, entry_rank, greatest(coalesce(entry_score, 0), 0) sc, least(greatest(coalesce(fill, 0), 0), 100) fl,
        row_number() over (partition by ticker order by limit_price desc) pos, count(*) over (partition by ticker) n from k where rn <= 3),
    w as (select r.*, x.* exclude (ticker), sc * (1 + 0.015 * fl) / sqrt(greatest(entry_rank, 1)) raw, greatest(100 - reserve_pct - bridge_pct, 0) left_ from r join v_blue0 x using (ticker)),
    s as (select *, round_even(case when sum(raw) over (partition by ticker) > 0 then left_ * raw / nullif(sum(raw) over (partition by ticker), 0) else left_ / n end, 2) sh from w)
    select *, round_even(100 - round_even(reserve_pct, 2) - round_even(bridge_pct, 2) - sum(sh) over (partition by ticker), 2) drift from s
    """,
)
view(
    "v_blue",
    """
    select ticker, 'continuation_reserve' role_, reserve limit_price, 0 entry_rank, round_even(reserve_pct, 2) share_pct,
      greatest(core_score * 0.72, 0.01) * case when strength then 1.08 else 1 end * case when guide_bias in ('failed_followthrough', 'failed_day2_followthrough') then 0.86 else 1 end base_score, 0.0 floor_pct
    from v_blue0 where reserve_pct > 0
    union all
    select ticker, 'bridge', b_price, b_rank, round_even(bridge_pct, 2),
      b_sc * (1 + 0.01 * least(b_fl, 100)) * case when strength then 0.92 else 0.82 end * case when guide_trim = 'high' then 0.92 else 1 end, 0.0 from v_blue0 where bridge_pct > 0
    union all
    select ticker, case pos when 1 then 'shallow_core' when 2 then 'mid_core' else 'deep_core' end, limit_price, entry_rank,
      round_even(sh + case when pos = n and abs(drift) >= 0.01 then drift else 0 end, 2),
      sc * (1 + 0.015 * fl) * case pos when 1 then case when strength then 1.02 else 0.95 end * case when guide_trim = 'high' and guide_bias in ('failed_followthrough', 'failed_day2_followthrough') then 0.92 else 1 end
        when 2 then 1 else 1.08 * case when weakness then 1.12 else 1 end end,
      case when weakness and pos >= 3 then round_even(least(greatest(sh * 0.35, 12), sh), 2) else 0 end
    from v_bluecore
    """,
)


def session_inputs(spark, d):
    """(ladder, a row per instrument with all that the session plan looks at)."""
    rows, ladder = research_rows(spark, d)
    return ladder, session_context(spark, d, rows)


def session_context(spark, d, rows):
    rows = rows.withColumn("bias", F.when((F.col("third_negative_pct") >= 50) & ~F.coalesce((F.col("signal_age") <= 1) & ~F.col("squeeze_failure"), F.lit(False)), "distribution").otherwise("absorption"))
    held = I.positions(spark, d).select("ticker", F.greatest("quantity", F.lit(0)).alias("quantity"))
    rows = cut_lineage(D.burst_guidance(rows).join(held, "ticker"))
    total = rows.agg(F.sum(F.col("quantity") * F.col("last")).alias("t"))
    rows = rows.join(F.broadcast(total)).select(
        "ticker", "last", "ask1", "above1", "signal_age", "guide_bias", "guide_trim", "conviction", "edge10", "best_edge", "archetype",
        "target_min", "target_max", F.col("bias").alias("tape_bias"),
        (F.col("on_weakness") & (F.col("sector_regime") != "laggard")).alias("weakness"),
        (F.col("on_strength") & F.coalesce(F.col("best_edge") > 0, F.lit(False))).alias("strength"),
        (F.col("quantity") * F.col("last") / F.nullif("t", F.lit(0.0)) * 100).alias("weight"),
    )
    return cut_lineage(rows)


@query("session_tranches", "select ticker, role_ \"role\", limit_price, entry_rank, share_pct, round(base_score, 5) base_score, floor_pct from v_blue")
def session_tranches(spark, d):
    """Buy tranches in five roles: continuation reserve, bridge, and the core in three."""
    out = D.session_blueprint(*session_inputs(spark, d))
    return out.withColumns({"base_score": F.round("base_score", 5)})


view(
    "v_scap",
    """
    with g as (select *, greatest(target_min - weight, 0) to_min, greatest(target_max - weight, 0) to_max, archetype = 'special_situation' special,
        guide_trim = 'high' or guide_bias in ('failed_followthrough', 'failed_day2_followthrough') failing from v_sctx),
    r as (select *, greatest(to_max - to_min, 0) room from g),
    c as (select *, least(case when weakness then to_min else 0 end + case when strength and room > 0 then least(room, greatest(to_max * 0.25, 2)) * case when best_edge > 1 then 1.1 else 1 end else 0 end, to_max) c0,
      case when to_max > 0 then greatest(least(to_max * case when special or failing then 0.4 else 0.5 end, case when failing then 22.5 when special then 25.0 else 30.0 end, to_max), 0) else 0 end single_cap from r)
    select *, greatest(case when weakness and c0 < least(to_max, 2) then least(to_max, greatest(c0, 2)) else c0 end, 0) session_cap from c
    """,
)
view(
    "v_sclaims",
    """
    select ticker, role_, limit_price, round_even(session_cap * share_pct / 100, 4) cap, case when floor_pct > 0 then least(session_cap * share_pct / 100, session_cap * floor_pct / 100) else 0 end floor_, single_cap,
      greatest(greatest(case when role_ in ('shallow_core', 'mid_core', 'deep_core') then round_even(base_score, 6) else round_even(base_score, 6) end, 0) * greatest(conviction, 0.1)
        * case when role_ in ('bridge', 'continuation_reserve') and not strength then 0.88 else 1 end
        * case when role_ in ('bridge', 'continuation_reserve') and guide_bias in ('failed_followthrough', 'failed_day2_followthrough') then 0.86 else 1 end
        * case when tape_bias = 'distribution' and role_ in ('bridge', 'continuation_reserve', 'shallow_core') then 0.9 else 1 end
        * case when tape_bias = 'absorption' and role_ in ('bridge', 'continuation_reserve') then 1.05 else 1 end
        * case when weakness and role_ = 'deep_core' then 1.12 else 1 end
        * case when role_ in ('bridge', 'continuation_reserve') and coalesce(edge10, 0) < 0 then 0.9 else 1 end, 0.01) score
    from v_blue join v_scap using (ticker) where session_cap * share_pct / 100 > 0
    """,
)
view("v_sfloor", "select 1 book, *, least(floor_, cap) * least(1, 20.0 / nullif(sum(least(floor_, cap)) over (), 0)) part, greatest(20.0 - sum(least(floor_, cap)) over (), 0) rest from v_sclaims")
view("v_srest", "select book, ticker, role_, limit_price, score, cap - part cap, cap whole, part, single_cap, rest from v_sfloor")
view("v_sgroup", "select ticker, greatest(max(single_cap) - sum(part), 0) budget from v_srest group by 1")
view("v_slevel", _level_sql("v_srest", "ticker", "v_sgroup"))
view("v_sinner", "select * replace (case when cap > 0 then greatest(least(cap, coalesce(lvl * score, cap)), 0) else 0 end as cap) from v_srest left join v_slevel using (ticker)")
view("v_sbudget", "select book, max(rest) budget from v_sinner group by 1")
view("v_souter", _level_sql("v_sinner", "book", "v_sbudget").replace("lvl from", "lvl2 from"))


@query(
    "session_allocation",
    """
    select ticker, role_ "role", limit_price, round(score, 4) score, whole cap, round(part, 4) floor_part, round(part + case when cap > 0 then greatest(least(cap, coalesce(lvl2 * score, cap)), 0) else 0 end, 4) allocated
    from v_sinner left join v_souter using (book)
    """,
)
def session_allocation(spark, d, budget: float = 20.0):
    """A session's budget (percent of the portfolio) over all tranches, under session and single-name caps, floors first."""
    out = allocated(spark, *session_inputs(spark, d), budget)
    return out.select(
        "ticker", "role", "limit_price", F.round("score", 4).alias("score"), "cap", F.round("floor_part", 4).alias("floor_part"), F.round("allocated", 4).alias("allocated")
    )


def allocated(spark, ladder, context, budget: float = 20.0):
    """The session's tranches with what the budget gives each."""
    to_min, to_max = (F.greatest(F.col(c) - F.col("weight"), F.lit(0.0)) for c in ("target_min", "target_max"))
    context = cut_lineage(
        context.withColumns(
            {
                "session_cap": D.session_cap(to_min, to_max, F.col("weakness"), F.col("strength"), F.col("best_edge"), F.lit(0.25), F.col("weakness")),
                "single_cap": D.single_name_cap(to_max, F.col("archetype"), F.col("guide_trim"), F.col("guide_bias")),
            }
        )
    )
    tranches = D.session_blueprint(ladder, context)
    claims = cut_lineage(D.tranche_scores(tranches, context).withColumn("book", F.lit(1)))
    budgets = spark.createDataFrame([(1, float(budget))], "book int, budget double")
    return D.floors_under_caps(claims, budgets, "ticker", "single_cap")


view(
    "v_splan",
    """
    select distinct ticker from v_sinner left join v_souter using (book)
    where part + case when cap > 0 then greatest(least(cap, coalesce(lvl2 * score, cap)), 0) else 0 end > 0
    """,
)


@query(
    "verdicts",
    """
    with r as (select m.ticker, m.last, m.dist_sma20_pct dist, m.rsi14, l.forecast_ret, t.best_edge, t.edge10, e.limit_price zh, greatest(e.limit_price - 2 * m.tick, 0) zl, m.ticker in (select ticker from v_splan) has_plan
      from v_members m left join v_lbase l using (ticker) left join v_tbest t using (ticker) left join v_entry e using (ticker))
    select ticker, case when has_plan and coalesce(last >= round_even(zl, 2) and last <= round_even(zh, 2), false) and best_edge > 0 and forecast_ret >= -0.5 then 'BUY_NOW'
      when has_plan then 'RESTING_BUY_ONLY' when coalesce(dist >= 15 or rsi14 >= 74, false) or best_edge < 0 and edge10 < 0 or coalesce(dist >= 10 or rsi14 >= 68, false) and forecast_ret < 0 then 'NO_BUY_NOW'
      when last > round_even(zh, 2) then 'WAIT_FOR_PULLBACK' else 'WATCH' end verdict from r
    """,
)
def verdicts(spark, d):
    bars, people, ohlc, timing = shared_inputs(spark, d)
    return verdicts_of(spark, d, bars, people, *ladder_parts(spark, d, people, ohlc, timing))


def verdicts_of(spark, d, bars, people, base, ladder, prices):
    """Verdicts; an instrument has a plan if the session's budget gives one of its tranches something."""
    context = session_context(spark, d, researched(spark, d, bars, people, base, prices))
    plans = allocated(spark, ladder, context).filter("allocated > 0").select("ticker", F.lit(True).alias("planned")).distinct()
    best = prices.filter("net_edge is not null").groupBy("ticker").agg(
        F.max("net_edge").alias("best_edge"), F.max(F.when(F.col("horizon") == 10, F.col("net_edge"))).alias("edge10")
    )
    rows = M.enrich(people, base.select("ticker", "forecast_ret"), best, D.best_entry(ladder).select("ticker", "limit_price"), plans)
    rows = rows.withColumns(
        {
            "zone_low": F.greatest(F.col("limit_price") - 2 * F.col("tick"), F.lit(0.0)),
            "zone_high": F.col("limit_price"),
            "has_plan": F.coalesce("planned", F.lit(False)),
        }
    )
    return D.verdict(rows).select("ticker", "verdict")


@query(
    "archetype_parameters",
    """
    select archetype, count(*) members, """
    + " ".join(["case archetype"] + [f"when '{a[0]}' then {str(a[1]).lower()}" for a in D.ARCHETYPES] + ["end on_strength,"])
    + " ".join(["case archetype"] + [f"when '{a[0]}' then {str(a[2]).lower()}" for a in D.ARCHETYPES] + ["end on_weakness,"])
    + " ".join(["case archetype"] + [f"when '{a[0]}' then '{a[3]}'" for a in D.ARCHETYPES] + ["end hold_window"])
    + " from v_arch group by 1",
)
def archetype_parameters(spark, d):
    rows, _ = research_rows(spark, d)
    return rows.groupBy("archetype", "on_strength", "on_weakness", "hold_window").agg(F.count(F.lit(1)).alias("members"))


@query(
    "instrument_state",
    """
    with t as (select ticker, string_agg(role_ || '@' || cast(limit_price as varchar), ',' order by limit_price desc) tranches, min(limit_price) zone_low, max(limit_price) zone_high from v_tranches group by 1),
    g as (select c.ticker, archetype, conviction, target_min, target_max, last, quantity, c.sector_regime from v_conv c left join (select ticker, quantity from v_pos) using (ticker)),
    b as (select *, quantity * last / sum(quantity * last) over () * 100 weight_pct from g)
    select ticker, archetype, sector_regime, round(conviction, 6) conviction, round(weight_pct, 6) weight_pct, round(greatest(target_min - weight_pct, 0), 6) gap_min, round(greatest(target_max - weight_pct, 0), 6) gap_max,
      zone_low, zone_high, tranches from b left join t using (ticker)
    """,
)
def instrument_state(spark, d):
    """One wide row per instrument: archetype, conviction, weights and gaps, buy zone and tranches."""
    rows, ladder = research_rows(spark, d)
    rows = cut_lineage(rows)
    packed = F.array_sort(F.collect_list(F.struct((-F.col("limit_price")).alias("o"), "role", "limit_price")))
    plan = D.core_tranches(ladder).groupBy("ticker").agg(
        F.array_join(F.transform(packed, lambda x: F.concat(x["role"], F.lit("@"), x["limit_price"].cast("string"))), ",").alias("tranches"),
        F.min("limit_price").alias("zone_low"),
        F.max("limit_price").alias("zone_high"),
    )
    held = rows.join(I.positions(spark, d).select("ticker", "quantity"), "ticker", "left").withColumn("_v", F.col("quantity") * F.col("last"))
    held = cut_lineage(held)
    held = held.withColumn("weight_pct", F.col("_v") / held.agg(F.sum("_v")).scalar() * 100)
    out = held.join(plan, "ticker", "left").withColumns(
        {
            "gap_min": F.greatest(F.col("target_min") - F.col("weight_pct"), F.lit(0.0)),
            "gap_max": F.greatest(F.col("target_max") - F.col("weight_pct"), F.lit(0.0)),
        }
    )
    return rounded(
        out.select("ticker", "archetype", "sector_regime", "conviction", "weight_pct", "gap_min", "gap_max", "zone_low", "zone_high", "tranches"),
        "zone_low", "zone_high",
    )
