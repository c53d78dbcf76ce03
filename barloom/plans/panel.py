"""Historical panels, market-timing rules, pick rules and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import frames as R
from barloom.operators import panel as P
from barloom.plans import inputs as I
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage
from barloom.sources import bars as B

TOP_K = 3

view(
    "v_idxf",
    """
    select date, close i_close, close / nullif(lag(close) over w, 0) - 1 i_ret1, close / nullif(lag(close, 5) over w, 0) - 1 i_ret5,
      close / nullif(lag(close, 20) over w, 0) - 1 i_ret20, close / nullif(lag(close, 60) over w, 0) - 1 i_ret60,
      case when count(*) over f20 = 20 then avg(close) over f20 end i_sma20,
      case when count(*) over f50 = 50 then avg(close) over f50 end i_sma50,
      case when count(*) over f200 = 200 then avg(close) over f200 end i_sma200,
      case when count(*) over f20 = 20 then (close - min(close) over f20) / nullif(max(close) over f20 - min(close) over f20, 0) end i_range20,
      case when count(*) over f60 = 60 then (close - min(close) over f60) / nullif(max(close) over f60 - min(close) over f60, 0) end i_range60,
      lead(close, 5) over w / nullif(close, 0) - 1 i_fwd5, lead(close, 10) over w / nullif(close, 0) - 1 i_fwd10,
      min(close) over (order by date rows between 1 following and 10 following) / nullif(close, 0) - 1 i_dd10,
      case when close > lag(close) over w and lag(close) over w > lag(close, 2) over w then 1.0
        when close < lag(close) over w and lag(close) over w < lag(close, 2) over w then -1.0 else 0.0 end i_streak
    from v_index window w as (order by date), f20 as (order by date rows between 19 preceding and current row),
      f50 as (order by date rows between 49 preceding and current row),
      f60 as (order by date rows between 59 preceding and current row),
      f200 as (order by date rows between 199 preceding and current row)
    """,
)
view(
    "v_panel0",
    """
    select ticker, sector, date, close, volume, i_ret1, i_ret20, i_ret60, i_fwd5, i_fwd10,
      close / nullif(lag(close) over w, 0) - 1 ret1, close / nullif(lag(close, 5) over w, 0) - 1 ret5,
      close / nullif(lag(close, 20) over w, 0) - 1 ret20, close / nullif(lag(close, 60) over w, 0) - 1 ret60,
      case when count(*) over f20 = 20 then close / nullif(avg(close) over f20, 0) - 1 end dist20,
      case when count(*) over f50 = 50 then close / nullif(avg(close) over f50, 0) - 1 end dist50,
      case when count(*) over f100 = 100 then close / nullif(avg(close) over f100, 0) - 1 end dist100,
      case when count(*) over f20 = 20 then volume / nullif(avg(volume) over f20, 0) end vol_ratio20,
      lead(close, 5) over w / nullif(close, 0) - 1 fwd5, lead(close, 10) over w / nullif(close, 0) - 1 fwd10,
      min(close) over (partition by ticker order by date rows between 1 following and 10 following) / nullif(close, 0) - 1 dd10
    from v_bars left join v_idxf using (date)
    window w as (partition by ticker order by date), f20 as (partition by ticker order by date rows between 19 preceding and current row),
      f50 as (partition by ticker order by date rows between 49 preceding and current row),
      f100 as (partition by ticker order by date rows between 99 preceding and current row)
    """,
)
view(
    "v_panel",
    """
    select *, ret20 - i_ret20 rel20, ret60 - i_ret60 rel60, fwd5 - i_fwd5 excess5, fwd10 - i_fwd10 excess10,
      case when count(case when ret1 is not null and i_ret1 is not null then 1 end) over f20 = 20 then corr(ret1, i_ret1) over f20 end corr20,
      case when count(case when ret1 is not null and i_ret1 is not null then 1 end) over f20 = 20
        then covar_samp(ret1, i_ret1) over f20 / nullif(var_samp(i_ret1) over f20, 0) end beta20
    from v_panel0 window f20 as (partition by ticker order by date rows between 19 preceding and current row)
    """,
)
view(
    "v_sector0",
    """
    select date, sector, avg(case when dist20 > 0 then 1.0 else 0.0 end) * 100 sector_breadth20, median(rel20) sector_rel20
    from v_panel group by date, sector
    """,
)
view(
    "v_sector",
    """
    select *, case when sector_rel20 is not null then (rank() over (partition by date order by sector_rel20 nulls last)
      + (count(sector_rel20) over (partition by date, sector_rel20) - 1) / 2.0) / count(sector_rel20) over (partition by date) * 100 end sector_rank
    from v_sector0
    """,
)
view(
    "v_feat",
    """
    select p.*, sector_breadth20, sector_rel20, sector_rank,
      case when rel20 is not null then (rank() over (partition by date order by rel20 nulls last)
        + (count(rel20) over (partition by date, rel20) - 1) / 2.0) / count(rel20) over (partition by date) * 100 end rel20_rank,
      case when rel60 is not null then (rank() over (partition by date order by rel60 nulls last)
        + (count(rel60) over (partition by date, rel60) - 1) / 2.0) / count(rel60) over (partition by date) * 100 end rel60_rank
    from v_panel p left join v_sector using (date, sector)
    """,
)
view(
    "v_market",
    """
    select i.*, breadth20, breadth50, positive5, dispersion20, median_rel20, mean_corr20, mean_beta20, has_outcome, leader_sectors, weak_sectors
    from v_idxf i join (
      select date, avg(case when dist20 > 0 then 1.0 else 0.0 end) * 100 breadth20, avg(case when dist50 > 0 then 1.0 else 0.0 end) * 100 breadth50,
        avg(case when ret5 > 0 then 1.0 else 0.0 end) * 100 positive5, stddev_samp(ret20) * 100 dispersion20, median(rel20) * 100 median_rel20,
        avg(corr20) mean_corr20, avg(beta20) mean_beta20, max(fwd10 is not null) has_outcome from v_panel group by date) using (date)
      join (select date, count(case when sector_breadth20 >= 50 then 1 end) leader_sectors, count(case when sector_breadth20 <= 30 then 1 end) weak_sectors
        from v_sector group by date) using (date)
    """,
)
view(
    "v_scores",
    """
    select *, case when i_close > i_sma50 and i_sma50 > i_sma200 then 'Bull' when i_close < i_sma50 and i_sma50 < i_sma200 then 'Bear' else 'Sideway' end regime,
      i_range60 is not null known from v_market
    """,
)
view(
    "v_points",
    """
    select *, (case regime when 'Bull' then 35 else 0 end) + (case when i_range60 <= 0.25 then case regime when 'Bear' then 5 else 15 end else 0 end)
        + (case when breadth20 >= 60 and breadth50 >= 50 then 20 else 0 end) + (case when positive5 >= 55 then 10 else 0 end) dp,
      (case regime when 'Bear' then 35 else 0 end) + (case when i_range60 >= 0.75 then 15 else 0 end)
        + (case when breadth20 <= 35 and breadth50 <= 35 then 20 else 0 end) + (case when positive5 <= 40 then 10 else 0 end) rp,
      (case regime when 'Sideway' then 25 else 0 end) + (case when i_range60 <= 0.25 then 5 when i_range60 >= 0.75 then 0 else 10 end)
        + (case when breadth20 >= 60 and breadth50 >= 50 or breadth20 <= 35 and breadth50 <= 35 then 0 else 10 end)
        + (case when positive5 >= 55 or positive5 <= 40 then 0 else 5 end) wp
    from v_scores
    """,
)
view(
    "v_signals",
    """
    select *, case when not known then 'WAIT' when dp >= rp and dp >= wp then 'DEPLOY' when rp >= wp then 'REDUCE' else 'WAIT' end engine_hybrid,
      case when i_close < i_sma20 and breadth20 <= 40 and breadth50 <= 35 then 'REDUCE'
        when i_close > i_sma20 and breadth20 >= 55 and breadth50 >= 45 then 'DEPLOY' else 'WAIT' end trend_breadth,
      case when i_close < i_sma20 and i_sma20 < i_sma50 and breadth20 <= 40 then 'REDUCE'
        when i_close > i_sma20 and i_sma20 > i_sma50 and breadth20 >= 50 then 'DEPLOY' else 'WAIT' end trend_stack,
      case when i_range60 >= 0.85 and positive5 <= 45 then 'REDUCE'
        when i_close > i_sma20 and breadth20 >= 60 and positive5 >= 55 then 'DEPLOY' else 'WAIT' end exhaustion_overlay
    from v_points
    """,
)
view(
    "v_rules",
    """
    select date, 'engine_hybrid' algorithm, engine_hybrid state, i_fwd5, i_fwd10, i_dd10 from v_signals
    union all select date, 'trend_breadth', trend_breadth, i_fwd5, i_fwd10, i_dd10 from v_signals
    union all select date, 'trend_stack', trend_stack, i_fwd5, i_fwd10, i_dd10 from v_signals
    union all select date, 'exhaustion_overlay', exhaustion_overlay, i_fwd5, i_fwd10, i_dd10 from v_signals
    """,
)


def _state_sql(s: str) -> str:
    cond, n = f"state = '{s}' and i_fwd10 is not null", s.lower()
    return f"""count(case when {cond} then 1 end) {n}_days, avg(case when {cond} then i_fwd5 * 100 end) {n}_ret5,
      avg(case when {cond} then i_fwd10 * 100 end) {n}_ret10, avg(case when {cond} then cast(i_fwd10 > 0 as int) end) * 100 {n}_hit10,
      avg(case when {cond} then i_dd10 * 100 end) {n}_dd10"""


view(
    "v_rule_stats0",
    f"""
    select algorithm, arg_max(state, date) current_bias, avg(case when i_fwd10 is not null then i_fwd10 * 100 end) base_ret10,
      avg(case when i_fwd10 is not null then cast(i_fwd10 > 0 as int) end) * 100 base_hit10,
      avg(case when i_fwd10 is not null then i_dd10 * 100 end) base_dd10, {_state_sql('DEPLOY')}, {_state_sql('WAIT')}, {_state_sql('REDUCE')}
    from v_rules group by algorithm
    """,
)
view(
    "v_rule_stats",
    """
    select *, deploy_ret10 - base_ret10 deploy_vs_base, reduce_ret10 - base_ret10 reduce_vs_base,
      deploy_ret10 - reduce_ret10 deploy_minus_reduce from v_rule_stats0
    """,
)
view(
    "v_best_rule",
    """
    select algorithm from v_rule_stats order by deploy_days >= 50 desc, deploy_vs_base desc, deploy_hit10 desc, deploy_minus_reduce desc, algorithm limit 1
    """,
)
view(
    "v_gate",
    """
    select r.date, has_outcome, state gate from v_rules r join v_best_rule using (algorithm) join v_market m on m.date = r.date
    """,
)


def _scale(x: str, lo: float, hi: float) -> str:
    return f"(case when {x} is not null then (least(greatest({x}, {lo}), {hi}) - {lo}) / ({hi} - {lo}) * 100 end)"


view(
    "v_pick_scores",
    f"""
    with f as (select v.*, has_outcome, gate from v_feat v join v_gate using (date) where gate in ('DEPLOY', 'WAIT'))
    select *, 'trend_leader' algorithm, 0.35 * rel20_rank + 0.25 * rel60_rank + 0.15 * {_scale('dist20', -0.15, 0.15)}
        + 0.10 * {_scale('dist50', -0.2, 0.2)} + 0.15 * {_scale('vol_ratio20', 0.0, 2.0)} score
      from f where dist20 > 0 and dist50 > 0 and rel20 > 0 and rel60 > 0
    union all select *, 'breakout_confirmation', 0.30 * rel20_rank + 0.20 * rel60_rank + 0.15 * sector_breadth20
        + 0.20 * {_scale('vol_ratio20', 0.0, 3.0)} + 0.15 * {_scale('dist20', 0.0, 0.15)}
      from f where dist20 > 0 and dist50 > 0 and ret5 > 0 and vol_ratio20 > 1 and sector_breadth20 >= 40
    union all select *, 'recovery_strength', 0.25 * rel20_rank + 0.30 * rel60_rank + 0.20 * {_scale('greatest(-dist20, 0)', 0.0, 0.08)}
        + 0.15 * sector_breadth20 + 0.10 * {_scale('vol_ratio20', 0.0, 2.0)}
      from f where rel60 > 0 and ret5 < 0 and dist20 < 0 and dist20 > -0.1 and dist50 > -0.03 and sector_breadth20 >= 20 and sector_rel20 > 0
    union all select *, 'sector_rotation', 0.40 * sector_rank + 0.25 * sector_breadth20 + 0.20 * rel20_rank + 0.15 * rel60_rank
      from f where sector_rank >= 70 and sector_breadth20 >= 50 and rel20_rank >= 60
    union all select *, 'residual_momentum', 0.40 * rel20_rank + 0.25 * rel60_rank + 0.20 * {_scale('dist100', -0.2, 0.2)} + 0.15 * sector_breadth20
      from f where rel20 > 0 and rel60 > 0 and dist50 > 0 and sector_breadth20 >= 35
    """,
)
view(
    "v_replay",
    f"""
    select * from (select *, row_number() over (partition by date, algorithm order by round(score, 9) desc, ticker) pick_rank
      from v_pick_scores where score is not null) where pick_rank <= {TOP_K} and has_outcome
    """,
)
view(
    "v_now",
    f"""
    select * from (select *, row_number() over (partition by date, algorithm order by round(score, 9) desc, ticker) pick_rank
      from v_pick_scores where score is not null and date = (select max(date) from v_bars)) where pick_rank <= {TOP_K}
    """,
)


def parts(spark, d):
    """(panel, sectors, market) over bars written once."""
    bars = I.bars_table(spark, d)
    idx = P.index_features(B.index_bars(bars))
    panel = cut_lineage(P.instrument_panel(bars, idx))
    return panel, P.sector_panel(panel), idx


def signals_of(panel, sectors, idx):
    return P.market_signals(P.market_panel(panel, sectors, idx))


def scored(spark, d):
    """Panel and pick scores gated by the best market rule; scores rounded so ties are ties."""
    panel, sectors, idx = parts(spark, d)
    signals = cut_lineage(signals_of(panel, sectors, idx))
    gate = P.market_gate(signals, P.best_rule(P.summarize_rules(signals)))
    scores = P.pick_scores(P.feature_panel(panel), gate)
    return panel, scores.withColumn("score", F.round("score", 9))


INDEX_COLS = "i_ret1 i_ret5 i_ret20 i_ret60 i_sma20 i_sma50 i_sma200 i_range20 i_range60 i_fwd5 i_fwd10 i_dd10".split()


def rd(names, digits=6):
    return ", ".join(f"round({n}, {digits}) {n}" for n in names)


@query("index_features", f"select date, i_close, i_streak, {rd(INDEX_COLS)} from v_idxf")
def index_features(spark, d):
    return rounded(P.index_features(I.index(spark, d)))


PANEL_COLS = "ret1 ret5 ret20 ret60 dist20 dist50 dist100 vol_ratio20 fwd5 fwd10 dd10 rel20 rel60 corr20 beta20 excess5 excess10".split()


@query("instrument_panel", f"select ticker, sector, date, close, volume, {rd(PANEL_COLS)} from v_panel")
def instrument_panel(spark, d):
    bars = I.bars_table(spark, d)
    return rounded(P.instrument_panel(bars, P.index_features(B.index_bars(bars))))


@query("rolling_beta_corr", "select ticker, date, round(corr20, 6) corr20, round(beta20, 6) beta20 from v_panel")
def rolling_beta_corr(spark, d):
    bars = I.bars_table(spark, d)
    panel = P.instrument_panel(bars, P.index_features(B.index_bars(bars)))
    return rounded(panel.select("ticker", "date", "corr20", "beta20"))


@query("sector_panel", f"select date, sector, {rd('sector_breadth20 sector_rel20 sector_rank'.split())} from v_sector")
def sector_panel(spark, d):
    return rounded(parts(spark, d)[1])


@query(
    "feature_panel",
    f"""select ticker, sector, date, close, volume,
    {rd(PANEL_COLS + 'rel20_rank rel60_rank sector_breadth20 sector_rel20 sector_rank'.split())} from v_feat""",
)
def feature_panel(spark, d):
    return rounded(P.feature_panel(parts(spark, d)[0]))


MARKET_COLS = "breadth20 breadth50 positive5 dispersion20 median_rel20 mean_corr20 mean_beta20".split()


@query(
    "market_panel",
    f"select date, i_close, i_streak, {rd(INDEX_COLS + MARKET_COLS)}, has_outcome, leader_sectors, weak_sectors from v_market",
)
def market_panel(spark, d):
    return rounded(P.market_panel(*parts(spark, d)))


@query("market_rules", "select date, engine_hybrid, trend_breadth, trend_stack, exhaustion_overlay from v_signals")
def market_rules(spark, d):
    return signals_of(*parts(spark, d)).select("date", *P.MARKET_RULES)


RULE_STATS = [
    *"base_ret10 base_hit10 base_dd10 deploy_vs_base reduce_vs_base deploy_minus_reduce".split(),
    *[f"{s}_{m}" for s in ("deploy", "wait", "reduce") for m in ("ret5", "ret10", "hit10", "dd10")],
]


@query(
    "market_rule_summary",
    f"select algorithm, current_bias, deploy_days, wait_days, reduce_days, {rd(RULE_STATS)} from v_rule_stats",
)
def market_rule_summary(spark, d):
    return rounded(P.summarize_rules(signals_of(*parts(spark, d))))


@query("best_market_rule", "select algorithm from v_best_rule")
def best_market_rule(spark, d):
    return P.best_rule(P.summarize_rules(signals_of(*parts(spark, d)))).select("algorithm")


@query(
    "market_consensus",
    """
    with l as (select * from v_signals order by date desc limit 1),
    v as (select *, (case engine_hybrid when 'REDUCE' then 1 else 0 end) + (case trend_breadth when 'REDUCE' then 1 else 0 end)
        + (case trend_stack when 'REDUCE' then 1 else 0 end) + (case exhaustion_overlay when 'REDUCE' then 1 else 0 end) nr,
        (case engine_hybrid when 'DEPLOY' then 1 else 0 end) + (case trend_breadth when 'DEPLOY' then 1 else 0 end)
        + (case trend_stack when 'DEPLOY' then 1 else 0 end) + (case exhaustion_overlay when 'DEPLOY' then 1 else 0 end) nd from l)
    select date, r.algorithm, r.state, i_close, round(i_range60, 6) i_range60, round(breadth20, 6) breadth20, round(breadth50, 6) breadth50,
      round(positive5, 6) positive5, case when nr >= 2 then 'REDUCE' when nd >= 2 then 'DEPLOY' else 'WAIT' end consensus
    from v join v_rules r using (date)
    """,
)
def market_consensus(spark, d):
    return rounded(P.consensus(signals_of(*parts(spark, d))))


@query(
    "pick_replay",
    f"""select date, ticker, sector, algorithm, gate, pick_rank, round(round(score, 9), 6) score, {rd('fwd5 fwd10 excess5 excess10 dd10'.split())} from v_replay""",
)
def pick_replay(spark, d):
    _, scores = scored(spark, d)
    picks = P.top_picks(scores.filter("has_outcome"), TOP_K)
    return rounded(
        picks.select("date", "ticker", "sector", "algorithm", "gate", "pick_rank", "score", "fwd5", "fwd10", "excess5", "excess10", "dd10")
    )


@query(
    "pick_evaluation",
    """
    with dly as (select algorithm, date, count(*) n, avg(fwd5 * 100) fwd5, avg(fwd10 * 100) fwd10, avg(excess5 * 100) excess5, avg(excess10 * 100) excess10
      from v_replay group by 1, 2),
    b as (select algorithm, count(*) signal_days, avg(fwd5) basket_fwd5, avg(fwd10) basket_fwd10, avg(excess5) basket_excess5, avg(excess10) basket_excess10,
      avg(case when fwd5 > 0 then 1.0 else 0 end) * 100 basket_hit_fwd5, avg(case when fwd10 > 0 then 1.0 else 0 end) * 100 basket_hit_fwd10 from dly group by 1),
    p as (select algorithm, count(*) total_picks, avg(fwd5) * 100 pick_fwd5, avg(fwd10) * 100 pick_fwd10, avg(excess5) * 100 pick_excess5,
      avg(excess10) * 100 pick_excess10, avg(dd10) * 100 pick_dd10, avg(case when fwd5 > 0 then 1.0 else 0 end) * 100 pick_hit_fwd5,
      avg(case when fwd10 > 0 then 1.0 else 0 end) * 100 pick_hit_fwd10 from v_replay group by 1)
    select algorithm, signal_days, cast(total_picks as bigint) total_picks, round(total_picks / signal_days, 6) picks_per_day, """
    + rd([f"basket_{c}" for c in P.OUTCOMES] + ["basket_hit_fwd5", "basket_hit_fwd10"] + [f"pick_{c}" for c in P.OUTCOMES] + ["pick_dd10", "pick_hit_fwd5", "pick_hit_fwd10"])
    + " from b join p using (algorithm)",
)
def pick_evaluation(spark, d):
    _, scores = scored(spark, d)
    return rounded(P.evaluate_picks(P.top_picks(scores.filter("has_outcome"), TOP_K)))


def current_picks(panel, scores):
    latest = panel.agg(F.max("date")).scalar()
    return P.top_picks(scores.filter(F.col("date") == latest), TOP_K)


@query(
    "current_picks",
    f"select date, ticker, sector, algorithm, gate, pick_rank, round(round(score, 9), 6) score, {rd('rel20 rel60 dist20 dist50 sector_breadth20 vol_ratio20'.split())} from v_now",
)
def current_picks_query(spark, d):
    panel, scores = scored(spark, d)
    return rounded(
        current_picks(panel, scores).select(
            "date", "ticker", "sector", "algorithm", "gate", "pick_rank", "score", "rel20", "rel60", "dist20", "dist50",
            "sector_breadth20", "vol_ratio20",
        )
    )


@query(
    "case_studies",
    f"""
    with h as (select ticker, algorithm, count(*) past_picks, avg(fwd5) * 100 past_fwd5, avg(fwd10) * 100 past_fwd10, avg(excess10) * 100 past_excess10,
      avg(case when fwd10 > 0 then 1.0 else 0 end) * 100 past_hit10, max(date) last_pick_date from v_replay group by 1, 2),
    r as (select unnest(['trend_leader', 'breakout_confirmation', 'recovery_strength', 'sector_rotation', 'residual_momentum']) algorithm)
    select i.ticker, i.sector, r.algorithm, round(round(n.score, 9), 6) score, n.pick_rank, n.score is not null active,
      coalesce(past_picks, 0) past_picks, {rd('past_fwd5 past_fwd10 past_excess10 past_hit10'.split())}, last_pick_date
    from v_inst i, r left join v_now n on n.ticker = i.ticker and n.algorithm = r.algorithm
      left join h on h.ticker = i.ticker and h.algorithm = r.algorithm
    where i.ticker in (select ticker from v_bars)
    """,
)
def case_studies(spark, d):
    panel, scores = scored(spark, d)
    scores = cut_lineage(scores)
    replay = P.top_picks(scores.filter("has_outcome"), TOP_K)
    members = panel.select("ticker", "sector").distinct()
    return rounded(P.case_studies(members, current_picks(panel, scores), replay))


@query(
    "direction_sample",
    f"""
    with p as (select date, close p_close, case when close > lag(close) over w and lag(close) over w > lag(close, 2) over w then 1.0
          when close < lag(close) over w and lag(close) over w < lag(close, 2) over w then -1.0 else 0.0 end peer_streak,
        (close / nullif(lag(close, 5) over w, 0) - 1) * 100 peer_ret5, (close / nullif(lag(close, 20) over w, 0) - 1) * 100 peer_ret20
      from v_peer window w as (order by date))
    select m.date, round(i_ret5 * 100, 6) index_ret5, round(breadth20, 6) breadth20, round(dispersion20, 6) dispersion20,
      leader_sectors, weak_sectors, peer_streak, round(peer_ret5, 6) peer_ret5, round(peer_ret20, 6) peer_ret20,
      round(i_ret5 * 100 - peer_ret5, 6) index_vs_peer_ret5,
      case when i_fwd5 is not null then cast(i_fwd5 > 0 as int) end up5, case when i_fwd10 is not null then cast(i_fwd10 > 0 as int) end up10
    from v_market m join p using (date)
    """,
)
def direction_sample(spark, d):
    """Market rows with labels for the 5- and 10-day direction of the index."""
    panel, sectors, idx = parts(spark, d)
    peer = P.one_series(I.peer_index(spark, d))
    w = R.ordered(P.INDEX_KEY)
    step = peer.withColumn("_r", R.change_pct("close", w, 1))
    peers = step.select(
        "date", R.streak_state("_r", w, 2).alias("peer_streak"), R.change_pct("close", w, 5).alias("peer_ret5"),
        R.change_pct("close", w, 20).alias("peer_ret20"),
    )
    m = P.market_panel(panel, sectors, idx).join(peers, "date")
    label = {n: F.when(F.col(f"i_fwd{n}").isNotNull(), (F.col(f"i_fwd{n}") > 0).cast("int")) for n in (5, 10)}
    return rounded(
        m.select(
            "date", (F.col("i_ret5") * 100).alias("index_ret5"), "breadth20", "dispersion20", "leader_sectors", "weak_sectors",
            "peer_streak", "peer_ret5", "peer_ret20", (F.col("i_ret5") * 100 - F.col("peer_ret5")).alias("index_vs_peer_ret5"),
            label[5].alias("up5"), label[10].alias("up10"),
        )
    )


@query(
    "outperform_sample",
    """
    select ticker, date, round(rel20_rank, 6) rel20_rank, round(sector_rank, 6) sector_rank, round(breadth20, 6) breadth20,
      round(excess10 * 100, 6) excess10_pct, case when excess10 is not null then cast(excess10 > 0 as int) end outperform10
    from v_feat join v_market using (date)
    """,
)
def outperform_sample(spark, d):
    panel, sectors, idx = parts(spark, d)
    rows = P.feature_panel(panel).join(P.market_panel(panel, sectors, idx).select("date", "breadth20"), "date")
    return rounded(
        rows.select(
            "ticker", "date", "rel20_rank", "sector_rank", "breadth20", (F.col("excess10") * 100).alias("excess10_pct"),
            F.when(F.col("excess10").isNotNull(), (F.col("excess10") > 0).cast("int")).alias("outperform10"),
        )
    )


@query(
    "close_cells",
    """
    select c.date, i.ticker, b.close from (select distinct date from v_bars) c cross join (select distinct ticker from v_bars) i
      left join v_bars b on b.date = c.date and b.ticker = i.ticker
    """,
)
def close_cells(spark, d):
    """Every (date, instrument) cell, missing bars as null: the long form of the wide matrix."""
    bars = I.bars_table(spark, d).select("date", "ticker", "close")
    calendar = bars.agg(F.collect_set("date").alias("dates")).scalar()
    cells = bars.select("ticker").distinct().select("ticker", F.explode(calendar).alias("date"))
    return cells.join(bars, ["date", "ticker"], "left")
