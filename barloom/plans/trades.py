"""Playbook signals, trades and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import trades as TR
from barloom.plans import inputs as I
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage

_SPANS = TR.EMA_SPANS
view(
    "v_ema4",
    "with recursive src as (select ticker, date, close, row_number() over (partition by ticker order by date) rn from v_bars), fold as (select ticker, rn, "
    + ", ".join(f"cast(close as double) e{n}" for n in _SPANS)
    + " from src where rn = 1 union all select f.ticker, f.rn + 1, "
    + ", ".join(f"f.e{n} * (1 - {2 / (n + 1)!r}) + b.close * {2 / (n + 1)!r}" for n in _SPANS)
    + " from fold f join src b on b.ticker = f.ticker and b.rn = f.rn + 1) select ticker, rn - 1 idx, "
    + ", ".join(f"e{n} ema{n}" for n in _SPANS)
    + " from fold",
)
view(
    "v_pb0",
    """
    select ticker, date, open, high, low, close, volume, row_number() over w - 1 idx, count(*) over (partition by ticker) n,
      cast(floor(count(*) over (partition by ticker) * 0.7) as int) split, close / lag(close) over w - 1 ret1, close / lag(close, 3) over w - 1 ret3,
      case when count(*) over f20 = 20 then avg(close) over f20 end sma20, case when count(*) over f50 = 50 then avg(close) over f50 end sma50,
      case when count(*) over f200 = 200 then avg(close) over f200 end sma200, case when count(*) over f20 = 20 then volume / nullif(avg(volume) over f20, 0) end vol_ratio20,
      case when count(*) over p5 = 5 then max(high) over p5 end prior_high5, case when count(*) over p10 = 10 then max(high) over p10 end prior_high10,
      case when count(*) over f60 = 60 then close / max(close) over f60 - 1 end dd60,
      case when count(*) over f20 = 20 then avg(close) over f20 - 2 * stddev_samp(close) over f20 end bb,
      case when count(step) over f14 = 14 then 100 - 100 / (1 + avg(greatest(step, 0)) over f14 / nullif(avg(greatest(-step, 0)) over f14, 0)) end rsi14
    from v_ret window w as (partition by ticker order by date), """
    + ", ".join(f"f{n} as (partition by ticker order by date rows between {n - 1} preceding and current row)" for n in (14, 20, 50, 60, 200))
    + ", "
    + ", ".join(f"p{n} as (partition by ticker order by date rows between {n} preceding and 1 preceding)" for n in (5, 10)),
)
view(
    "v_pb",
    """
    select a.*, close / nullif(sma20, 0) - 1 dist_sma20, lag(close < bb) over (partition by a.ticker order by date) was_below, ema5, ema7, ema10, ema15
    from v_pb0 a join v_ema4 e on a.ticker = e.ticker and a.idx = e.idx
    """,
)
view(
    "v_setups",
    "select * from (values "
    + ", ".join(
        f"({s.signal_id}, '{s.family}', " + ", ".join(str(x) for x in (*s.limits, 0.0, 0.0, 0.0, 0.0)[:4]) + ")" for s in TR.setups()
    )
    + ") t(signal_id, family, a, b, c, d)",
)
view(
    "v_configs",
    "select * from (values "
    + ", ".join(
        f"({c.config_id}, {c.signal_id}, '{c.family}', {c.ema_span}, {c.max_hold}, {'cast(null as double)' if c.target is None else c.target})"
        for c in TR.catalogue()
    )
    + ") t(config_id, signal_id, family, ema_span, max_hold, target)",
)
view(
    "v_fired",
    """
    select p.*, signal_id, s.family fam from v_pb p, v_setups s where case s.family
      when 'washout_reclaim' then dd60 <= a and rsi14 <= b and ret1 > 0 and was_below
      when 'trend_pullback' then dist_sma20 between a and 0 and rsi14 between b and c and ret1 > 0 and close > ema10 and close >= sma200
      when 'breakout_followthrough' then dd60 <= a and close > (case b when 5 then prior_high5 else prior_high10 end) and ret1 >= c and vol_ratio20 >= d
      else close >= sma50 and sma50 >= sma200 and close > (case a when 5 then prior_high5 else prior_high10 end) and ret3 >= b and vol_ratio20 >= c and dist_sma20 <= d end
    """,
)
view(
    "v_cand",
    """
    select f.ticker, f.date, f.idx, c.config_id, c.ema_span, c.target, seg.segment,
      least(c.max_hold, (case seg.segment when 'train' then f.split else f.n end) - f.idx - 1) span, e.open entry
    from v_fired f join v_configs c on c.signal_id = f.signal_id cross join (select unnest(['train', 'test', 'all']) segment) seg
      join v_pb0 e on e.ticker = f.ticker and e.idx = f.idx + 1
    where f.idx >= case seg.segment when 'test' then greatest(f.split, 21) else 21 end
      and f.idx < (case seg.segment when 'train' then f.split else f.n end) - 1
    """,
)
view(
    "v_hits",
    """
    select c.ticker, c.idx, c.config_id, c.segment, min(p.idx - c.idx - 1) k
    from v_cand c join v_pb p on p.ticker = c.ticker and p.idx between c.idx + 3 and c.idx + c.span
    where p.high >= c.entry * (1 + c.target) or p.low <= c.entry * (1 + -0.1)
      or p.close < case c.ema_span when 5 then p.ema5 when 7 then p.ema7 when 10 then p.ema10 else p.ema15 end
    group by all
    """,
)
view(
    "v_tlab0",
    """
    select c.*, coalesce(h.k, c.span - 1) + 1 hold, h.k from v_cand c left join v_hits h using (ticker, idx, config_id, segment)
    """,
)
view(
    "v_tlab",
    """
    select l.ticker, l.config_id, l.segment, l.date, l.idx, l.idx + l.hold exit_idx, l.hold, l.entry,
      case when k is null then 'time' when x.high >= l.entry * (1 + l.target) then 'target' when x.low <= l.entry * (1 + -0.1) then 'stop' else 'ema' end reason,
      case when k is null then cast(x.close as double) when x.high >= l.entry * (1 + l.target) then l.entry * (1 + l.target)
        when x.low <= l.entry * (1 + -0.1) then l.entry * (1 + -0.1) else cast(x.close as double) end exit_,
      (select (min(low) / l.entry - 1) * 100 from v_pb0 q where q.ticker = l.ticker and q.idx between l.idx + 1 and l.idx + l.hold) drawdown_pct,
      (select (max(high) / l.entry - 1) * 100 from v_pb0 q where q.ticker = l.ticker and q.idx between l.idx + 1 and l.idx + l.hold) runup_pct
    from v_tlab0 l join v_pb0 x on x.ticker = l.ticker and x.idx = l.idx + l.hold
    """,
)
view(
    "v_next",
    """
    select s.ticker, s.config_id, s.segment, s.idx, min(t.idx) nxt from v_tlab0 s join v_tlab0 t
      on t.ticker = s.ticker and t.config_id = s.config_id and t.segment = s.segment and t.idx > s.idx + s.hold group by all
    """,
)
view(
    "v_kept",
    """
    with recursive k as (
      select ticker, config_id, segment, min(idx) idx from v_tlab0 group by all
      union all
      select k.ticker, k.config_id, k.segment, n.nxt from k join v_next n using (ticker, config_id, segment, idx))
    select * from k
    """,
)
view("v_trades_kept", "select *, (exit_ / entry - 1) * 100 ret_pct from v_tlab join v_kept using (ticker, config_id, segment, idx)")
view(
    "v_tmetrics",
    """
    select ticker, config_id, segment, count(*) trades, avg(case when ret_pct > 0 then 1.0 else 0 end) * 100 win_pct, avg(ret_pct) avg_ret, median(ret_pct) median_ret,
      case when -sum(case when ret_pct <= 0 then ret_pct else 0 end) > 0 then sum(case when ret_pct > 0 then ret_pct else 0 end) / -sum(case when ret_pct <= 0 then ret_pct else 0 end) end profit_factor,
      avg(hold) avg_hold, min(drawdown_pct) worst_drawdown
    from v_trades_kept group by all
    """,
)
view(
    "v_tscored",
    """
    select *, case when trades < 3 then -999.0 else coalesce(avg_ret + 0.35 * median_ret + 0.12 * win_pct + 2.5 * coalesce(least(profit_factor, 3.0), 0.0)
      - 0.12 * avg_hold + 0.25 * worst_drawdown + least(cast(trades as double), 12.0), -999.0) end score from v_tmetrics
    """,
)
view(
    "v_playbook0",
    """
    select i.ticker, c.config_id, c.family, coalesce(tr.score, -999.0) train_score, coalesce(te.score, -999.0) test_score, coalesce(al.score, -999.0) all_score,
      coalesce(te.trades, 0) test_trades, coalesce(al.trades, 0) all_trades
    from (select distinct ticker from v_bars) i cross join v_configs c
      left join v_tscored tr on tr.ticker = i.ticker and tr.config_id = c.config_id and tr.segment = 'train'
      left join v_tscored te on te.ticker = i.ticker and te.config_id = c.config_id and te.segment = 'test'
      left join v_tscored al on al.ticker = i.ticker and al.config_id = c.config_id and al.segment = 'all'
    """,
)
view(
    "v_playbook",
    """
    select *, case when test_trades >= 3 then 0.45 * train_score + 0.55 * test_score when test_trades = 2 then 0.6 * train_score + 0.4 * test_score - 3
      when test_trades = 1 then 0.75 * train_score + 0.25 * test_score - 6 else train_score - 12 end robust_score from v_playbook0
    """,
)


def labels(spark, d):
    indicators = cut_lineage(TR.playbook_indicators(I.bars_table(spark, d)))
    return indicators, TR.label_trades(indicators, TR.catalogue_table(spark))


def kept(spark, d):
    return TR.non_overlapping(labels(spark, d)[1])


@query(
    "setup_signals",
    "select ticker, date, signal_id from v_fired",
)
def setup_signals(spark, d):
    return TR.fired_setups(TR.playbook_indicators(I.bars(spark, d))).select("ticker", "date", "signal_id")


@query(
    "signal_trades",
    f"""select ticker, config_id, segment, date, cast(idx as int) idx, cast(exit_idx as int) exit_idx, cast(hold as int) hold, reason,
      cast(entry as double) entry, round(exit_, 4) "exit", {rd('ret_pct drawdown_pct runup_pct'.split())} from v_trades_kept""",
)
def signal_trades(spark, d):
    return rounded(kept(spark, d).withColumn("exit", F.round("exit", 4)), "exit")


METRICS = "win_pct avg_ret median_ret profit_factor avg_hold worst_drawdown".split()


@query("trade_metrics", f"select ticker, config_id, segment, trades, {rd(METRICS)} from v_tmetrics")
def trade_metrics(spark, d):
    return rounded(TR.trade_metrics(kept(spark, d)))


SCORES = "train_score test_score all_score robust_score".split()


@query(
    "playbook_scores",
    f"select ticker, config_id, family, test_trades, all_trades, {rd(SCORES)} from v_playbook",
)
def playbook_scores(spark, d):
    indicators, rows = labels(spark, d)
    out = TR.playbook_scores(
        TR.trade_metrics(TR.non_overlapping(rows)), indicators.select("ticker").distinct(), TR.catalogue_table(spark)
    )
    return rounded(out.select("ticker", "config_id", "family", "test_trades", "all_trades", *SCORES))


@query(
    "best_playbook",
    f"""select ticker, config_id, family, {rd(SCORES)} from v_playbook
    qualify row_number() over (partition by ticker order by round(robust_score, 9) desc, round(test_score, 9) desc, round(train_score, 9) desc, round(all_score, 9) desc, config_id) = 1""",
)
def best_playbook(spark, d):
    indicators, rows = labels(spark, d)
    out = TR.playbook_scores(
        TR.trade_metrics(TR.non_overlapping(rows)), indicators.select("ticker").distinct(), TR.catalogue_table(spark)
    )
    out = out.withColumns({s: F.round(s, 9) for s in SCORES})
    return rounded(TR.best_playbook(out).select("ticker", "config_id", "family", *SCORES))


@query(
    "current_setups",
    "select ticker, date, signal_id from v_fired where idx = n - 1",
)
def current_setups(spark, d):
    return TR.current_signals(TR.playbook_indicators(I.bars(spark, d)))
