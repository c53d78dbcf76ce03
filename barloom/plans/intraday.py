"""Intraday snapshots, tape and burst queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import intraday as D
from barloom.plans import inputs as I
from barloom.plans.panel import rd
from barloom.plans.registry import query, view
from barloom.plans.snapshot import rounded
from barloom.session import cut_lineage

M = "(hour(bar_ts) * 60 + minute(bar_ts))"
BUCKET = (
    f"case when {M} < 585 then null when {M} < 630 then 'AM_EARLY' when {M} < 690 then 'AM_LATE' when {M} < 780 then 'LUNCH_BREAK' "
    f"when {M} < 825 then 'PM_EARLY' when {M} < 865 then 'PM_LATE' end"
)
FROM_OPEN = f"cast(case when {M} < 690 then {M} - 540 when {M} < 780 then 150 else 150 + {M} - 780 end as double)"

view(
    "v_i5m",
    """
    select 'INDEX' ticker, bar_ts, cast(sum(open) // count(*) as bigint) open, cast(sum(high) // count(*) as bigint) high,
      cast(sum(low) // count(*) as bigint) low, cast(sum(close) // count(*) as bigint) close, cast(sum(volume) as bigint) volume, trade_date
    from v_5m group by bar_ts, trade_date
    """,
)


def index_5m(bars):
    """Index over the same five-minute bars."""
    fields = [F.expr(f"sum({f}) div count({f})").alias(f) for f in ("open", "high", "low", "close")]
    out = bars.groupBy("bar_ts", "trade_date").agg(*fields, F.sum("volume").alias("volume"))
    return out.withColumn("ticker", F.lit("INDEX"))


def _pos(x: str, lo: str, hi: str) -> str:
    return f"case when {hi} = {lo} then 0.5 else ({x} - {lo}) / nullif({hi} - {lo}, 0) end"


def _snap_views(name: str, src: str) -> None:
    view(
        f"{name}_a",
        f"""
        select *, {M} m, {BUCKET} bucket, count(close) over later later_n, first(open) over so_far day_open, max(high) over so_far hi, min(low) over so_far lo,
          cast(sum(volume) over so_far as bigint) vol, sum(close * volume) over so_far pv,
          first(case when {M} >= 780 then open end ignore nulls) over so_far pm_open,
          coalesce(sum(case when {M} >= 780 then volume end) over so_far, 0) pm_vol, last(close) over whole day_close, max(high) over later next_hi, min(low) over later next_lo,
          coalesce((close / nullif(lag(close) over d, 0) - 1) * 100, 0) last5m, coalesce((close / nullif(lag(close, 3) over d, 0) - 1) * 100, 0) last15m,
          coalesce((close / nullif(lag(close, 6) over d, 0) - 1) * 100, 0) last30m, coalesce((close / nullif(lag(close, 12) over d, 0) - 1) * 100, 0) last60m,
          max(high) over b6 h30, min(low) over b6 l30, max(high) over b12 h60, min(low) over b12 l60
        from {src} window d as (partition by ticker, trade_date order by bar_ts),
          so_far as (partition by ticker, trade_date order by bar_ts rows between unbounded preceding and current row),
          later as (partition by ticker, trade_date order by bar_ts rows between 1 following and unbounded following),
          whole as (partition by ticker, trade_date order by bar_ts rows between unbounded preceding and unbounded following),
          b6 as (partition by ticker, trade_date order by bar_ts rows between 6 preceding and current row),
          b12 as (partition by ticker, trade_date order by bar_ts rows between 12 preceding and current row)
        """,
    )
    view(
        f"{name}_d",
        f"""
        select ticker, trade_date, lag(dc) over w prev_close, case when count(dv) over f = 20 then avg(dv) over f end adv20, max(trade_date) over (partition by ticker) newest
        from (select ticker, trade_date, arg_max(close, bar_ts) dc, sum(volume) dv from {src} group by 1, 2)
        window w as (partition by ticker order by trade_date), f as (partition by ticker order by trade_date rows between 20 preceding and 1 preceding)
        """,
    )
    view(
        f"{name}_b",
        f"""
        select *, coalesce(pv / nullif(vol, 0), close) vwap from {name}_a join {name}_d using (ticker, trade_date)
        where prev_close is not null and bucket is not null and
          (trade_date = newest and later_n = 0 or trade_date <> newest and minute(bar_ts) % 15 = 0 and later_n > 0)
        """,
    )
    ret = lambda a, b: f"coalesce(({a} / nullif({b}, 0) - 1) * 100, 0)"
    pct = lambda a, b: f"coalesce({a} / nullif({b}, 0) * 100, 0)"
    view(
        name,
        f"""
        select ticker, trade_date, bar_ts, bucket, close snapshot_close, day_open, hi session_high, lo session_low, vol session_volume, vwap,
          {ret('day_open', 'prev_close')} gap_pct, {ret('close', 'day_open')} open_to_snapshot_pct, last5m, last15m, last30m, last60m,
          {pct('(h30 - l30)', 'prev_close')} range30m_pct, {pct('(h60 - l60)', 'prev_close')} range60m_pct, {_pos('close', 'l30', 'h30')} pos30m,
          {_pos('close', 'l60', 'h60')} pos60m, {pct('(hi - lo)', 'prev_close')} session_range_pct, {_pos('close', 'lo', 'hi')} pos_session,
          {ret('close', 'vwap')} vwap_dev_pct, {pct('vol', 'adv20')} volume_pct_adv20, {ret('close', 'hi')} to_high_pct, {ret('close', 'lo')} to_low_pct,
          {FROM_OPEN} minutes_from_open, greatest(240 - {FROM_OPEN}, 0.0) minutes_to_close, {FROM_OPEN} / 240 * 100 progress_pct,
          {ret('close', 'pm_open')} pm_ret_pct, {pct('pm_vol', 'adv20')} pm_volume_pct_adv20,
          case when later_n > 0 then (day_close / nullif(close, 0) - 1) * 100 end target_close, case when later_n > 0 then (next_hi / nullif(close, 0) - 1) * 100 end target_high,
          case when later_n > 0 then (next_lo / nullif(close, 0) - 1) * 100 end target_low
        from {name}_b
        """,
    )


_snap_views("v_isnap", "v_5m")
_snap_views("v_xsnap", "v_i5m")
DOUBLES = (
    "vwap gap_pct open_to_snapshot_pct last5m last15m last30m last60m range30m_pct range60m_pct pos30m pos60m session_range_pct pos_session "
    "vwap_dev_pct volume_pct_adv20 to_high_pct to_low_pct minutes_from_open minutes_to_close progress_pct pm_ret_pct pm_volume_pct_adv20 "
    "target_close target_high target_low"
).split()
PLAIN = "ticker, trade_date, bar_ts, bucket, snapshot_close, day_open, session_high, session_low, session_volume"


@query("intraday_snapshots", f"select {PLAIN}, {rd(DOUBLES)} from v_isnap")
def intraday_snapshots(spark, d):
    return rounded(D.intraday_snapshots(cut_lineage(I.bars_5m(spark, d))))


@query(
    "intraday_snapshot_sample",
    f"""
    select o.ticker, o.trade_date, o.bar_ts, o.bucket, o.snapshot_close, x.snapshot_close i_snapshot_close, round(x.gap_pct, 6) i_gap_pct,
      {', '.join(f'round(o.{c} - x.{c}, 6) rel_{c}' for c in D.RELATIVE)}, {', '.join(f'round(o.{c}, 6) {c}' for c in D.TARGETS)}
    from v_isnap o join v_xsnap x on o.trade_date = x.trade_date and o.bar_ts = x.bar_ts and o.bucket = x.bucket
    """,
)
def intraday_snapshot_sample(spark, d):
    bars = cut_lineage(I.bars_5m(spark, d))
    rows = D.snapshot_sample(D.intraday_snapshots(bars), D.intraday_snapshots(index_5m(bars)))
    return rounded(
        rows.select(
            "ticker", "trade_date", "bar_ts", "bucket", "snapshot_close", "i_snapshot_close", "i_gap_pct",
            *[f"rel_{c}" for c in D.RELATIVE], *D.TARGETS,
        )
    )


@query(
    "duplicate_snapshots",
    "select ticker, trade_date, bar_ts, bucket, count(*) row_count from v_isnap group by all having count(*) > 1",
)
def duplicate_snapshots(spark, d):
    return D.duplicate_snapshots(D.intraday_snapshots(cut_lineage(I.bars_5m(spark, d))))


@query(
    "session_buckets",
    f"select ticker, bucket, count(*) bars, min({FROM_OPEN}) first_minute, max({FROM_OPEN}) last_minute from (select *, {BUCKET} bucket from v_5m) group by 1, 2",
)
def session_buckets(spark, d):
    clock = D.SessionClock()
    ts = F.col("bar_ts")
    rows = I.bars_5m(spark, d).select("ticker", clock.bucket(ts).alias("bucket"), clock.minutes_from_open(ts).alias("m"))
    return rows.groupBy("ticker", "bucket").agg(
        F.count(F.lit(1)).alias("bars"), F.min("m").alias("first_minute"), F.max("m").alias("last_minute")
    )


view("v_last5", "select * from (select *, max(trade_date) over (partition by ticker) nd from v_5m) where trade_date = nd")
view("v_lasti", "select * from (select *, max(trade_date) over (partition by ticker) nd from v_i5m) where trade_date = nd")


@query(
    "tape_checkpoints",
    """
    with o as (select ticker, arg_min(open, bar_ts) o from v_last5 group by 1),
    c as (select unnest(['09:15', '09:45', '10:30', '11:00', '13:15', '14:00', '14:25', '14:45']) checkpoint)
    select ticker, checkpoint, arg_max(close, bar_ts) close, round((arg_max(close, bar_ts) / nullif(max(o), 0) - 1) * 100, 6) from_open_pct,
      cast(sum(volume) as bigint) volume_so_far from v_last5 join o using (ticker), c where strftime(bar_ts, '%H:%M') <= checkpoint group by 1, 2
    """,
)
def tape_checkpoints(spark, d):
    return rounded(D.checkpoints(D.latest_session(cut_lineage(I.bars_5m(spark, d)))))


def _stats_sql(src: str) -> str:
    return f"""select ticker, arg_min(open, bar_ts) open, arg_max(close, bar_ts) close, max(high) high, min(low) low,
      first(strftime(bar_ts, '%H:%M') order by high desc, bar_ts) high_at, first(strftime(bar_ts, '%H:%M') order by low, bar_ts) low_at,
      sum((high + low + close) / 3.0 * volume) / nullif(sum(volume), 0) vwap, max(case when i <= 6 then high end) dh,
      coalesce(arg_min(open, bar_ts) filter (strftime(bar_ts, '%H:%M') >= '13:00'), arg_min(open, bar_ts)) pmo
    from (select *, row_number() over (partition by ticker order by bar_ts) i from {src}) group by ticker"""


@query(
    "tape_summary",
    f"""
    with s as (select *, (close / nullif(pmo, 0) - 1) * 100 pm_ret_pct from ({_stats_sql('v_last5')})),
    x as (select (close / nullif(pmo, 0) - 1) * 100 ipm from ({_stats_sql('v_lasti')})),
    a as (select *, (close - low) / nullif(high - low, 0) * 100 close_in_range_pct, (close / nullif(high, 0) - 1) * 100 fade_pct,
        (close / nullif(vwap, 0) - 1) * 100 vs_vwap_pct, (dh / nullif(open, 0) - 1) * 100 drive_pct, pm_ret_pct - ipm pm_excess_pct from s, x),
    b as (select *, coalesce(drive_pct >= 1.5 and fade_pct <= -2 and close_in_range_pct <= 35 and cast(left(high_at, 2) as int) < 11, false) squeeze_failure,
        case when close_in_range_pct <= 35 and vs_vwap_pct < 0 and pm_excess_pct <= -0.5 then 'distribution'
          when close_in_range_pct >= 65 and vs_vwap_pct >= 0 and pm_excess_pct >= 0.5 then 'absorption' else 'neutral' end bias from a)
    select ticker, open, close, high, low, high_at, low_at, {rd('vwap pm_ret_pct close_in_range_pct fade_pct vs_vwap_pct drive_pct pm_excess_pct'.split())},
      squeeze_failure, bias, case when squeeze_failure then 'failed_followthrough' when bias = 'distribution' then 'respect_t25_supply'
        when bias = 'absorption' then 'respect_day2_followthrough' else 'neutral' end burst_bias,
      case when squeeze_failure or bias = 'distribution' then 'high' when bias = 'absorption' then 'light' else 'moderate' end trim
    from b
    """,
)
def tape_summary(spark, d):
    bars = cut_lineage(I.bars_5m(spark, d))
    return rounded(D.tape_summary(bars, index_5m(bars)))


view(
    "v_burst0",
    """
    select *, coalesce(r1 >= 6.5, false) or coalesce(r2 >= 10, false) hit from (
      select ticker, (close / lag(close) over w - 1) * 100 r1, (close / lag(close, 2) over w - 1) * 100 r2, (lead(close) over w / close - 1) * 100 n1,
        (lead(close, 3) over w / close - 1) * 100 n3, (min(low) over (partition by ticker order by date rows between 1 following and 3 following) / close - 1) * 100 low3,
        row_number() over w i from v_bars window w as (partition by ticker order by date))
    """,
)
view(
    "v_burst",
    """
    select ticker, case when count(*) >= 25 then count(case when hit then 1 end) else 0 end samples,
      case when count(*) >= 25 then avg(case when hit then cast(n1 > 0 as int) end) * 100 end next_positive_pct,
      case when count(*) >= 25 then avg(case when hit then cast(n1 >= 3 as int) end) * 100 end next_strong_pct,
      case when count(*) >= 25 then avg(case when hit then cast(n3 < 0 as int) end) * 100 end third_negative_pct,
      case when count(*) >= 25 then avg(case when hit and n3 is not null then low3 end) end drawdown3_pct,
      case when count(*) >= 25 then max(i) - max(case when hit then i end) end signal_age
    from v_burst0 group by ticker
    """,
)


@query(
    "burst_patterns",
    f"select ticker, samples, signal_age, {rd('next_positive_pct next_strong_pct third_negative_pct drawdown3_pct'.split())} from v_burst",
)
def burst_patterns(spark, d):
    return rounded(D.burst_patterns(I.bars(spark, d)))
