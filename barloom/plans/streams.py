"""Streaming queries: the same bars as the batch ones, built incrementally."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.plans.registry import query, view
from barloom.session import new_path
from barloom.streaming import bars as SB


@query("streaming_bars", 'select ticker, bar_ts, open, high, low, close, volume, "value" from v_5m')
def streaming_bars(spark, d):
    return SB.run_upsert(SB.read_ticks(spark, f"{d}/events.parquet")).drop("last_at")


view(
    "v_deliveries",
    """
    select event_type ticker, case when event_id % 13 <> 0 then event_id end event_id, ts, value, user_id, k from (
      select *, 1 k from events where event_id % 5 <> 4
      union all select *, 2 from events where event_id % 5 = 4
      union all select * replace (value + 1 as value), 2 from events where event_id % 5 <> 4 and event_id % 7 = 0 and event_id % 13 <> 0
      union all select * replace (ts + interval 1 day as ts), 3 from events where event_id % 11 = 0
      union all select * replace (ts - interval 20 minute as ts), 3 from events where event_id % 11 <> 0 and event_id % 17 = 0
    )
    """,
)


def deliveries(spark, d):
    """Three deliveries of the events: most, then late ones and corrected values, then corrected times; some without ids."""
    events = spark.read.schema(SB.EVENTS).parquet(f"{d}/events.parquet")
    i = F.col("event_id")
    late, first = events.filter(i % 5 == 4), events.filter(i % 5 != 4)
    values = first.filter((i % 7 == 0) & (i % 13 != 0)).withColumn("value", F.col("value") + 1)
    days = events.filter(i % 11 == 0).withColumn("ts", F.expr("ts + interval 1 day"))
    times = events.filter((i % 11 != 0) & (i % 17 == 0)).withColumn("ts", F.expr("ts - interval 20 minute"))
    return [x.withColumn("event_id", F.when(i % 13 != 0, i)) for x in (first, late.unionByName(values), days.unionByName(times))]


@query(
    "streaming_corrections",
    """
    with named as (
      select ticker, event_id, unnest(arg_max({'ts': ts, 'value': value, 'user_id': user_id}, k)) from v_deliveries
      where event_id is not null group by ticker, event_id
    ),
    t as (
      select ticker, ts, event_id, cast(round(value * 100) as bigint) price, user_id % 10 + 1 size from named
      union all
      select ticker, ts, null, cast(round(value * 100) as bigint), user_id % 10 + 1 from v_deliveries where event_id is null
    )
    select ticker, time_bucket(interval '5 minutes', ts) bar_ts, max(price) high, min(price) low,
      first(price order by ts, coalesce(event_id, 0)) open, first(price order by ts desc, coalesce(event_id, 0) desc) close,
      cast(sum(size) as bigint) volume, cast(sum(price * size) as bigint) "value"
    from t group by 1, 2
    """,
)
def streaming_corrections(spark, d):
    """Bars after three deliveries, each taken up by a call that goes on where the last one ended."""
    folder = new_path(spark, "stream")
    bars = None
    for part in deliveries(spark, d):
        part.write.mode("append").parquet(f"{folder}/in")
        bars = SB.run_upsert(SB.read_ticks(spark, f"{folder}/in"), folder=f"{folder}/state")
    return bars.drop("last_at")


view(
    "v_rsi5",
    """
    with recursive b as (
      select ticker, cast(row_number() over w as bigint) n, cast(close - lag(close) over w as double) step from v_5m window w as (partition by ticker order by bar_ts)
    ),
    r as (
      select ticker, n, greatest(step, 0) up, greatest(-step, 0) down from b where n = 2
      union all
      select r.ticker, b.n, r.up * 13 / 14 + greatest(b.step, 0) / 14, r.down * 13 / 14 + greatest(-b.step, 0) / 14
      from r join b on b.ticker = r.ticker and b.n = r.n + 1
    ),
    z as (select ticker, max(n) n from b group by ticker)
    select z.ticker, case when z.n >= 14 and r.down <> 0 then 100 - 100 / (1 + r.up / r.down) else 0.0 end rsi14
    from z left join r on r.ticker = z.ticker and r.n = z.n
    """,
)


@query(
    "streaming_latest",
    """
    with dayed as (select *, max(cast(ts as date)) over (partition by ticker) last_day from v_ticks),
    l as (
      select ticker, max(ts) last_at, arg_max(price, (ts, event_id)) last_price, cast(sum(size) as bigint) day_volume,
        cast(sum(price * size) as bigint) day_value
      from dayed where cast(ts as date) = last_day group by ticker
    )
    select ticker, last_at, last_price, day_volume, day_value, round(rsi14, 6) rsi14 from l join v_rsi5 using (ticker)
    """,
)
def streaming_latest(spark, d):
    """Last price, that day's totals, and RSI14 over the 5-minute closes (0.0 when there is none)."""
    ticks = SB.read_ticks(spark, f"{d}/events.parquet")
    bars = SB.run_upsert(ticks)
    daily = (
        bars.withColumn("day", F.date_trunc("day", "bar_ts"))
        .groupBy("ticker", "day")
        .agg(
            F.max_by("close", "bar_ts").alias("close"), F.sum("volume").alias("volume"), F.sum("value").alias("value"),
            F.max("last_at").alias("last_at"),
        )
        .withColumnRenamed("day", "bar_ts")
    )
    return SB.latest_from_daily(daily).join(SB.latest_rsi(bars), "ticker").select(
        "ticker", "last_at", "last_price", "day_volume", "day_value", F.round("rsi14", 6).alias("rsi14")
    )
