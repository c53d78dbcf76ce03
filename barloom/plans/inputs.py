"""Market tables derived from the star schema, and the same as named sub-selects.

Prices are whole numbers in 1/10000 of the source unit, so sums and moving averages are
exact; ``PRICE_UNIT`` of them make one unit of the exchange's price grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.registry import view
from barloom.session import cut_lineage
from barloom.sources.bars import build_bars, index_bars, packed_sequence

PRICE_UNIT = 1_000_000.0
MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def instruments(spark: SparkSession, d: str) -> DataFrame:
    """Universe: one instrument per nation, its region as sector."""
    return (
        table(spark, d, "nation")
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("ticker"), F.col("r_name").alias("sector"))
    )


def trades(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as trades of the supplier's nation.

    Which joins broadcast is left to the optimizer's size estimate.
    """
    lines = table(spark, d, "lineitem").select(
        "l_suppkey",
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.expr("(cast(round(l_extendedprice * 100) as bigint) * 100) div cast(l_quantity as bigint)").alias("price"),
        F.col("l_quantity").cast("long").alias("size"),
        F.col("l_returnflag").alias("flag"),
        F.to_date("l_shipdate").alias("date"),
    )
    return (
        lines.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(instruments(spark, d), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("seq", packed_sequence(("ok", 18), ("ln", 4), ("price", 14)))
        .select("ticker", "sector", "n_nationkey", "l_suppkey", "ok", "ln", "price", "size", "flag", "date", "seq")
    )


def bars(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars per instrument (ticker, sector, date, OHLC, volume, value)."""
    return build_bars(trades(spark, d), ["ticker", "sector"], F.col("date"), "date", ["seq"])


def bars_table(spark: SparkSession, d: str) -> DataFrame:
    """Bars written once, for plans that use them in more than one branch."""
    return cut_lineage(bars(spark, d))


def index(spark: SparkSession, d: str) -> DataFrame:
    return index_bars(bars(spark, d))


def peer_index(spark: SparkSession, d: str) -> DataFrame:
    return index_bars(bars(spark, d), weighted=True)


def ticks(spark: SparkSession, d: str) -> DataFrame:
    """Events as ticks: type = instrument, value in whole cents = price, unit size."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "event_id",
        F.expr("cast(round(value * 100) as bigint)").alias("price"),
        F.expr("user_id % 10 + 1").alias("size"),
        packed_sequence((F.expr(MICROS), 18), ("event_id", 18)).alias("seq"),
    )


def bars_5m(spark: SparkSession, d: str) -> DataFrame:
    start = F.date_trunc("hour", "ts") + F.expr("make_dt_interval(0, 0, (minute(ts) div 5) * 5, 0)")
    out = build_bars(ticks(spark, d), ["ticker"], start.cast("timestamp_ntz"), "bar_ts", ["seq"])
    return out.withColumn("trade_date", F.to_date("bar_ts"))


def positions(spark: SparkSession, d: str) -> DataFrame:
    """Net quantity and mean entry price per instrument; returned lines count negative."""
    signed = F.when(F.col("flag") == "R", -F.col("size")).otherwise(F.col("size"))
    return (
        trades(spark, d)
        .groupBy("ticker", "sector")
        .agg(
            F.sum(signed).alias("quantity"),
            (F.sum(F.col("price") * F.col("size")) / F.sum("size") / PRICE_UNIT).alias("avg_price"),
        )
    )


def flow_trades(spark: SparkSession, d: str) -> DataFrame:
    """Trades with the class of the buyer: foreign (customer abroad) and proprietary (urgent orders)."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (
        trades(spark, d)
        .join(orders, F.col("ok") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .withColumns(
            {
                "is_foreign": F.col("c_nationkey") != F.col("n_nationkey"),
                "is_prop": F.col("o_orderpriority") == "1-URGENT",
                "is_sell": F.col("flag") == "R",
            }
        )
    )


def factors(spark: SparkSession, d: str) -> DataFrame:
    """Macro factor series (factor, date, value): order totals per market segment and day, in cents."""
    return (
        table(spark, d, "orders")
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("factor"), F.to_date("o_orderdate").alias("date"))
        .agg(F.sum(F.expr("cast(round(o_totalprice * 100) as bigint)")).alias("value"))
    )


def quarters(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly facts per instrument: revenue and units of the shipped lines."""
    end = F.last_day(F.add_months(F.trunc("date", "quarter"), 2))
    return (
        trades(spark, d)
        .groupBy("ticker", end.alias("period_end"))
        .agg(F.sum(F.col("price") * F.col("size")).alias("revenue"), F.sum("size").alias("units"))
    )


view("v_inst", "select n_nationkey, n_name ticker, r_name sector from nation join region on n_regionkey = r_regionkey")
view(
    "v_trades",
    """
    select ticker, sector, n_nationkey, l_suppkey, l_orderkey ok, l_linenumber ln,
      (cast(round(l_extendedprice * 100) as bigint) * 100) // cast(l_quantity as bigint) price,
      cast(l_quantity as bigint) size, l_returnflag flag, cast(l_shipdate as date) date
    from lineitem join supplier on l_suppkey = s_suppkey join v_inst on s_nationkey = n_nationkey
    """,
)
view(
    "v_bars",
    """
    select ticker, sector, date, first(price order by ok, ln, price) open, max(price) high, min(price) low,
      first(price order by ok desc, ln desc, price desc) close,
      cast(sum(size) as bigint) volume, cast(sum(price * size) as bigint) "value"
    from v_trades group by ticker, sector, date
    """,
)
view(
    "v_index",
    """
    select date, cast(sum(open) // count(*) as bigint) open, cast(sum(high) // count(*) as bigint) high,
      cast(sum(low) // count(*) as bigint) low, cast(sum(close) // count(*) as bigint) close,
      cast(sum(volume) as bigint) volume
    from v_bars group by date
    """,
)
view(
    "v_peer",
    """
    select date, cast(sum(open * volume) // sum(volume) as bigint) open,
      cast(sum(high * volume) // sum(volume) as bigint) high, cast(sum(low * volume) // sum(volume) as bigint) low,
      cast(sum(close * volume) // sum(volume) as bigint) close, cast(sum(volume) as bigint) volume
    from v_bars group by date
    """,
)
view(
    "v_ticks",
    """
    select event_type ticker, ts, event_id, cast(round(value * 100) as bigint) price, user_id % 10 + 1 size from events
    """,
)
view(
    "v_5m",
    """
    select ticker, time_bucket(interval '5 minutes', ts) bar_ts, first(price order by ts, event_id) open,
      max(price) high, min(price) low, first(price order by ts desc, event_id desc) close,
      cast(sum(size) as bigint) volume, cast(sum(price * size) as bigint) "value",
      cast(time_bucket(interval '5 minutes', ts) as date) trade_date
    from v_ticks group by ticker, time_bucket(interval '5 minutes', ts)
    """,
)
view(
    "v_pos",
    """
    select ticker, sector, cast(sum(case when flag = 'R' then -size else size end) as bigint) quantity,
      cast(sum(price * size) as double) / cast(sum(size) as double) / 1000000.0 avg_price
    from v_trades group by ticker, sector
    """,
)
view(
    "v_flow_trades",
    """
    select t.*, c_nationkey <> n_nationkey is_foreign, o_orderpriority = '1-URGENT' is_prop, flag = 'R' is_sell
    from v_trades t join orders on ok = o_orderkey join customer on o_custkey = c_custkey
    """,
)
view(
    "v_factors",
    """
    select c_mktsegment factor, cast(o_orderdate as date) date,
      cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) "value"
    from orders join customer on o_custkey = c_custkey group by 1, 2
    """,
)
view(
    "v_quarters",
    """
    select ticker, last_day(date_trunc('quarter', date) + interval 2 month) period_end,
      cast(sum(price * size) as bigint) revenue, cast(sum(size) as bigint) units
    from v_trades group by 1, 2
    """,
)
