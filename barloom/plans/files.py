"""File sources and sinks: what is written is read back, checked against the tables it came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.plans import inputs as I
from barloom.plans import metrics as PX
from barloom.plans.registry import query, view
from barloom.session import cut_lineage, new_path
from barloom.sources import checks as C
from barloom.sources import files as FS

_EPOCH = "cast(unix_date(date) as bigint) * 86400"
HEADER = "t,open,high,low,close,volume,date_vn"


def daily_files(spark, d):
    """Daily bars as CSV folders: half of the rows without a local date, some lines damaged."""
    rows = I.bars(spark, d)
    t = F.expr(f"{_EPOCH} - 14400")  # eight in the evening in UTC is the next day at the exchange
    cells = [t, *[F.col(c) for c in ("open", "high", "low", "close", "volume")], F.when(F.col("volume") % 2 == 0, F.col("date"))]
    damaged = F.col("volume") % 7 == 3
    columns = [F.when(damaged & F.lit(k == 1), F.lit("n/a")).otherwise(c.cast("string")).alias(n) for k, (c, n) in enumerate(zip(cells, HEADER.split(",")))]
    path = new_path(spark, "daily")
    rows.select("ticker", *columns).write.partitionBy("ticker").option("header", True).csv(path)
    return path


@query(
    "daily_csv_scan",
    """
    select ticker, date, cast(open as double) open, cast(high as double) high, cast(low as double) low, cast(close as double) close, cast(volume as double) volume
    from v_bars where volume % 7 <> 3
    """,
)
def daily_csv_scan(spark, d):
    """Bars read back from one file folder per instrument; dates from the file or its epoch seconds."""
    return FS.read_daily_csv(spark, daily_files(spark, d), by_folder=True).drop("t")


@query("daily_csv_rejects", "select ticker, count(*) rejected from v_bars where volume % 7 = 3 group by 1")
def daily_csv_rejects(spark, d):
    """Lines per instrument that do not fit the schema."""
    return FS.rejected_lines(spark, daily_files(spark, d), by_folder=True).groupBy("ticker").agg(F.count(F.lit(1)).alias("rejected"))


@query(
    "intraday_csv_scan",
    """
    select upper(ticker) ticker, bar_ts, cast(bar_ts as date) trade_date, cast(open as double) open, cast(high as double) high, cast(low as double) low, cast(close as double) close,
      cast(case when volume % 3 = 0 then 0 else volume end as double) volume from v_5m where volume % 5 <> 4
    """,
)
def intraday_csv_scan(spark, d):
    """5-minute bars read back from CSV with local times; rows without a price are dropped, missing volumes are 0."""
    rows = I.bars_5m(spark, d)
    t = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', bar_ts) - 25200")
    close, volume = F.when(F.col("volume") % 5 != 4, F.col("close")), F.when(F.col("volume") % 3 != 0, F.col("volume"))
    path = new_path(spark, "intraday")
    rows.select(
        "ticker", t.alias("t"), "open", "high", "low", close.alias("close"), volume.alias("volume"), F.lit(None).cast("string").alias("date_vn")
    ).write.partitionBy("ticker").option("header", True).csv(path)
    return FS.read_intraday_csv(spark, path, by_folder=True)


@query(
    "sink_round_trip",
    """
    with v as (select ticker, date, case when volume % 3 = 0 then null else cast(close as double) / volume end ratio from v_bars)
    select format, ticker, count(*) row_count, count(ratio) known, round(sum(ratio), 1) total from v, (values ('parquet'), ('csv'), ('json')) f(format) group by 1, 2
    """,
)
def sink_round_trip(spark, d):
    """The same table through every sink; NaN and infinities come back as null."""
    odd = F.when(F.col("volume") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    ratio = F.when(F.col("volume") % 3 == 0, odd).otherwise(F.col("close") / F.col("volume"))
    rows = cut_lineage(I.bars(spark, d).select("ticker", "date", ratio.alias("ratio")))
    out = None
    for fmt in ("parquet", "csv", "json"):
        path = new_path(spark, f"sink-{fmt}")
        FS.write_table(rows, path, fmt)
        back = spark.read.schema(rows.schema).option("header", True).format(fmt).load(path).withColumn("format", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out.groupBy("format", "ticker").agg(F.count(F.lit(1)).alias("row_count"), F.count("ratio").alias("known"), F.round(F.sum("ratio"), 1).alias("total"))


@query("case_tolerant_columns", "select l_returnflag flag, count(*) row_count, cast(sum(l_quantity) as double) quantity from lineitem group by 1")
def case_tolerant_columns(spark, d):
    """Columns asked for in any case, after a check that all that are needed are there."""
    lines = I.table(spark, d, "lineitem")
    lines = lines.toDF(*[c.upper() if k % 2 else c.title() for k, c in enumerate(lines.columns)])
    flag, quantity = (C.resolve_column(lines, c) for c in ("l_returnflag", "L_QUANTITY"))
    rows = C.require_columns(lines, [flag, quantity]).groupBy(F.col(flag).alias("flag"))
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum(quantity).alias("quantity"))


@query(
    "layer_modes",
    """
    with l as (select ticker, max(date) last_date from v_bars group by 1), f as (select ticker, cast(sum(size) as bigint) foreign_size from v_flow_trades where is_foreign group by 1)
    select mode, ticker, last_date, case when mode <> 'core' then foreign_size end foreign_size, cast(null as double) pe from l left join f using (ticker), (values ('core'), ('auto')) m(mode)
    """,
)
def layer_modes(spark, d):
    """Instruments with optional layers of which one is absent, in two modes."""
    base = I.bars(spark, d).groupBy("ticker").agg(F.max("date").alias("last_date"))
    flows = I.flow_trades(spark, d).filter("is_foreign").groupBy("ticker").agg(F.sum("size").alias("foreign_size"))
    layers = {"flows": (flows, "foreign_size bigint"), "statements": (None, "pe double")}
    out = [C.with_layers(base, layers, ["ticker"], mode).withColumn("mode", F.lit(mode)) for mode in ("core", "auto")]
    return out[0].unionByName(out[1])


view("v_keepkeys", "select distinct ticker, horizon from v_tnow where horizon <> 3 and ticker > 'C' or horizon = 10")


@query(
    "pruned_forecasts",
    "select f.ticker, f.horizon, count(*) row_count from v_tf f join v_keepkeys using (ticker, horizon) group by 1, 2",
)
def pruned_forecasts(spark, d):
    """Forecasts written by horizon, then rid of keys without a wanted current forecast, and read back."""
    rows = cut_lineage(PX.timing_forecasts(spark, d))
    path = new_path(spark, "forecasts")
    rows.select("ticker", "date", "model", "horizon").write.partitionBy("horizon").parquet(path)
    now = PX.current_timing(spark, d, rows).select("ticker", "horizon")
    wanted = now.filter("horizon <> 3 and ticker > 'C' or horizon = 10")
    FS.prune_stale(spark, path, wanted, ["ticker", "horizon"], "horizon")
    return spark.read.parquet(path).groupBy("ticker", "horizon").agg(F.count(F.lit(1)).alias("row_count"))
