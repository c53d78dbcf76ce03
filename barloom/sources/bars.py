"""Building price bars from trades or ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_sequence(*parts: tuple[Column | str, int]) -> Column:
    """Non-negative whole numbers as one decimal that orders like the tuple.

    Each part is (column, digits it may take); 38 digits in all.
    """
    total = sum(d for _, d in parts)
    if total > 38:
        raise ValueError("a packed sequence holds at most 38 digits")
    out, rest = None, total
    for column, digits in parts:
        rest -= digits
        column = F.col(column) if isinstance(column, str) else column
        scaled = (column.cast(f"decimal({digits},0)") * F.lit(str(10**rest)).cast(f"decimal({rest + 1},0)")) if rest else column.cast(f"decimal({digits},0)")
        out = scaled if out is None else out + scaled
    return out.cast("decimal(38,0)")


def build_bars(
    trades: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    bucket_name: str,
    sequence: Sequence[str],
    price: str = "price",
    size: str = "size",
) -> DataFrame:
    """OHLCV bars per ``keys`` and bucket.

    Open and close follow the total order ``sequence``. All aggregates combine on the map
    side, so the shuffle carries partial bars and a hot instrument costs nothing extra. One
    packed number as sequence (see :func:`packed_sequence`) keeps the aggregation hashed;
    several columns make Spark sort the trades first.
    """
    at = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)
    return (
        trades.withColumn(bucket_name, bucket)
        .groupBy(*keys, bucket_name)
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.sum(size).alias("volume"),
            F.sum(F.col(price) * F.col(size)).alias("value"),
        )
    )


def index_bars(bars: DataFrame, weighted: bool = False) -> DataFrame:
    """Market index per date: mean of the instruments' prices, or their volume-weighted mean.

    Whole-number prices stay whole numbers (integer division), so results are exact.
    """
    fields = ("open", "high", "low", "close")
    if weighted:
        prices = [
            F.expr(f"sum({f} * volume) div sum(volume)").alias(f) for f in fields
        ]
    else:
        prices = [F.expr(f"sum({f}) div count({f})").alias(f) for f in fields]
    return bars.groupBy("date").agg(*prices, F.sum("volume").alias("volume"))


def latest_snapshot(ticks: DataFrame, key: str, at: str, price: str, size: str, sequence: Sequence[str]) -> DataFrame:
    """Last price and time per key, and the volume and value of that key's last day."""
    order = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)
    day = F.to_date(at)
    daily = ticks.groupBy(key, day.alias("day")).agg(
        F.max(at).alias("last_at"),
        F.max_by(price, order).alias("last_price"),
        F.sum(size).alias("day_volume"),
        F.sum(F.col(price) * F.col(size)).alias("day_value"),
    )
    return daily.groupBy(key).agg(
        *[F.max_by(c, "day").alias(c) for c in ("last_at", "last_price", "day_volume", "day_value")]
    )


def upsert_keep_last(batches: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """Merge stacked batches; of equal keys the row of the highest batch number stays.

    An aggregate rather than a window: the map side already drops overwritten rows.
    """
    fields = [c for c in batches.columns if c not in keys and c != batch]
    return (
        batches.groupBy(*keys)
        .agg(F.max_by(F.struct(*fields), batch).alias("_row"))
        .select(*keys, *[F.col(f"_row.{f}").alias(f) for f in fields])
    )


def history_summary(bars: DataFrame, key: str = "ticker", at: str = "date") -> DataFrame:
    return bars.groupBy(key).agg(
        F.count(F.lit(1)).alias("bars"), F.min(at).alias("first_date"), F.max(at).alias("last_date")
    )


def refresh_plan(bars: DataFrame, as_of: str, min_days: int, reconcile_days: int) -> DataFrame:
    """Date ranges to fetch again: a recent tail always, a backfill where history is shallow."""
    today = F.to_date(F.lit(as_of))
    wanted = F.date_sub(today, min_days)
    tail = F.date_sub(F.col("last_date"), reconcile_days)
    shallow = F.col("first_date") > wanted
    return history_summary(bars).select(
        "ticker",
        "bars",
        F.when(shallow, wanted).alias("backfill_from"),
        F.when(shallow, F.date_sub("first_date", 1)).alias("backfill_to"),
        tail.alias("tail_from"),
        today.alias("tail_to"),
    )


def drop_partial_bar(bars: DataFrame, as_of: str, close_hour: int = 15) -> DataFrame:
    """Leave out a bar dated ``as_of``'s day while the session is open, if it is not the only bar."""
    now = F.to_timestamp_ntz(F.lit(as_of))
    count = bars.groupBy("ticker").agg(F.count(F.lit(1)).alias("_bars"))
    partial = (F.col("date") == F.to_date(now)) & (F.hour(now) < close_hour) & (F.col("_bars") >= 2)
    return bars.join(count, "ticker").filter(~partial).drop("_bars")


def epoch_to_local_date(seconds: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """Trading date of an epoch-second stamp in the exchange's zone, whatever the session zone."""
    at_utc = F.convert_timezone(
        F.current_timezone(), F.lit(zone), F.to_timestamp_ntz(F.timestamp_seconds(seconds).cast("string"))
    )
    return F.to_date(at_utc)
