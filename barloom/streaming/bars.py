"""Incremental bars from a stream of tick files, with corrections.

A tick belongs to an event (``ticker``, ``event_id``); delivered again, its newest delivery counts
and the older one is gone, also where the new one lies in another window or on another day.
Ticks without an event id are events of their own.

Ticks are stored by trade date. An index of last versions, by event, tells a batch where the
events it redelivers were before; a batch writes a withdrawal there, so that each day's folder by
itself says which of its ticks still count. The batch then rebuilds the windows that it or its
withdrawals touched, from the folders of those days only. A late row of any age, a correction or
a file delivered twice so lands in its window, and no state is kept between batches but files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.smoothing import with_rsi
from barloom.session import new_path
from barloom.sources.bars import packed_sequence, upsert_keep_last

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Window starts are wall-clock times, whatever the session's zone.
_ZERO = "timestamp_ntz'1970-01-01 00:00:00'"
_MICROS = f"timestampdiff(MICROSECOND, {_ZERO}, ts)"
#: Folders of the index of last versions. Runs of 16,384 ids share one, so a batch of new ids reads few.
INDEX_FOLDERS = 256
EVENT = ["ticker", "event_id"]


def as_pattern(path: str) -> str:
    """A pattern that fits this path alone, for a stream's plain path must be a folder.

    Streams of files take every path for a pattern, also those of the files they find, so a path
    with pattern characters cannot be read and is an error.
    """
    path = path.rstrip("/")
    if set(path) & set("*?[]{}\\^"):
        raise ValueError(f"a stream cannot read a path with pattern characters: {path}")
    return f"{path[:-1]}[{path[-1]}]"


def read_ticks(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Stream of ticks from a parquet file or a folder of dropped files, so many files a batch.

    ``delivered`` orders deliveries within a batch: when the file was written, then its name.
    """
    price = F.expr("cast(round(value * 100) as bigint)")
    size = F.expr("user_id % 10 + 1")
    return (
        spark.readStream.schema(EVENTS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(as_pattern(path))
        .select(
            F.col("event_type").alias("ticker"),
            "ts",
            "event_id",
            # ids order ticks of one moment, for those without one price and size do
            packed_sequence(
                (F.expr(_MICROS), 16), (F.coalesce("event_id", F.lit(0)), 18), (F.pmod(F.xxhash64(price, size), F.lit(10_000)), 4)
            ).alias("seq"),
            price.alias("price"),
            size.alias("size"),
            F.struct("_metadata.file_modification_time", "_metadata.file_name").alias("delivered"),
        )
    )


def _with_window(ticks: DataFrame, minutes: int) -> DataFrame:
    span = minutes * 60_000_000
    start = F.expr(f"timestampadd(MICROSECOND, {_MICROS} - pmod({_MICROS}, {span}), {_ZERO})")
    return ticks.withColumn("bar_ts", start)


def last_versions(ticks: DataFrame, *newest: str, within: Sequence[str] = ()) -> DataFrame:
    """Of each event (of each ``within``) the tick that is last by ``newest``, then by itself; ticks without an event id all stay."""
    keys = [*EVENT, *within]
    others = [c for c in ticks.columns if c not in keys]
    named = ticks.filter("ticker is not null and event_id is not null")
    last = F.max_by(F.struct(*others), F.struct(*newest, *others))
    kept = named.groupBy(*keys).agg(last.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
    return kept.select(*ticks.columns).unionByName(ticks.filter("ticker is null or event_id is null"))


def windowed_bars(ticks: DataFrame, minutes: int = 5) -> DataFrame:
    """OHLCV per instrument and tumbling window of ticks that all count."""
    order = F.col("seq")
    return (
        _with_window(ticks, minutes)
        .groupBy("ticker", "bar_ts")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("size").alias("volume"),
            F.sum(F.col("price") * F.col("size")).alias("value"),
            F.max("ts").alias("last_at"),
        )
    )


def _there(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist."""
    out = []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            out.append(path)
    return out


def _read(spark: SparkSession, root: str, column: str, values: Sequence, schema: T.StructType, upto: int) -> DataFrame:
    """Rows of batches up to ``upto`` in the folders ``column=value`` of ``root``; other folders are not listed."""
    paths = _there(spark, [f"{root}/{column}={v}" for v in values])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).filter(F.col("batch") <= upto)


class Store:
    """The files of a stream under one folder: ticks by day, last versions by event, rows by batch."""

    def __init__(self, spark: SparkSession, root: str, ticks: T.StructType, minutes: int):
        self.spark, self.root, self.minutes = spark, root, minutes
        self.schema = ticks
        version = [T.StructField("batch", T.LongType())]
        self.ticks = T.StructType([*ticks, T.StructField("withdrawn", T.BooleanType()), T.StructField("trade_date", T.DateType()), *version])
        places = [ticks["ticker"], ticks["event_id"], T.StructField("ts", T.TimestampNTZType())]
        self.places = T.StructType([*places, T.StructField("folder", T.IntegerType()), *version])

    def _write(self, rows: DataFrame, name: str, *by: str) -> None:
        """Each batch has folders of its own, so a batch repeated after a failure replaces itself."""
        rows = rows.hint("rebalance", by[0])  # few files a folder, large folders split
        rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*by).parquet(f"{self.root}/{name}")

    def add(self, batch: DataFrame, number: int, oldest: str | None) -> None:
        """Store a batch of ticks and write the windows it changes."""
        spark, root = self.spark, self.root
        if oldest is not None:
            limit = F.to_timestamp_ntz(F.lit(oldest))
            batch.filter(F.col("ts") < limit).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
            batch = batch.filter(F.col("ts") >= limit)
        newest = ["delivered"] if "delivered" in batch.columns else []
        last_versions(batch, *newest).write.mode("overwrite").parquet(f"{root}/inbox")
        new = spark.read.schema(self.schema).parquet(f"{root}/inbox").withColumn("trade_date", F.to_date("ts"))

        folder = F.pmod(F.shiftright("event_id", 14), F.lit(INDEX_FOLDERS)).cast("int")
        events = new.filter("ticker is not null and event_id is not null")
        places = events.select(*EVENT, "ts", folder.alias("folder"))
        folders = [r[0] for r in places.select("folder").distinct().collect()]  # INDEX_FOLDERS at most
        known = _read(spark, f"{root}/versions", "folder", folders, self.places, number - 1)
        before = (
            known.join(places.select(*EVENT), EVENT, "left_semi")
            .groupBy(*EVENT).agg(F.max_by("ts", "batch").alias("ts"))
            .withColumn("trade_date", F.to_date("ts"))
        )
        before.write.mode("overwrite").parquet(f"{root}/replaced")
        before = spark.read.schema(before.schema).parquet(f"{root}/replaced")

        # on the event's new day its new tick replaces the old one; on another day a withdrawal does
        withdrawn = before.join(events.select(*EVENT, "trade_date"), [*EVENT, "trade_date"], "left_anti").withColumn("withdrawn", F.lit(True))
        stored = new.withColumn("withdrawn", F.lit(False)).unionByName(withdrawn, allowMissingColumns=True)
        self._write(stored.withColumn("batch", F.lit(number).cast("long")), "ticks", "trade_date", "batch")
        self._write(places.withColumn("batch", F.lit(number).cast("long")), "versions", "folder", "batch")

        touched = _with_window(new.select("ticker", "ts").unionByName(before.select("ticker", "ts")), self.minutes).select("ticker", "bar_ts").distinct()
        days = [r[0] for r in stored.select("trade_date").distinct().collect()]  # dates only
        own = _read(spark, f"{root}/ticks", "trade_date", days, self.ticks, number)
        valid = last_versions(own, "batch", within=["trade_date"]).filter("not withdrawn")
        bars = windowed_bars(valid, self.minutes)
        # a window that has lost its last tick stays as a row of nulls, which replaces its bar
        rows = touched.join(bars, ["ticker", "bar_ts"], "left")
        rows.write.mode("overwrite").parquet(f"{root}/rows/batch={number}")

    def bars(self) -> DataFrame:
        """The newest row of every window that has ticks."""
        bars = windowed_bars(self.spark.createDataFrame([], self.schema), self.minutes).schema
        if not _there(self.spark, [f"{self.root}/rows"]):
            return self.spark.createDataFrame([], bars)
        rows = self.spark.read.schema(T.StructType([*bars.fields, T.StructField("batch", T.LongType())])).parquet(f"{self.root}/rows")
        return upsert_keep_last(rows, ["ticker", "bar_ts"], "batch").filter("close is not null")


def run_upsert(ticks: DataFrame, minutes: int = 5, folder: str | None = None, oldest: str | None = None) -> DataFrame:
    """Process all available input and return the newest row per instrument and window.

    Equals ``windowed_bars`` of the last version of every event, whatever the batches were. State
    and progress lie in ``folder`` (by default one of its own in the shared folder), so any
    executor can be lost and a later call goes on where this one ended. Of an event delivered
    twice within a batch the newest by ``delivered`` counts, if there is such a column, and of
    equal ones the largest tick. Ticks before ``oldest`` (a time, None for no limit) are written
    to ``folder``/late instead. Ticks without a time are left out.
    """
    spark = ticks.sparkSession
    root = (folder or new_path(spark, "stream")).rstrip("/")
    store = Store(spark, root, ticks.schema, minutes)
    (
        ticks.filter("ts is not null").writeStream.option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: store.add(batch, number, oldest))
        .start()
        .awaitTermination()
    )
    return store.bars()


def latest_from_daily(daily: DataFrame) -> DataFrame:
    """Last price and time per instrument with that day's volume and value."""
    day = F.col("bar_ts")
    return daily.groupBy("ticker").agg(
        F.max_by("last_at", day).alias("last_at"),
        F.max_by("close", day).alias("last_price"),
        F.max_by("volume", day).alias("day_volume"),
        F.max_by("value", day).alias("day_value"),
    )


def latest_rsi(bars: DataFrame, period: int = 14) -> DataFrame:
    """(ticker, rsi14) of the last bar; 0.0 where there are fewer bars than ``period`` or no losses."""
    last = with_rsi(bars.withColumn("date", F.col("bar_ts")), period, "rsi").groupBy("ticker").agg(
        F.max_by("rsi", "bar_ts").alias("rsi"), F.count(F.lit(1)).alias("n")
    )
    return last.select("ticker", F.coalesce(F.when(F.col("n") >= period, F.col("rsi")), F.lit(0.0)).alias("rsi14"))
