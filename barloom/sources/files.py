"""File sources and sinks for bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import cut_lineage
from barloom.sources.bars import epoch_to_local_date

BAR_CSV = T.StructType(
    [
        T.StructField("t", T.LongType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("date_vn", T.StringType()),
    ]
)


#: Lines that do not fit the schema are kept as text in this column.
REJECTED = "_rejected"


def _read_bar_csv(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Bar files of any number of instruments in one scan; ``ticker`` comes from the file's metadata.

    A file is called by its instrument (``AAA_daily.csv``) or lies in a folder of its own
    (``ticker=AAA/...``).
    """
    lines = spark.read.text(path).filter(~F.trim("value").startswith("t,") & (F.trim("value") != ""))  # no headers
    # from text, since a line is to be judged by all its cells, whatever columns a query needs
    schema = T.StructType([*BAR_CSV, T.StructField(REJECTED, T.StringType())])
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    cells = F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})
    folder = F.regexp_extract("_metadata.file_path", r"/ticker=([^/]+)/", 1)
    name = F.regexp_extract("_metadata.file_name", "^(.+)" + suffix.replace(".", r"\.") + "$", 1)
    return lines.select(F.upper(F.when(folder != "", folder).otherwise(name)).alias("ticker"), cells.alias("_c")).select("ticker", "_c.*")


def _csv_path(folder: str, suffix: str, by_folder: bool) -> str:
    return f"{folder}/ticker=*" if by_folder else f"{folder}/*{suffix}"


def read_daily_csv(spark: SparkSession, folder: str, suffix: str = "_daily.csv", by_folder: bool = False) -> DataFrame:
    """Daily bars of all per-instrument files of a folder; lines that do not fit are left out (see ``rejected_lines``)."""
    raw = _read_bar_csv(spark, _csv_path(folder, suffix, by_folder), suffix)
    local = F.coalesce(F.to_date("date_vn"), epoch_to_local_date(F.col("t")))
    return raw.filter(F.col(REJECTED).isNull()).select("ticker", local.alias("date"), "open", "high", "low", "close", "volume", "t")


def rejected_lines(spark: SparkSession, folder: str, suffix: str = "_daily.csv", by_folder: bool = False) -> DataFrame:
    """(ticker, line) of the lines that do not fit the schema."""
    raw = _read_bar_csv(spark, _csv_path(folder, suffix, by_folder), suffix)
    return raw.filter(F.col(REJECTED).isNotNull()).select("ticker", F.col(REJECTED).alias("line"))


def read_intraday_csv(spark: SparkSession, folder: str, suffix: str = "_5m.csv", by_folder: bool = False) -> DataFrame:
    """Intraday files: local timestamp and trading date, null volume as 0, rows without price dropped."""
    raw = _read_bar_csv(spark, _csv_path(folder, suffix, by_folder), suffix)
    at = F.convert_timezone(
        F.current_timezone(),
        F.lit("Asia/Ho_Chi_Minh"),
        F.to_timestamp_ntz(F.timestamp_seconds("t").cast("string")),
    )
    return (
        raw.filter(F.col("t").isNotNull() & F.col("close").isNotNull() & F.col(REJECTED).isNull())
        .withColumn("bar_ts", at)
        .select("ticker", "bar_ts", F.to_date("bar_ts").alias("trade_date"), "open", "high", "low", "close", F.coalesce("volume", F.lit(0.0)).alias("volume"))
    )


def clean_doubles(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every floating-point column."""
    fixed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(field.name)
            fixed[field.name] = F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
    return df.withColumns(fixed) if fixed else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Replace an artefact (parquet, csv with header, or json lines)."""
    writer = clean_doubles(df).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def prune_stale(spark: SparkSession, path: str, keep: DataFrame, keys: Sequence[str], partition: str) -> list:
    """Delete from a written parquet table the rows whose keys ``keep`` lacks; returns the partitions touched.

    Only partitions with stale rows are rewritten; one that has none left is removed. Null keys
    equal nothing, so rows with one are stale.
    """
    stored = spark.read.parquet(path)
    wanted = keep.select(*keys).distinct()
    stale = stored.join(wanted, list(keys), "left_anti")
    touched = [r[0] for r in stale.select(partition).distinct().collect()]  # partition values only
    if not touched:
        return []
    own = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        own = own | F.col(partition).isNull()
    kept = cut_lineage(stored.filter(own).join(wanted, list(keys), "left_semi"))
    left = {r[0] for r in kept.select(partition).distinct().collect()}
    kept.select(*stored.columns).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(partition).parquet(path)
    for value in touched:
        if value not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
