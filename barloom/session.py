"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; cluster submitters keep their own master.

    Small shuffles keep several partitions: window-heavy plans are bound by CPU, not bytes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a session on one machine gets a folder of its own; on a cluster that
    would be a folder other machines cannot see, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barloom-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path of its own in the shared folder; what is written there goes when the session ends."""
    path = f"{shared_folder(spark).rstrip('/')}/barloom-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    For tables used by several branches of one plan: the source is scanned once, later
    branches read only the columns they need, sizes are known to the optimizer, and a lost
    executor does not force the upstream work again.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
