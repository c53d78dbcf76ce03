"""Input checks: required columns, expected keys, duplicates, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, required: Sequence[str], name: str = "table") -> DataFrame:
    """Fail while the plan is built, naming every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")
    return df


def resolve_column(df: DataFrame, name: str) -> str:
    """Actual spelling of a column asked for in any case."""
    for candidate in df.columns:
        if candidate.lower() == name.lower():
            return candidate
    raise KeyError(name)


def optional(df: DataFrame | None, spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """The given table, or a typed empty one when it is absent."""
    return df if df is not None else spark.createDataFrame([], schema)


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys without a row; an empty result means full coverage."""
    keys = list(keys)
    return expected.select(*keys).distinct().join(actual.select(*keys), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def freshness(expected: DataFrame, actual: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Row count, latest date and latest value per expected key; keys without rows carry an error."""
    stats = actual.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(at).alias("latest_date"),
        F.max_by(value, at).alias("latest_value"),
    )
    return expected.select(key).distinct().join(stats, key, "left").select(
        key,
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "latest_date",
        "latest_value",
        F.when(F.col("row_count").isNull(), "no rows").alias("error"),
    )


def full_inputs_present(*tables: DataFrame | None) -> str:
    """``full`` when every optional layer is given, else ``core``."""
    return "full" if all(t is not None for t in tables) else "core"


def with_layers(base: DataFrame, layers: dict[str, tuple[DataFrame | None, str]], keys: Sequence[str], mode: str = "auto") -> DataFrame:
    """Left joins of optional layers (table or None, schema of its columns without the keys).

    ``core`` joins none, ``full`` needs them all, ``auto`` joins those that are there; columns of a
    layer that is not joined are null, so the result has the same columns in every mode.
    """
    if mode not in ("core", "full", "auto"):
        raise ValueError(f"no such mode: {mode}")
    absent = [name for name, (table, _) in layers.items() if table is None]
    if mode == "full" and absent:
        raise ValueError(f"full mode lacks layers: {', '.join(absent)}")
    for table, schema in layers.values():
        fields = T.StructType.fromDDL(schema).fields
        if mode == "core" or table is None:
            base = base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields})
        else:
            base = base.join(table.select(*keys, *[F.col(f.name).cast(f.dataType) for f in fields]), list(keys), "left")
    return base
