"""Instrument universe: names, filters, sectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: names treated as market indices.
INDEX_NAMES = r"VNINDEX|VN30|VN100"
DEFAULT_SECTOR = "Unknown"


def normalize_names(raw: DataFrame, name: str, position: str, keep_indices: bool = False) -> DataFrame:
    """Trimmed upper-case names, blanks dropped, first position kept of repeated ones."""
    clean = raw.select(F.upper(F.trim(name)).alias("ticker"), position).filter("ticker <> ''")
    if not keep_indices:
        clean = clean.filter(~F.col("ticker").rlike(INDEX_NAMES))
    return clean.groupBy("ticker").agg(F.min(position).alias("first_position"))


def resolve_universe(mapped: DataFrame, held: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Mapped instruments limited to the allow-list; without one, held instruments are added."""
    if allow is not None:
        return mapped.select("ticker").join(allow.select("ticker"), "ticker", "left_semi").distinct()
    return mapped.select("ticker").unionByName(held.select("ticker")).distinct()


def assign_sector(tickers: DataFrame, sectors: DataFrame, default: str = DEFAULT_SECTOR) -> DataFrame:
    """Sector by lookup or the default, and whether a lookup is still needed."""
    joined = tickers.join(sectors, "ticker", "left")
    known = F.col("sector").isNotNull() & (F.col("sector") != "") & (F.col("sector") != default)
    return joined.select(
        "ticker",
        F.when(F.col("sector").isNull() | (F.col("sector") == ""), default).otherwise(F.col("sector")).alias("sector"),
        F.when(known, "cached").otherwise("missing").alias("lookup"),
    )


def add_with_copied_sector(universe: DataFrame, extra: DataFrame, copy_from: str) -> DataFrame:
    """Force extra instruments in; those without a sector take the first non-empty of their sources.

    ``extra`` has ``ticker`` and the array ``copy_from`` of source instruments in order.
    """
    wanted = extra.select("ticker", F.posexplode(copy_from).alias("pos", "source"))
    sources = universe.select(F.col("ticker").alias("source"), F.col("sector").alias("copied"))
    copied = (
        wanted.join(sources, "source")
        .filter("copied is not null and copied <> ''")
        .groupBy("ticker")
        .agg(F.min_by("copied", "pos").alias("copied"))
    )
    everyone = universe.select("ticker", "sector").unionByName(
        extra.join(universe, "ticker", "left_anti").select("ticker", F.lit(None).cast("string").alias("sector"))
    )
    return everyone.join(copied, "ticker", "left").select(
        "ticker", F.coalesce("copied", "sector").alias("sector")
    )


def override_reference(bars: DataFrame, overrides: DataFrame) -> DataFrame:
    """Reference price per instrument: a castable override, else the last close."""
    last = bars.groupBy("ticker").agg(F.max_by("close", "date").alias("last_close"))
    ref = overrides.select("ticker", F.col("ref").try_cast("double").alias("ref")).filter("ref is not null")
    return last.join(ref, "ticker", "left").select(
        "ticker", "last_close", F.coalesce("ref", "last_close").alias("reference"), F.col("ref").isNotNull().alias("overridden")
    )


def weakness(
    rsi_max: float | None = 25.0,
    near_low_max: float | None = 2.0,
    ret20_max: float | None = -15.0,
    ret60_max: float | None = -25.0,
    below_averages: bool = True,
    adv_max: float | None = None,
    require_all: bool = True,
) -> Column:
    """Predicate for weak instruments, all or any of the active conditions; null counts as not met."""
    parts: list[Column] = []
    for name, limit in (
        ("rsi14", rsi_max),
        ("pct_to_low", near_low_max),
        ("ret20", ret20_max),
        ("ret60", ret60_max),
        ("adv20", adv_max),
    ):
        if limit is not None:
            parts.append(F.col(name) <= limit)
    if below_averages:
        parts.append((F.col("last") < F.col("sma50")) & (F.col("last") < F.col("sma200")))
    parts = [F.coalesce(p, F.lit(False)) for p in parts]
    out = parts[0] if parts else F.lit(False)
    for p in parts[1:]:
        out = (out & p) if require_all else (out | p)
    return out


def shortlist(snapshot: DataFrame, drop: Column, keep: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Instruments that stay: not weak or kept by name, and not excluded by name."""
    stays = ~drop
    if keep:
        stays = stays | F.col("ticker").isin(*keep)
    if exclude:
        stays = stays & ~F.col("ticker").isin(*exclude)
    return snapshot.filter(stays)
