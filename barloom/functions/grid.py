"""The exchange's price grid: tick sizes, snapping, bands, ladders of ticks.

Snapping works on the exact decimal of the shortest text of a double, as steps per unit
(100, 20 or 10), so no binary rounding error can move a price to a neighbouring tick.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.frames import clamp

# Below 10 one cent, below 50 five cents, else ten cents; band of 7 % around reference.
BAND = 0.07


def steps_per_unit(x: Column) -> Column:
    return F.when(x < 10, 100).when(x < 50, 20).when(x.isNotNull(), 10)


def tick_size(x: Column) -> Column:
    return F.lit(1.0) / steps_per_unit(x)


def _steps(x: Column) -> Column:
    return x.cast("string").cast("decimal(24,14)") * steps_per_unit(x)


def round_to_tick(x: Column) -> Column:
    return F.round(_steps(x), 0).cast("double") / steps_per_unit(x)


def floor_to_tick(x: Column) -> Column:
    return F.floor(_steps(x)).cast("double") / steps_per_unit(x)


def ceil_to_tick(x: Column) -> Column:
    return F.ceil(_steps(x)).cast("double") / steps_per_unit(x)


def price_band(ref: Column) -> tuple[Column, Column]:
    """(floor, ceiling) allowed around a reference price, in order."""
    low, high = ceil_to_tick(ref * (1 - BAND)), floor_to_tick(ref * (1 + BAND))
    return F.least(low, high), F.greatest(low, high)


def next_level(price: Column, direction: int, low: Column, high: Column) -> Column:
    """One tick up or down from a price (its own tick size), snapped and kept in the band."""
    return clamp(round_to_tick(price + direction * tick_size(price)), low, high)


def ticks_between(upper: Column, lower: Column, tick: Column) -> Column:
    """Number of ticks from lower to upper; a negative distance counts 0."""
    gap = upper.cast("string").cast("decimal(24,14)") - lower.cast("string").cast("decimal(24,14)")
    per_unit = F.round(F.lit(1.0) / tick).cast("int")
    return F.greatest(gap * per_unit, F.lit(0)).cast("double")


def snap_and_clamp(x: Column, low: Column, high: Column) -> Column:
    return clamp(round_to_tick(x), low, high)
