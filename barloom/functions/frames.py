"""Row-frame helpers: full frames, lags, forward frames, ranks inside a frame.

Every helper returns a Column over the caller's window spec, so features that share a
key are evaluated by one window operator after one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ordered(keys: Iterable[str] | str, order: Iterable[str] | str = "date") -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def full_frame(
    agg: Callable[[Column], Column], x: ColumnLike, w: WindowSpec, n: int, shift: int = 0
) -> Column:
    """``agg`` over the last ``n`` rows (ending ``shift`` rows back); null until n non-null rows."""
    frame = w.rowsBetween(-(n - 1) - shift, -shift)
    x = col(x)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def full_mean(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    return full_frame(F.avg, x, w, n)


def full_std(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    return full_frame(F.stddev_samp, x, w, n)


def full_min(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    return full_frame(F.min, x, w, n)


def full_max(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    return full_frame(F.max, x, w, n)


def full_quantile(x: ColumnLike, w: WindowSpec, n: int, q: float, shift: int = 0) -> Column:
    """Interpolated quantile over a full frame.

    The frame holds exactly ``n`` values, so the two neighbours of the quantile sit at fixed
    places of the sorted frame; one sort per row, shared by all quantiles of the column.
    """
    place = (n - 1) * q
    low = int(place)
    values = F.sort_array(F.collect_list(col(x)).over(w.rowsBetween(-(n - 1) - shift, -shift)))
    below = F.get(values, F.lit(low))
    above = F.get(values, F.lit(min(low + 1, n - 1)))
    return F.when(F.size(values) == n, below + (above - below) * (place - low))


def non_zero(x: ColumnLike) -> Column:
    return F.nullif(col(x), F.lit(0))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    return col(a) / non_zero(b)


def ratio_pct(a: ColumnLike, b: ColumnLike) -> Column:
    return col(a) / non_zero(b) * 100.0


def return_pct(a: ColumnLike, b: ColumnLike) -> Column:
    return (col(a) / non_zero(b) - 1.0) * 100.0


def change_pct(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    """Percent change against the value ``n`` rows earlier."""
    return return_pct(x, F.lag(col(x), n).over(w))


def forward_pct(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    """Percent change to the value ``n`` rows later."""
    return return_pct(F.lead(col(x), n).over(w), x)


def range_position(x: ColumnLike, w: WindowSpec, n: int) -> Column:
    low, high = full_min(x, w, n), full_max(x, w, n)
    return (col(x) - low) / non_zero(high - low)


def forward_max(x: ColumnLike, w: WindowSpec, n: int, start: int = 1) -> Column:
    return F.max(col(x)).over(w.rowsBetween(start, n))


def forward_min(x: ColumnLike, w: WindowSpec, n: int, start: int = 1) -> Column:
    return F.min(col(x)).over(w.rowsBetween(start, n))


def correlation(x: ColumnLike, y: ColumnLike, frame: WindowSpec | None = None) -> Column:
    """Correlation of the complete pairs; null (not an error) when either side does not vary."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    parts = [F.covar_samp(x, y), F.stddev_samp(F.when(both, x)), F.stddev_samp(F.when(both, y))]
    if frame is not None:
        parts = [p.over(frame) for p in parts]
    return parts[0] / non_zero(parts[1] * parts[2])


def paired_corr(x: ColumnLike, y: ColumnLike, w: WindowSpec, n: int) -> Column:
    """Correlation over a full frame of pairs."""
    x, y = col(x), col(y)
    frame = w.rowsBetween(-(n - 1), 0)
    both = x.isNotNull() & y.isNotNull()
    return F.when(F.count(F.when(both, 1)).over(frame) == n, correlation(x, y, frame))


def paired_beta(x: ColumnLike, y: ColumnLike, w: WindowSpec, n: int) -> Column:
    """Slope of ``x`` on ``y`` over a full frame of pairs; zero variance gives null."""
    x, y = col(x), col(y)
    frame = w.rowsBetween(-(n - 1), 0)
    both = x.isNotNull() & y.isNotNull()
    slope = F.covar_samp(x, y).over(frame) / non_zero(F.var_samp(y).over(frame))
    return F.when(F.count(F.when(both, 1)).over(frame) == n, slope)


def adaptive_threshold(
    x: ColumnLike, w: WindowSpec, n: int, q: float, floor: float, spread: float = 1.0
) -> Column:
    """max(rolling quantile, rolling std times ``spread``) of |x| over the n rows before this one."""
    size = F.abs(col(x))
    quantile = full_quantile(size, w, n, q, shift=1)
    scatter = full_frame(F.stddev_samp, size, w, n, shift=1) * spread
    limit = F.greatest(quantile, scatter)
    return F.when(limit.isNotNull(), F.greatest(limit, F.lit(floor)))


def lower_quantile_threshold(x: ColumnLike, w: WindowSpec, n: int, q: float, floor: float) -> Column:
    limit = full_quantile(x, w, n, q, shift=1)
    return F.when(limit.isNotNull(), F.greatest(limit, F.lit(floor)))


def three_state(x: ColumnLike, limit: ColumnLike) -> Column:
    """+1 at or above the limit, -1 at or below its negative, else 0."""
    x, limit = col(x), col(limit)
    return F.when(x >= limit, 1.0).when(x <= -limit, -1.0).otherwise(0.0)


def streak_state(x: ColumnLike, w: WindowSpec, n: int = 2) -> Column:
    """+1 (-1) when each of the last ``n`` rows is positive (negative)."""
    x = col(x)
    frame = w.rowsBetween(-(n - 1), 0)
    ups = F.count(F.when(x > 0, 1)).over(frame)
    downs = F.count(F.when(x < 0, 1)).over(frame)
    return F.when(downs == n, -1.0).when(ups == n, 1.0).otherwise(0.0)


def average_rank_pct(x: ColumnLike, by: Iterable[str] | str) -> Column:
    """Rank in percent with ties averaged, among the non-null rows of ``by``.

    Meant for groups whose size the universe bounds (one row per instrument and date);
    :mod:`barloom.functions.ranks` serves groups without such a bound.
    """
    x = col(x)
    by = [by] if isinstance(by, str) else list(by)
    group = Window.partitionBy(*by)
    rising = group.orderBy(x.asc_nulls_last())
    ties = F.count(x).over(rising.rangeBetween(0, 0))
    rank = F.rank().over(rising) + (ties - 1) / 2.0
    return F.when(x.isNotNull(), rank / F.count(x).over(group) * 100.0)


def clamp(x: ColumnLike, low: float | Column | None, high: float | Column | None) -> Column:
    """Limit to the bounds; a null bound does not limit and a null value stays null."""
    x = col(x)
    out = x
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(x.isNotNull(), out)


def scale_100(x: ColumnLike, low: float, high: float) -> Column:
    """Clip to [low, high], then map linearly to 0..100."""
    return (clamp(x, low, high) - low) / (high - low) * 100.0


def flag(condition: Column) -> Column:
    """1.0 / 0.0 with null counted as false."""
    return F.when(condition, 1.0).otherwise(0.0)
