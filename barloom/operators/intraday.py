"""Intraday snapshots, session buckets, tape summary, burst follow-through."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import frames as R


@dataclass(frozen=True)
class SessionClock:
    """Trading day in minutes since midnight; defaults are the exchange's fixed times."""

    open: int = 9 * 60
    first_bucket: int = 9 * 60 + 45
    early_end: int = 10 * 60 + 30
    lunch: int = 11 * 60 + 30
    afternoon: int = 13 * 60
    pm_early_end: int = 13 * 60 + 45
    pm_late_end: int = 14 * 60 + 25
    total: int = 240

    def minute(self, ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    def bucket(self, ts: Column) -> Column:
        m = self.minute(ts)
        return (
            F.when(m < self.first_bucket, None)
            .when(m < self.early_end, "AM_EARLY")
            .when(m < self.lunch, "AM_LATE")
            .when(m < self.afternoon, "LUNCH_BREAK")
            .when(m < self.pm_early_end, "PM_EARLY")
            .when(m < self.pm_late_end, "PM_LATE")
        )

    def minutes_from_open(self, ts: Column) -> Column:
        """Trading minutes so far; the lunch break does not count."""
        m = self.minute(ts)
        morning = self.lunch - self.open
        return (
            F.when(m < self.lunch, m - self.open)
            .when(m < self.afternoon, morning)
            .otherwise(morning + m - self.afternoon)
            .cast("double")
        )


def _or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def intraday_snapshots(bars: DataFrame, clock: SessionClock = SessionClock(), every: int = 15) -> DataFrame:
    """Snapshot rows within each session: state so far, trailing windows, rest-of-session targets.

    Training snapshots fall on every ``every``-th minute inside a bucket and need later
    bars; of the latest day only its last bar counts. A day without a previous close is
    skipped. Frames never leave one instrument's day, so partitions stay small.
    """
    day = Window.partitionBy("ticker", "trade_date").orderBy("bar_ts")
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    later = day.rowsBetween(1, Window.unboundedFollowing)
    whole = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c, h, low, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    pm = F.col("_minute") >= clock.afternoon

    daily = bars.groupBy("ticker", "trade_date").agg(F.max_by("close", "bar_ts").alias("_dc"), F.sum("volume").alias("_dv"))
    dw = Window.partitionBy("ticker").orderBy("trade_date")
    twenty = dw.rowsBetween(-20, -1)
    daily = daily.select(
        "ticker",
        "trade_date",
        F.lag("_dc").over(dw).alias("prev_close"),
        F.when(F.count("_dv").over(twenty) == 20, F.avg("_dv").over(twenty)).alias("adv20"),
    )
    newest = bars.groupBy("ticker").agg(F.max("trade_date").alias("_newest"))

    def back(n: int) -> Column:
        return _or_zero(R.return_pct(c, F.lag(c, n).over(day)))

    def span(n: int) -> tuple[Column, Column]:
        frame = day.rowsBetween(-n, 0)
        return F.max(h).over(frame), F.min(low).over(frame)

    def position(x: Column, lo: Column, hi: Column) -> Column:
        return F.when(hi == lo, 0.5).otherwise((x - lo) / R.non_zero(hi - lo))

    h30, l30 = span(6)
    h60, l60 = span(12)
    rows = bars.withColumn("_minute", clock.minute(F.col("bar_ts"))).withColumns(
        {
            "bucket": clock.bucket(F.col("bar_ts")),
            "_later": F.count(c).over(later),
            "day_open": F.first("open").over(so_far),
            "hi": F.max(h).over(so_far),
            "lo": F.min(low).over(so_far),
            "vol": F.sum(v).over(so_far),
            "_pv": F.sum(c * v).over(so_far),
            "pm_open": F.first(F.when(pm, F.col("open")), ignorenulls=True).over(so_far),
            "pm_vol": F.coalesce(F.sum(F.when(pm, v)).over(so_far), F.lit(0)),
            "day_close": F.last(c).over(whole),
            "next_hi": F.max(h).over(later),
            "next_lo": F.min(low).over(later),
            **{f"last{5 * n}m": back(n) for n in (1, 3, 6, 12)},
            "_h30": h30, "_l30": l30, "_h60": h60, "_l60": l60,
        }
    )
    rows = rows.join(daily, ["ticker", "trade_date"]).join(newest, "ticker").filter("prev_close is not null and bucket is not null")
    is_new = F.col("trade_date") == F.col("_newest")
    rows = rows.filter(
        (is_new & (F.col("_later") == 0)) | (~is_new & (F.minute("bar_ts") % every == 0) & (F.col("_later") > 0))
    )
    from_open = clock.minutes_from_open(F.col("bar_ts"))
    vwap = F.coalesce(F.col("_pv") / R.non_zero("vol"), c)
    prev = F.col("prev_close")
    return rows.withColumn("vwap", vwap).select(
        "ticker",
        "trade_date",
        "bar_ts",
        "bucket",
        c.alias("snapshot_close"),
        "day_open",
        F.col("hi").alias("session_high"),
        F.col("lo").alias("session_low"),
        F.col("vol").alias("session_volume"),
        "vwap",
        _or_zero(R.return_pct("day_open", prev)).alias("gap_pct"),
        _or_zero(R.return_pct(c, "day_open")).alias("open_to_snapshot_pct"),
        "last5m", "last15m", "last30m", "last60m",
        _or_zero(R.ratio_pct(F.col("_h30") - F.col("_l30"), prev)).alias("range30m_pct"),
        _or_zero(R.ratio_pct(F.col("_h60") - F.col("_l60"), prev)).alias("range60m_pct"),
        position(c, F.col("_l30"), F.col("_h30")).alias("pos30m"),
        position(c, F.col("_l60"), F.col("_h60")).alias("pos60m"),
        _or_zero(R.ratio_pct(F.col("hi") - F.col("lo"), prev)).alias("session_range_pct"),
        position(c, F.col("lo"), F.col("hi")).alias("pos_session"),
        _or_zero(R.return_pct(c, "vwap")).alias("vwap_dev_pct"),
        _or_zero(R.ratio_pct("vol", "adv20")).alias("volume_pct_adv20"),
        _or_zero(R.return_pct(c, "hi")).alias("to_high_pct"),
        _or_zero(R.return_pct(c, "lo")).alias("to_low_pct"),
        from_open.alias("minutes_from_open"),
        F.greatest(clock.total - from_open, F.lit(0.0)).alias("minutes_to_close"),
        (from_open / clock.total * 100.0).alias("progress_pct"),
        _or_zero(R.return_pct(c, "pm_open")).alias("pm_ret_pct"),
        _or_zero(R.ratio_pct("pm_vol", "adv20")).alias("pm_volume_pct_adv20"),
        F.when(F.col("_later") > 0, R.return_pct("day_close", c)).alias("target_close"),
        F.when(F.col("_later") > 0, R.return_pct("next_hi", c)).alias("target_high"),
        F.when(F.col("_later") > 0, R.return_pct("next_lo", c)).alias("target_low"),
    )


KEYS = ("trade_date", "bar_ts", "bucket")
RELATIVE = ("open_to_snapshot_pct", "last15m", "last60m", "vwap_dev_pct", "volume_pct_adv20", "pm_ret_pct")
TARGETS = ("target_close", "target_high", "target_low")


def snapshot_sample(own: DataFrame, index: DataFrame) -> DataFrame:
    """Instrument snapshots with the index snapshot of the same moment and relative features.

    Features that are missing count 0; targets stay null.
    """
    skip = {"ticker", *KEYS, *TARGETS}
    other = index.select(*KEYS, *[F.col(c).alias(f"i_{c}") for c in index.columns if c not in skip])
    rows = own.join(other, list(KEYS)).withColumns(
        {f"rel_{c}": F.col(c) - F.col(f"i_{c}") for c in RELATIVE}
    )
    keep = {"ticker", *KEYS, *TARGETS}
    return rows.fillna(0, subset=[c for c in rows.columns if c not in keep])


def duplicate_snapshots(rows: DataFrame) -> DataFrame:
    """Snapshot keys that occur more than once; must be empty before a one-to-one join."""
    return rows.groupBy("ticker", *KEYS).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


# Checkpoints of the session.
CHECKPOINTS = ("09:15", "09:45", "10:30", "11:00", "13:15", "14:00", "14:25", "14:45")


def latest_session(bars: DataFrame) -> DataFrame:
    newest = bars.groupBy("ticker").agg(F.max("trade_date").alias("trade_date"))
    return bars.join(newest, ["ticker", "trade_date"], "left_semi")


def checkpoints(session: DataFrame, times: Sequence[str] = CHECKPOINTS) -> DataFrame:
    """Price, return from the open and volume so far as of each checkpoint.

    Each bar is emitted only for checkpoints it may serve, then one aggregate per checkpoint.
    """
    at = F.date_format("bar_ts", "HH:mm")
    reached = F.filter(F.array(*[F.lit(t) for t in times]), lambda t: t >= at)
    opening = session.groupBy("ticker").agg(F.min_by("open", "bar_ts").alias("_open"))
    return (
        session.withColumn("checkpoint", F.explode(reached))
        .groupBy("ticker", "checkpoint")
        .agg(F.max_by("close", "bar_ts").alias("close"), F.sum("volume").alias("volume_so_far"))
        .join(opening, "ticker")
        .select("ticker", "checkpoint", "close", R.return_pct("close", "_open").alias("from_open_pct"), "volume_so_far")
    )


def _session_stats(session: DataFrame) -> DataFrame:
    """One row per instrument of its latest session."""
    day = Window.partitionBy("ticker").orderBy("bar_ts")
    rows = session.withColumn("_i", F.row_number().over(day)).withColumn("_at", F.date_format("bar_ts", "HH:mm"))
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3.0
    first = F.struct(-F.col("bar_ts").cast("timestamp").cast("double"))
    return rows.groupBy("ticker").agg(
        F.min_by("open", "bar_ts").alias("open"),
        F.max_by("close", "bar_ts").alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("_at", F.struct("high", first)).alias("high_at"),
        F.min_by("_at", F.struct("low", "bar_ts")).alias("low_at"),
        (F.sum(typical * F.col("volume")) / R.non_zero(F.sum("volume"))).alias("vwap"),
        F.max(F.when(F.col("_i") <= 6, F.col("high"))).alias("_drive_high"),
        F.min_by("open", F.when(F.col("_at") >= "13:00", F.col("bar_ts"))).alias("_pm_open"),
    ).withColumn("pm_ret_pct", R.return_pct("close", F.coalesce("_pm_open", "open")))


def tape_summary(bars: DataFrame, index_bars: DataFrame) -> DataFrame:
    """Latest session per instrument: shape, fade, squeeze failure, bias against the index."""
    own = _session_stats(latest_session(bars))
    index_pm = _session_stats(latest_session(index_bars)).select("pm_ret_pct").scalar()
    rows = own.withColumns(
        {
            "close_in_range_pct": (F.col("close") - F.col("low")) / R.non_zero(F.col("high") - F.col("low")) * 100.0,
            "fade_pct": R.return_pct("close", "high"),
            "vs_vwap_pct": R.return_pct("close", "vwap"),
            "drive_pct": R.return_pct("_drive_high", "open"),
            "pm_excess_pct": F.col("pm_ret_pct") - index_pm,
        }
    )
    squeeze = (
        (F.col("drive_pct") >= 1.5)
        & (F.col("fade_pct") <= -2.0)
        & (F.col("close_in_range_pct") <= 35.0)
        & (F.substring("high_at", 1, 2).cast("int") < 11)
    )
    in_range, vs_vwap, excess = F.col("close_in_range_pct"), F.col("vs_vwap_pct"), F.col("pm_excess_pct")
    bias = (
        F.when((in_range <= 35) & (vs_vwap < 0) & (excess <= -0.5), "distribution")
        .when((in_range >= 65) & (vs_vwap >= 0) & (excess >= 0.5), "absorption")
        .otherwise("neutral")
    )
    rows = rows.withColumns({"squeeze_failure": F.coalesce(squeeze, F.lit(False)), "bias": bias})
    failed = F.col("squeeze_failure")
    return rows.withColumns(
        {
            "burst_bias": F.when(failed, "failed_followthrough")
            .when(F.col("bias") == "distribution", "respect_t25_supply")
            .when(F.col("bias") == "absorption", "respect_day2_followthrough")
            .otherwise("neutral"),
            "trim": F.when(failed | (F.col("bias") == "distribution"), "high")
            .when(F.col("bias") == "absorption", "light")
            .otherwise("moderate"),
        }
    ).drop("_drive_high", "_pm_open")


def burst_patterns(bars: DataFrame, day: float = 6.5, two_day: float = 10.0, least: int = 25) -> DataFrame:
    """Follow-through after strong up-days per instrument, and the age of the latest one."""
    w = R.ordered("ticker")
    c = F.col("close")
    rows = bars.withColumns(
        {
            "_r1": R.change_pct(c, w, 1),
            "_r2": R.change_pct(c, w, 2),
            "_n1": R.forward_pct(c, w, 1),
            "_n3": R.forward_pct(c, w, 3),
            "_low3": R.return_pct(R.forward_min("low", w, 3), c),
            "_i": F.row_number().over(w),
        }
    )
    hit = F.coalesce(F.col("_r1") >= day, F.lit(False)) | F.coalesce(F.col("_r2") >= two_day, F.lit(False))

    def rate(x: str, cond: Column) -> Column:
        return F.avg(F.when(hit & F.col(x).isNotNull(), cond.cast("int"))) * 100.0

    enough = F.count(F.lit(1)) >= least
    stats = {
        "next_positive_pct": rate("_n1", F.col("_n1") > 0),
        "next_strong_pct": rate("_n1", F.col("_n1") >= 3),
        "third_negative_pct": rate("_n3", F.col("_n3") < 0),
        "drawdown3_pct": F.avg(F.when(hit & F.col("_n3").isNotNull(), F.col("_low3"))),
        "signal_age": (F.max("_i") - F.max(F.when(hit, F.col("_i")))).cast("long"),
    }
    return rows.groupBy("ticker").agg(
        F.when(enough, F.count(F.when(hit, 1))).otherwise(0).alias("samples"),
        *[F.when(enough, x).alias(n) for n, x in stats.items()],
    )
