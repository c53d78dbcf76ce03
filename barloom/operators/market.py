"""Market-wide and sector aggregates of the latest state, portfolio exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import correlation, clamp, flag, full_frame, full_max, full_mean, full_min, non_zero, ordered, return_pct
from barloom.functions.ranks import add_rank
from barloom.functions.smoothing import with_atr
from barloom.operators.panel import INDEX_KEY, one_series


def share(condition: Column, valid: Column) -> Column:
    """Percent of valid rows that meet the condition."""
    return F.avg(F.when(valid, condition.cast("int"))) * 100.0


def index_range_metrics(index: DataFrame, windows: Sequence[int] = (20, 60, 120)) -> DataFrame:
    """One row: position, distances, drawdown and rebound of the last close per window."""
    w = ordered(INDEX_KEY)
    c = F.col("close")
    rows = one_series(index).withColumns(
        {
            **{f"hi{n}": full_max(c, w, n) for n in windows},
            **{f"lo{n}": full_min(c, w, n) for n in windows},
        }
    )
    last = rows.groupBy(INDEX_KEY).agg(F.max_by(F.struct("close", *[f"{s}{n}" for n in windows for s in ("hi", "lo")]), "date").alias("r"))
    last = last.select("r.*")
    out = []
    for n in windows:
        hi, lo = F.col(f"hi{n}"), F.col(f"lo{n}")
        pos = F.when(hi == lo, 0.5).otherwise((c - lo) / non_zero(hi - lo))
        out += [
            F.when(hi.isNotNull(), clamp(pos, 0.0, 1.0)).alias(f"range_pos{n}"),
            ((hi - c) / non_zero(c) * 100.0).alias(f"to_upper{n}"),
            ((c - lo) / non_zero(c) * 100.0).alias(f"to_lower{n}"),
            return_pct(c, hi).alias(f"drawdown{n}"),
            return_pct(c, lo).alias(f"rebound{n}"),
        ]
    return last.select(*out)


def regime_history(bars: DataFrame, index: DataFrame) -> DataFrame:
    """(date, new_high20_pct, atr_pct_rank) for every date.

    new_high20_pct: share of instruments at their 20-row high; atr_pct_rank: how high the index's
    ATR percent ranks among all dates up to that one, null for the first 19. One index value per
    trading day bounds the list behind the rank.
    """
    high = full_frame(F.max, F.col("close"), ordered("ticker"), 20)
    shares = bars.select("date", "close", high.alias("hi20")).groupBy("date").agg(
        (F.avg(F.when(F.col("hi20").isNotNull(), (F.col("close") >= F.col("hi20")).cast("int"))) * 100.0).alias("new_high20_pct")
    )
    seen = ordered(INDEX_KEY).rowsBetween(Window.unboundedPreceding, 0)
    ranks = (
        with_atr(one_series(index), 14, "atr14", key=INDEX_KEY)
        .withColumn("atr_pct", F.col("atr14") / non_zero("close") * 100.0)
        .withColumn("past", F.collect_list("atr_pct").over(seen))
        .withColumn("n", F.count(F.lit(1)).over(seen))
    )
    below = F.size(F.filter("past", lambda x: x <= F.col("atr_pct")))
    ranks = ranks.select("date", F.when(F.col("n") >= 20, below * 100.0 / F.col("n")).alias("atr_pct_rank"))
    return shares.join(ranks, "date", "left")


def index_regime(index: DataFrame) -> DataFrame:
    """One row: Bull, Bear or Sideway, and how high today's ATR percent ranks in its history."""
    w = ordered(INDEX_KEY)
    rows = with_atr(one_series(index), 14, "atr14", key=INDEX_KEY).withColumns(
        {
            "sma50": full_mean("close", w, 50),
            "sma200": full_mean("close", w, 200),
            "atr_pct": F.col("atr14") / non_zero("close") * 100.0,
        }
    )
    rows = rows.withColumn(
        "last_atr", F.last("atr_pct").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    last = rows.groupBy(INDEX_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("close", "sma50", "sma200"), "date").alias("r"),
        (F.avg((F.col("atr_pct") <= F.col("last_atr")).cast("int")) * 100.0).alias("rank"),
    )
    bull = (F.col("r.close") > F.col("r.sma50")) & (F.col("r.sma50") > F.col("r.sma200"))
    bear = (F.col("r.close") < F.col("r.sma50")) & (F.col("r.sma50") < F.col("r.sma200"))
    enough = F.col("n") >= 20
    return last.select(
        F.when(enough, F.when(bull, "Bull").when(bear, "Bear").otherwise("Sideway")).alias("regime"),
        F.when(enough, F.col("rank")).alias("atr_pct_rank"),
    )


def comovement(bars: DataFrame, index: DataFrame, n: int = 20) -> DataFrame:
    """Per instrument over its last ``n`` paired returns: same-sign share, correlation, beta."""
    w, wi = ordered("ticker"), ordered(INDEX_KEY)
    i = one_series(index).select("date", (F.col("close") / non_zero(F.lag("close").over(wi)) - 1).alias("ir"))
    pairs = (
        bars.select("ticker", "date", (F.col("close") / non_zero(F.lag("close").over(w)) - 1).alias("r"))
        .join(i, "date")
        .filter("r is not null and ir is not null")
    )
    newest = Window.partitionBy("ticker").orderBy(F.desc("date"))
    tail = pairs.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    usable = (F.count(F.lit(1)) >= 5) & (F.var_samp("ir") > 0)
    same = (F.col("r") > 0) == (F.col("ir") > 0)
    return tail.groupBy("ticker").agg(
        (F.avg(same.cast("int")) * 100.0).alias("comove20"),
        F.when(usable, correlation("r", "ir")).alias("corr20"),
        F.when(usable, F.covar_samp("r", "ir") / non_zero(F.var_samp("ir"))).alias("beta20"),
    )


def breadth_summary(bars: DataFrame, index: DataFrame, basket: DataFrame | None = None, small: int = 3) -> DataFrame:
    """One row of market breadth on the latest date.

    Percentages count only instruments with a value. A universe of at most ``small``
    instruments is judged by the benchmark ``basket`` when one is given.
    """
    w = ordered("ticker")
    c = F.col("close")
    day = bars.agg(F.max("date")).scalar()
    rows = bars.select(
        "ticker",
        "date",
        "close",
        *[full_mean(c, w, n).alias(f"m{n}") for n in (20, 50, 200)],
        full_frame(F.max, c, w, 20).alias("hi20"),
        full_frame(F.min, c, w, 20).alias("lo20"),
        *[(c / non_zero(F.lag(c, n).over(w)) - 1).alias(f"r{n}") for n in (1, 5, 20)],
    )
    everyone = bars.agg(F.count_distinct("ticker")).scalar()
    latest = rows.filter(F.col("date") == day)
    source = F.lit("working_universe")
    if basket is not None:
        member = basket.select("ticker", F.lit(True).alias("_member"))
        latest = latest.join(member, "ticker", "left").filter((everyone > small) | F.col("_member"))
        source = F.when(everyone > small, "working_universe").otherwise("benchmark_basket")
    up, down = F.count(F.when(F.col("r1") > 0, 1)), F.count(F.when(F.col("r1") < 0, 1))
    wide = latest.agg(
        F.max("date").alias("date"),
        F.count(F.lit(1)).alias("breadth_count"),
        *[share(c > F.col(f"m{n}"), F.col(f"m{n}").isNotNull()).alias(f"above_sma{n}_pct") for n in (20, 50, 200)],
        *[share(F.col(f"r{n}") > 0, F.col(f"r{n}").isNotNull()).alias(f"positive{n}_pct") for n in (1, 5)],
        F.when(down == 0, F.nullif(up, F.lit(0)).cast("double")).otherwise(up / non_zero(down)).alias("advance_decline"),
        share(c >= F.col("hi20"), F.col("hi20").isNotNull()).alias("new_high20_pct"),
        share(c <= F.col("lo20"), F.col("lo20").isNotNull()).alias("new_low20_pct"),
        (F.stddev_samp("r20") * 100.0).alias("dispersion20"),
    )
    moves = comovement(bars, index).agg(
        F.struct(F.avg("comove20").alias("comove20"), F.median("corr20").alias("median_corr20"))
    )
    ranges = index_range_metrics(index)
    regime = index_regime(index)
    return (
        wide.withColumns(
            {
                "universe_count": everyone,
                "breadth_source": source,
                "_m": moves.scalar(),
                "_r": ranges.select(F.struct(*ranges.columns)).scalar(),
                "_g": regime.select(F.struct("regime", "atr_pct_rank")).scalar(),
            }
        )
        .select("*", "_m.*", "_r.*", "_g.*")
        .drop("_m", "_r", "_g", "drawdown20", "rebound20", "drawdown120", "rebound120")
    )


def relative_strength(snap: DataFrame, index: DataFrame) -> DataFrame:
    """Returns against the index and their percent ranks, ties averaged."""
    w = ordered(INDEX_KEY)
    c = F.col("close")
    i = one_series(index).select(
        INDEX_KEY, "date", *[return_pct(c, F.lag(c, n).over(w)).alias(f"r{n}") for n in (20, 60)]
    )
    i = i.groupBy(INDEX_KEY).agg(F.max_by(F.struct("r20", "r60"), "date").alias("r")).select("r")
    out = snap.withColumn("_r", i.scalar())
    out = out.withColumns({f"rel{n}": F.col(f"ret{n}") - F.col(f"_r.r{n}") for n in (20, 60)}).drop("_r")
    for n in (20, 60):
        out = add_rank(out, f"rel{n}", {"average_pct": f"rel{n}_rank"})
    return out


def sector_summary(members: DataFrame) -> DataFrame:
    """Per sector over one-row-per-instrument input; null counts as not met and stays in the base."""
    def met(name: str) -> Column:
        return F.avg(flag(F.col(name) > 0)) * 100.0

    out = members.groupBy("sector").agg(
        F.count(F.lit(1)).alias("members"),
        met("dist_sma20_pct").alias("breadth20"),
        met("dist_sma50_pct").alias("breadth50"),
        met("ret5").alias("positive5"),
        *[F.median(c).alias(f"median_{c}") for c in ("ret5", "ret20", "ret60", "rel20", "rel60")],
        F.avg("comove20").alias("mean_comove20"),
        *[F.median(c).alias(f"median_{c}") for c in ("foreign_value_5d", "foreign_value_20d", "prop_value_5d", "prop_value_20d")],
        F.nullif(F.sum("adv20"), F.lit(0.0)).alias("adtv"),
    )
    return add_rank(out, "adtv", {"min_pct": "adtv_rank_pct"}, descending=True)


def sector_regimes(members: DataFrame, limit: float = 1.0) -> DataFrame:
    """Bull, Bear or Sideway by the median 20-day return, and the liquidity rank."""
    out = members.groupBy("sector").agg(
        F.median("ret20").alias("median_ret20"), F.nullif(F.sum("adv20"), F.lit(0.0)).alias("adtv")
    )
    tag = F.when(F.col("median_ret20") >= limit, "Bull").when(F.col("median_ret20") <= -limit, "Bear").otherwise("Sideway")
    return add_rank(out.withColumn("regime", tag), "adtv", {"min_pct": "adtv_rank_pct"}, descending=True)


def position_report(positions: DataFrame, prices: DataFrame, default_sector: str = "Unknown") -> DataFrame:
    """Open positions with market value, cost, profit and profit ratio."""
    held = positions.filter("quantity <> 0").groupBy("ticker", "sector").agg(
        F.sum("quantity").alias("quantity"),
        (F.sum(F.col("quantity") * F.col("avg_price")) / non_zero(F.sum("quantity"))).alias("avg_price"),
    )
    out = held.join(prices.select("ticker", "last"), "ticker", "left").withColumns(
        {
            "sector": F.coalesce("sector", F.lit(default_sector)),
            "market_value": F.col("quantity") * F.coalesce("last", F.lit(0.0)),
            "cost": F.col("quantity") * F.coalesce("avg_price", F.lit(0.0)),
        }
    )
    return out.withColumn("unrealized", F.col("market_value") - F.col("cost")).withColumn(
        "pnl", F.col("unrealized") / non_zero("cost")
    )


def sector_exposure(report: DataFrame) -> DataFrame:
    total = report.agg(F.sum("market_value")).scalar()
    return report.groupBy("sector").agg(
        F.sum("market_value").alias("market_value"), F.sum("cost").alias("_cost")
    ).select(
        "sector",
        "market_value",
        F.coalesce(F.col("market_value") / non_zero(total), F.lit(0.0)).alias("weight"),
        ((F.col("market_value") - F.col("_cost")) / non_zero("_cost")).alias("pnl"),
    )


def book_weights(dataset: DataFrame, report: DataFrame) -> DataFrame:
    """Position fields on the snapshot: share of volume, ATR at risk, weights, beta contribution."""
    held = report.select("ticker", "quantity", "avg_price", "market_value", "cost", "unrealized", "pnl")
    total = report.agg(F.sum("market_value")).scalar()
    rows = dataset.join(held, "ticker", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("quantity", "market_value", "cost", "unrealized")}
    )
    rows = rows.withColumns(
        {
            "position_pct_adv": F.col("quantity") / non_zero("adv20") * 100.0,
            "position_atr": F.col("atr14") * F.col("quantity"),
            "book_value": F.coalesce(total, F.lit(0.0)),
            "weight_pct": F.coalesce(F.col("market_value") / non_zero(total) * 100.0, F.lit(0.0)),
        }
    )
    sectors = rows.groupBy("sector").agg(F.sum("weight_pct").alias("sector_weight_pct"))
    return rows.join(sectors, "sector", "left").withColumn(
        "beta_contribution", F.col("weight_pct") / 100.0 * F.coalesce("beta", F.lit(0.0))
    )


def enrich(dataset: DataFrame, *layers: DataFrame, prefer: DataFrame | None = None, fields: Sequence[str] = ()) -> DataFrame:
    """Left join optional layers by instrument; values of ``prefer`` win over existing ``fields``."""
    for layer in layers:
        dataset = dataset.join(layer, "ticker", "left")
    if prefer is not None:
        better = prefer.select("ticker", *[F.col(f).alias(f"_{f}") for f in fields])
        dataset = dataset.join(better, "ticker", "left")
        dataset = dataset.withColumns(
            {f: F.coalesce(f"_{f}", f) if f in dataset.columns else F.col(f"_{f}") for f in fields}
        ).drop(*[f"_{f}" for f in fields])
    return dataset


def benchmark_first(dataset: DataFrame, benchmarks: Sequence[str]) -> DataFrame:
    """Index rows first in the given order, then instruments by name."""
    place = F.lit(len(benchmarks))
    for i, name in reversed(list(enumerate(benchmarks))):
        place = F.when(F.col("ticker") == name, i).otherwise(place)
    return dataset.orderBy(place, "ticker")
