"""Long (date, instrument) panels: returns, trend, breadth, ranks, sector support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.frames import (
    average_rank_pct,
    change_pct,
    flag,
    forward_min,
    forward_pct,
    full_mean,
    non_zero,
    ordered,
    paired_beta,
    paired_corr,
    range_position,
    scale_100,
    streak_state,
)


def mean_atr(true_range: str, w: WindowSpec, n: int = 14) -> Column:
    """ATR as a plain mean of true ranges."""
    return full_mean(true_range, w, n)


def mean_rsi(step: str, w: WindowSpec, n: int = 14) -> Column:
    """RSI from plain means of gains and losses."""
    c = F.col(step)
    gain = F.when(c.isNotNull(), F.greatest(c, F.lit(0)))
    loss = F.when(c.isNotNull(), F.greatest(-c, F.lit(0)))
    return 100.0 - 100.0 / (1.0 + full_mean(gain, w, n) / non_zero(full_mean(loss, w, n)))


INDEX_KEY = "symbol"


def one_series(index: DataFrame) -> DataFrame:
    """Tag a single index series so that its windows have a key."""
    return index if INDEX_KEY in index.columns else index.withColumn(INDEX_KEY, F.lit("INDEX"))


def index_features(index: DataFrame) -> DataFrame:
    """Returns, averages, range positions and outcomes of an index, one row per date, ``i_`` columns.

    An index has one row per trading day, so its size is bounded by the calendar.
    """
    w = ordered(INDEX_KEY)
    c = F.col("close")
    rows = one_series(index).withColumn("i_ret1", c / non_zero(F.lag(c).over(w)) - 1)
    return rows.select(
        "date",
        c.alias("i_close"),
        "i_ret1",
        *[(change_pct(c, w, n) / 100.0).alias(f"i_ret{n}") for n in (5, 20, 60)],
        *[full_mean(c, w, n).alias(f"i_sma{n}") for n in (20, 50, 200)],
        *[range_position(c, w, n).alias(f"i_range{n}") for n in (20, 60)],
        *[(forward_pct(c, w, n) / 100.0).alias(f"i_fwd{n}") for n in (5, 10)],
        (forward_min(c, w, 10) / non_zero(c) - 1).alias("i_dd10"),
        streak_state("i_ret1", w, 2).alias("i_streak"),
    )


def instrument_panel(bars: DataFrame, idx: DataFrame) -> DataFrame:
    """Per (instrument, date) trend, relative strength, co-movement and outcomes (fractions)."""
    w = ordered("ticker")
    c, v = F.col("close"), F.col("volume")
    near = idx.select("date", "i_ret1", "i_ret20", "i_ret60", "i_fwd5", "i_fwd10")
    rows = bars.select("ticker", "sector", "date", "close", "volume").join(near, "date", "left")
    rows = rows.withColumns(
        {
            **{f"ret{n}": c / non_zero(F.lag(c, n).over(w)) - 1 for n in (1, 5, 20, 60)},
            **{f"dist{n}": c / non_zero(full_mean(c, w, n)) - 1 for n in (20, 50, 100)},
            "vol_ratio20": v / non_zero(full_mean(v, w, 20)),
            **{f"fwd{n}": F.lead(c, n).over(w) / non_zero(c) - 1 for n in (5, 10)},
            "dd10": forward_min(c, w, 10) / non_zero(c) - 1,
        }
    )
    return rows.withColumns(
        {
            "rel20": F.col("ret20") - F.col("i_ret20"),
            "rel60": F.col("ret60") - F.col("i_ret60"),
            "corr20": paired_corr("ret1", "i_ret1", w, 20),
            "beta20": paired_beta("ret1", "i_ret1", w, 20),
            "excess5": F.col("fwd5") - F.col("i_fwd5"),
            "excess10": F.col("fwd10") - F.col("i_fwd10"),
        }
    ).drop("i_ret1", "i_ret20", "i_ret60", "i_fwd5", "i_fwd10")


def sector_panel(panel: DataFrame) -> DataFrame:
    """Per (date, sector): share above the 20-day average (null counts as below), median relative return, its rank."""
    rows = panel.groupBy("date", "sector").agg(
        (F.avg(flag(F.col("dist20") > 0)) * 100.0).alias("sector_breadth20"),
        F.median("rel20").alias("sector_rel20"),
    )
    return rows.withColumn("sector_rank", average_rank_pct("sector_rel20", "date"))


def feature_panel(panel: DataFrame) -> DataFrame:
    """Panel with cross-sectional ranks and the member's sector support."""
    ranked = panel.withColumns(
        {f"rel{n}_rank": average_rank_pct(f"rel{n}", "date") for n in (20, 60)}
    )
    return ranked.join(sector_panel(panel), ["date", "sector"], "left")


def market_panel(panel: DataFrame, sectors: DataFrame, idx: DataFrame) -> DataFrame:
    """Per date: breadth, dispersion, mean co-movement, sector leaders, and the index state."""
    wide = panel.groupBy("date").agg(
        *[
            (F.avg(flag(F.col(c) > 0)) * 100.0).alias(name)
            for c, name in (("dist20", "breadth20"), ("dist50", "breadth50"), ("ret5", "positive5"))
        ],
        (F.stddev_samp("ret20") * 100.0).alias("dispersion20"),
        (F.median("rel20") * 100.0).alias("median_rel20"),
        F.avg("corr20").alias("mean_corr20"),
        F.avg("beta20").alias("mean_beta20"),
        F.max(F.col("fwd10").isNotNull()).alias("has_outcome"),
    )
    leaders = sectors.groupBy("date").agg(
        F.count(F.when(F.col("sector_breadth20") >= 50, 1)).alias("leader_sectors"),
        F.count(F.when(F.col("sector_breadth20") <= 30, 1)).alias("weak_sectors"),
    )
    return idx.join(wide, "date").join(leaders, "date")


DEPLOY, WAIT, REDUCE = "DEPLOY", "WAIT", "REDUCE"
MARKET_RULES = ("engine_hybrid", "trend_breadth", "trend_stack", "exhaustion_overlay")


def _hybrid(deploy: Column, reduce: Column, wait: Column, known: Column) -> Column:
    """Largest score decides; ties go DEPLOY, REDUCE, WAIT; incomplete input waits."""
    top = F.greatest(deploy, reduce, wait)
    return F.when(~known, WAIT).when(deploy == top, DEPLOY).when(reduce == top, REDUCE).otherwise(WAIT)


def market_signals(market: DataFrame) -> DataFrame:
    """State of four market-timing rules per date."""
    close, sma20, sma50, sma200 = (F.col(c) for c in ("i_close", "i_sma20", "i_sma50", "i_sma200"))
    b20, b50, p5, pos = (F.col(c) for c in ("breadth20", "breadth50", "positive5", "i_range60"))
    bull = F.coalesce((close > sma50) & (sma50 > sma200), F.lit(False))
    bear = F.coalesce((close < sma50) & (sma50 < sma200), F.lit(False))
    known = pos.isNotNull() & b20.isNotNull() & b50.isNotNull() & p5.isNotNull()

    def pts(*cases: tuple[Column, float], default: float = 0.0) -> Column:
        out = None
        for cond, n in cases:
            out = F.when(cond, n) if out is None else out.when(cond, n)
        return out.otherwise(default)

    low, high = pos <= 0.25, pos >= 0.75
    strong, weak = (b20 >= 60) & (b50 >= 50), (b20 <= 35) & (b50 <= 35)
    deploy = (
        pts((bull, 35.0)) + pts((low & bear, 5.0), (low, 15.0)) + pts((strong, 20.0)) + pts((p5 >= 55, 10.0))
    )
    reduce = pts((bear, 35.0)) + pts((high, 15.0)) + pts((weak, 20.0)) + pts((p5 <= 40, 10.0))
    wait = (
        pts((bull | bear, 0.0), default=25.0)
        + pts((low, 5.0), (high, 0.0), default=10.0)
        + pts((strong | weak, 0.0), default=10.0)
        + pts(((p5 >= 55) | (p5 <= 40), 0.0), default=5.0)
    )

    def two_way(up: Column, down: Column) -> Column:
        return F.when(down, REDUCE).when(up, DEPLOY).otherwise(WAIT)

    return market.withColumns(
        {
            "engine_hybrid": _hybrid(deploy, reduce, wait, known),
            "trend_breadth": two_way(
                (close > sma20) & (b20 >= 55) & (b50 >= 45), (close < sma20) & (b20 <= 40) & (b50 <= 35)
            ),
            "trend_stack": two_way(
                (close > sma20) & (sma20 > sma50) & (b20 >= 50), (close < sma20) & (sma20 < sma50) & (b20 <= 40)
            ),
            "exhaustion_overlay": two_way(
                (close > sma20) & (b20 >= 60) & (p5 >= 55), (pos >= 0.85) & (p5 <= 45)
            ),
        }
    )


def unpivot_rules(signals: DataFrame) -> DataFrame:
    """One row per (date, rule) with its state."""
    pairs = F.array(*[F.struct(F.lit(r).alias("algorithm"), F.col(r).alias("state")) for r in MARKET_RULES])
    return signals.withColumn("_s", F.explode(pairs)).withColumns(
        {"algorithm": F.col("_s.algorithm"), "state": F.col("_s.state")}
    ).drop("_s", *MARKET_RULES)


def summarize_rules(signals: DataFrame) -> DataFrame:
    """Outcomes per rule and state against the unconditional baseline, one aggregation."""
    valid = F.col("i_fwd10").isNotNull()

    def stats(prefix: str, cond: Column) -> list[Column]:
        return [
            F.avg(F.when(cond, F.col("i_fwd10") * 100)).alias(f"{prefix}_ret10"),
            (F.avg(F.when(cond, (F.col("i_fwd10") > 0).cast("int"))) * 100).alias(f"{prefix}_hit10"),
            F.avg(F.when(cond, F.col("i_dd10") * 100)).alias(f"{prefix}_dd10"),
        ]

    aggs = [F.max_by("state", "date").alias("current_bias"), *stats("base", valid)]
    for state in (DEPLOY, WAIT, REDUCE):
        cond = valid & (F.col("state") == state)
        name = state.lower()
        aggs += [
            F.count(F.when(cond, 1)).alias(f"{name}_days"),
            F.avg(F.when(cond, F.col("i_fwd5") * 100)).alias(f"{name}_ret5"),
            *stats(name, cond),
        ]
    out = unpivot_rules(signals).groupBy("algorithm").agg(*aggs)
    return out.withColumns(
        {
            "deploy_vs_base": F.col("deploy_ret10") - F.col("base_ret10"),
            "reduce_vs_base": F.col("reduce_ret10") - F.col("base_ret10"),
            "deploy_minus_reduce": F.col("deploy_ret10") - F.col("reduce_ret10"),
        }
    )


def best_rule(summary: DataFrame, min_deploy_days: int = 50) -> DataFrame:
    """Best rule among those with enough DEPLOY days, or among all when none has."""
    enough = F.col("deploy_days") >= min_deploy_days
    return summary.orderBy(
        enough.desc(), F.desc("deploy_vs_base"), F.desc("deploy_hit10"), F.desc("deploy_minus_reduce"), "algorithm"
    ).limit(1)


def market_gate(signals: DataFrame, best: DataFrame) -> DataFrame:
    """State of the chosen rule per date."""
    name = best.select("algorithm").scalar()
    states = F.create_map(*[x for r in MARKET_RULES for x in (F.lit(r), F.col(r))])
    return signals.select("date", "has_outcome", F.element_at(states, name).alias("gate"))


def consensus(signals: DataFrame) -> DataFrame:
    """Latest state of every rule and the majority view: two REDUCE votes beat two DEPLOY votes."""
    latest = signals.orderBy(F.desc("date")).limit(1)
    votes = {s: sum(F.when(F.col(r) == s, 1).otherwise(0) for r in MARKET_RULES) for s in (DEPLOY, REDUCE)}
    view = F.when(votes[REDUCE] >= 2, REDUCE).when(votes[DEPLOY] >= 2, DEPLOY).otherwise(WAIT)
    return unpivot_rules(latest.withColumn("consensus", view)).select(
        "date", "algorithm", "state", "i_close", "i_range60", "breadth20", "breadth50", "positive5", "consensus"
    )


PICK_RULES = ("trend_leader", "breakout_confirmation", "recovery_strength", "sector_rotation", "residual_momentum")


def pick_scores(features: DataFrame, gate: DataFrame) -> DataFrame:
    """Active (date, instrument, rule) rows with their score, gated by the market state."""
    r20, r60, support = F.col("rel20_rank"), F.col("rel60_rank"), F.col("sector_breadth20")
    d20, d50, d100, vr = (F.col(c) for c in ("dist20", "dist50", "dist100", "vol_ratio20"))
    rel20, rel60, ret5 = F.col("rel20"), F.col("rel60"), F.col("ret5")
    rank, rel_support = F.col("sector_rank"), F.col("sector_rel20")
    dip = F.when(d20.isNotNull(), F.greatest(-d20, F.lit(0.0)))
    rules = {
        "trend_leader": (
            0.35 * r20 + 0.25 * r60 + 0.15 * scale_100(d20, -0.15, 0.15) + 0.10 * scale_100(d50, -0.20, 0.20)
            + 0.15 * scale_100(vr, 0.0, 2.0),
            (d20 > 0) & (d50 > 0) & (rel20 > 0) & (rel60 > 0),
        ),
        "breakout_confirmation": (
            0.30 * r20 + 0.20 * r60 + 0.15 * support + 0.20 * scale_100(vr, 0.0, 3.0) + 0.15 * scale_100(d20, 0.0, 0.15),
            (d20 > 0) & (d50 > 0) & (ret5 > 0) & (vr > 1.0) & (support >= 40),
        ),
        "recovery_strength": (
            0.25 * r20 + 0.30 * r60 + 0.20 * scale_100(dip, 0.0, 0.08) + 0.15 * support + 0.10 * scale_100(vr, 0.0, 2.0),
            (rel60 > 0) & (ret5 < 0) & (d20 < 0) & (d20 > -0.10) & (d50 > -0.03) & (support >= 20) & (rel_support > 0),
        ),
        "sector_rotation": (
            0.40 * rank + 0.25 * support + 0.20 * r20 + 0.15 * r60,
            (rank >= 70) & (support >= 50) & (r20 >= 60),
        ),
        "residual_momentum": (
            0.40 * r20 + 0.25 * r60 + 0.20 * scale_100(d100, -0.20, 0.20) + 0.15 * support,
            (rel20 > 0) & (rel60 > 0) & (d50 > 0) & (support >= 35),
        ),
    }
    scored = F.array(
        *[
            F.struct(F.lit(name).alias("algorithm"), F.when(active, score).alias("score"))
            for name, (score, active) in rules.items()
        ]
    )
    open_market = gate.filter(F.col("gate").isin(DEPLOY, WAIT))
    return (
        features.join(open_market, "date")
        .withColumn("_s", F.explode(F.filter(scored, lambda s: s["score"].isNotNull())))
        .withColumns({"algorithm": F.col("_s.algorithm"), "score": F.col("_s.score")})
        .drop("_s")
    )


def top_picks(scores: DataFrame, k: int) -> DataFrame:
    """Best ``k`` instruments per (date, rule); equal scores order by instrument."""
    best = Window.partitionBy("date", "algorithm").orderBy(F.desc("score"), "ticker")
    return scores.withColumn("pick_rank", F.row_number().over(best)).filter(F.col("pick_rank") <= k)


OUTCOMES = ("fwd5", "fwd10", "excess5", "excess10")


def evaluate_picks(replay: DataFrame) -> DataFrame:
    """Two levels per rule: mean of each day's basket over days, and mean over picks."""
    per_day = replay.groupBy("algorithm", "date").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(c) * 100).alias(c) for c in OUTCOMES],
        *[F.sum(F.col(c) * 100).alias(f"s_{c}") for c in (*OUTCOMES, "dd10")],
        *[F.count(c).alias(f"n_{c}") for c in (*OUTCOMES, "dd10")],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"up_{c}") for c in ("fwd5", "fwd10")],
    )
    picks = F.sum("n")
    return per_day.groupBy("algorithm").agg(
        F.count(F.lit(1)).alias("signal_days"),
        picks.alias("total_picks"),
        (picks / F.count(F.lit(1))).alias("picks_per_day"),
        *[F.avg(c).alias(f"basket_{c}") for c in OUTCOMES],
        *[(F.avg(flag(F.col(c) > 0)) * 100).alias(f"basket_hit_{c}") for c in ("fwd5", "fwd10")],
        *[(F.sum(f"s_{c}") / non_zero(F.sum(f"n_{c}"))).alias(f"pick_{c}") for c in (*OUTCOMES, "dd10")],
        *[(F.sum(f"up_{c}") / picks * 100).alias(f"pick_hit_{c}") for c in ("fwd5", "fwd10")],
    )


def case_studies(latest: DataFrame, current: DataFrame, replay: DataFrame) -> DataFrame:
    """Current score and rank of each (instrument, rule) next to aggregates of its past picks."""
    history = replay.groupBy("ticker", "algorithm").agg(
        F.count(F.lit(1)).alias("past_picks"),
        *[F.avg(F.col(c) * 100).alias(f"past_{c}") for c in ("fwd5", "fwd10", "excess10")],
        (F.avg(flag(F.col("fwd10") > 0)) * 100).alias("past_hit10"),
        F.max("date").alias("last_pick_date"),
    )
    rules = F.array(*[F.lit(r) for r in PICK_RULES])
    base = latest.select("ticker", "sector", F.explode(rules).alias("algorithm"))
    now = current.select("ticker", "algorithm", "score", "pick_rank")
    return base.join(now, ["ticker", "algorithm"], "left").join(history, ["ticker", "algorithm"], "left").select(
        "ticker", "sector", "algorithm", "score", "pick_rank", F.col("score").isNotNull().alias("active"),
        F.coalesce("past_picks", F.lit(0)).alias("past_picks"), "past_fwd5", "past_fwd10", "past_excess10",
        "past_hit10", "last_pick_date",
    )
