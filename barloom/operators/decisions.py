"""Limit-price ladders, candidate scores, verdicts, tranches and budget allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.frames import clamp, non_zero, return_pct
from barloom.functions.ranks import running_totals

FEE_PCT = 0.06
# Anchor names of limit prices by class, in merge order.
TACTICAL = ("valid_bid1", "grid_below_t1", "grid_below_t2", "grid_below_t3")
HISTORICAL = (
    "forecast_low_t1", "range_low_blend_t5", "range_low_blend_t10", "cycle_drawdown", "atr_1x_below", "atr_1_5x_below",
)


def snap_buy_price(price: Column, tick: Column, low: Column, high: Column) -> Column:
    """Down to the row's own tick, exactly, then into the band."""
    per_unit = F.round(F.lit(1.0) / tick).cast("int")
    steps = F.floor(price.cast("string").cast("decimal(24,14)") * per_unit)
    return clamp(steps.cast("double") / per_unit, low, high)


def valid_price(x: Column) -> Column:
    """A price field as a number; values up to 1 (validity flags) are not prices."""
    value = x.cast("double")
    return F.when(value > 1.0, value)


def price_limits(row_floor: Column, row_ceil: Column, floor_valid: Column, ceil_valid: Column) -> tuple[Column, Column]:
    return F.coalesce(valid_price(floor_valid), row_floor), F.coalesce(valid_price(ceil_valid), row_ceil)


def limit_candidates(base: DataFrame) -> DataFrame:
    """Snapped limit prices per instrument; equal prices merge their anchors in anchor order.

    ``base`` has last, atr14, tick, floor, ceil, the grid and the forecast lows.
    """
    low, high = price_limits(F.col("floor"), F.col("ceil"), F.col("floor_valid"), F.col("ceil_valid"))
    sources = dict(
        zip(
            (*TACTICAL, *HISTORICAL),
            (
                F.col("bid1"), F.col("below1"), F.col("below2"), F.col("below3"), F.col("low_t1"), F.col("low_t5"), F.col("low_t10"),
                F.col("cycle_drawdown_price"), F.col("last") - F.col("atr14"), F.col("last") - 1.5 * F.col("atr14"),
            ),
        )
    )
    anchors = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(name).alias("anchor"), price.alias("raw"))
            for i, (name, price) in enumerate(sources.items())
        ]
    )
    rows = base.select("ticker", "last", "tick", low.alias("_low"), high.alias("_high"), F.inline(F.filter(anchors, lambda a: a["raw"] > 0)))
    rows = rows.withColumn("limit_price", snap_buy_price(F.col("raw"), F.col("tick"), F.col("_low"), F.col("_high")))
    rows = rows.filter(F.col("limit_price") <= F.col("last") + 1e-9)
    names = F.array_sort(F.collect_list(F.struct("pos", "anchor")))
    merged = rows.groupBy("ticker", "limit_price").agg(
        F.array_join(F.transform(names, lambda a: a["anchor"]), "|").alias("anchors")
    )
    w = Window.partitionBy("ticker").orderBy(F.desc("limit_price"))
    return merged.withColumns({"price_rank": F.row_number().over(w), "anchor_class": anchor_class(F.col("anchors"))})


def anchor_class(anchors: Column) -> Column:
    parts = F.split(anchors, r"\|")
    old = F.arrays_overlap(parts, F.array(*[F.lit(a) for a in HISTORICAL]))
    new = F.arrays_overlap(parts, F.array(*[F.lit(a) for a in TACTICAL]))
    return F.when(old & new, "mixed").when(old, "historical").when(new, "tactical").otherwise("unknown")


def fill_score(entry: Column, reference: Column, scale: Column) -> Column:
    """Chance-like score 1..99 that falls as the entry lies below the reference."""
    z = (entry - reference) / F.greatest(scale, F.lit(1e-6))
    return clamp(100.0 / (1.0 + F.exp(-z)), 1.0, 99.0)


def net_edge(peak_price: Column, drawdown_price: Column, entry: Column) -> Column:
    peak, fall = return_pct(peak_price, entry), return_pct(drawdown_price, entry)
    return peak - F.abs(F.least(fall, F.lit(0.0))) - FEE_PCT


def entry_ladder(candidates: DataFrame, base: DataFrame, timing: DataFrame) -> DataFrame:
    """Score every limit price: best timing, cycle edge, next close, fill chance; rank per instrument.

    ``timing`` has horizon, peak_price, peak_day, drawdown_price and close_price per instrument.
    """
    rows = candidates.join(base.drop("last", "anchors"), "ticker").join(base.select("ticker", F.col("last")), "ticker")
    entry = F.col("limit_price")
    options = candidates.select("ticker", "limit_price").join(timing, "ticker")
    peak, fall = return_pct("peak_price", entry), return_pct("drawdown_price", entry)
    edge = net_edge(F.col("peak_price"), F.col("drawdown_price"), entry)
    options = options.withColumns(
        {
            "edge": edge,
            "per_day": edge / F.greatest("peak_day", F.lit(1.0)),
            "reward_risk": F.when(F.abs(fall) > 1e-9, peak / F.abs(fall)),
            "close_edge": return_pct("close_price", entry) - FEE_PCT,
        }
    ).filter("edge is not null")
    best = options.groupBy("ticker", "limit_price").agg(
        F.max_by(F.struct("horizon", "edge", "close_edge", "reward_risk"), F.struct("per_day", "edge", -F.col("horizon"))).alias("t")
    )
    rows = rows.join(best, ["ticker", "limit_price"], "left")
    scale = F.greatest(F.col("atr14") * 0.5, F.col("tick") * 2.0)
    fills = {
        "fill_t1": fill_score(entry, F.col("low_t1"), scale),
        "fill_t5": fill_score(entry, F.col("low_t5"), scale),
        "fill_t10": fill_score(entry, F.col("low_t10"), scale),
        "fill_cycle": fill_score(entry, F.col("cycle_drawdown_price"), scale),
    }
    rows = rows.withColumns(
        {
            **fills,
            "timing_edge": F.col("t.edge"),
            "timing_horizon": F.col("t.horizon"),
            "timing_reward_risk": F.col("t.reward_risk"),
            "next_close_edge": return_pct("close_t1", entry) - FEE_PCT,
            "cycle_edge": net_edge(F.col("cycle_peak_price"), F.col("cycle_drawdown_price"), entry),
        }
    )
    known = F.array_compact(F.array(*[F.col(c) for c in fills]))
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / non_zero(F.size(known))
    rows = rows.withColumn("fill", mean)
    score = 0.5 * F.col("timing_edge") + 0.3 * F.col("cycle_edge") + 0.2 * F.col("next_close_edge")
    weight = F.coalesce(clamp("fill", 0.0, 100.0), F.lit(0.0)) / 100.0
    rows = rows.withColumn("entry_score", score * weight)
    w = Window.partitionBy("ticker").orderBy(F.col("entry_score").desc_nulls_last(), "price_rank")
    return rows.withColumn("entry_rank", F.row_number().over(w)).select(
        "ticker", "limit_price", "anchors", "anchor_class", "price_rank", "entry_rank", "timing_horizon", "timing_edge",
        "timing_reward_risk", "next_close_edge", "cycle_edge", *fills, "fill", "entry_score",
    )


def best_entry(ladder: DataFrame) -> DataFrame:
    """Preferred limit price: historical or mixed anchors first, then best rank, then lowest price."""
    old = F.when(F.col("anchor_class").isin("historical", "mixed"), 0).otherwise(1)
    first = F.struct(old, F.col("entry_rank"), F.col("limit_price"))
    return ladder.groupBy("ticker").agg(
        F.min_by(F.struct("limit_price", "entry_score", "fill", "anchor_class"), first).alias("e")
    ).select("ticker", "e.*")


def preferred_zone(rows: DataFrame) -> DataFrame:
    """Buy zone from state, else ladder price less two ticks, else the grid below; and where price stands."""
    grid = [F.when(F.col(f"below{i}") > 0, F.col(f"below{i}")) for i in (1, 2, 3)]
    s_low, s_high, limit = F.col("state_low"), F.col("state_high"), F.col("limit_price")
    has_state = (s_low > 0) & (s_high > 0)
    has_ladder = limit > 0
    rows = rows.withColumns(
        {
            "zone_low": F.when(has_state, F.least(s_low, s_high))
            .when(has_ladder, F.greatest(limit - 2.0 * F.col("tick"), F.lit(0.0)))
            .otherwise(F.least(*grid)),
            "zone_high": F.when(has_state, F.greatest(s_low, s_high)).when(has_ladder, limit).otherwise(F.greatest(*grid)),
            "zone_source": F.when(has_state, "state").when(has_ladder, "ladder").when(F.coalesce(*grid).isNotNull(), "grid").otherwise("unknown"),
        }
    )
    last, low, high = F.col("last"), F.col("zone_low"), F.col("zone_high")
    return rows.withColumns(
        {
            "zone_status": F.when(low.isNull() | high.isNull(), "unknown")
            .when((last >= low) & (last <= high), "inside")
            .when(last > high, "above")
            .otherwise("below"),
            "zone_gap": F.when((last >= low) & (last <= high), 0.0).when(last > high, return_pct(last, high)).otherwise(return_pct(low, last)),
        }
    )


def quantity_for_budget(budget: Column, price: Column, lot: Column | int) -> Column:
    """Whole lots a budget buys; prices are in thousands."""
    lot = F.lit(lot) if isinstance(lot, int) else lot
    lots = F.floor(budget / non_zero(price * 1000 * lot))
    return F.coalesce(F.when(price > 0, lots * lot), F.lit(0)).cast("long")


def liquidity_points(pct_adv: Column) -> Column:
    return (
        F.when(pct_adv.isNull(), -4.0)
        .when(pct_adv <= 5, 10.0)
        .when(pct_adv <= 10, 6.0)
        .when(pct_adv <= 15, 1.5)
        .when(pct_adv <= 20, -4.0)
        .otherwise(F.greatest(F.lit(-16.0), -4.0 - (pct_adv - 20) * 0.6))
    )


# Decision labels in the order they are listed.
BUY_NOW, HOLD_OFF, NO_BUY = "mua_ngay", "chờ", "không_mua"


def candidate_scores(rows: DataFrame, budget: float, crowded: Column) -> DataFrame:
    """Score 0..100 and decision per instrument.

    ``rows`` joins the snapshot with zone, playbook, timing, forecast, ladder and overlays;
    any optional layer may be null and then adds nothing.
    """
    def term(x: Column, low: float, high: float) -> Column:
        return F.coalesce(clamp(x, low, high), F.lit(0.0))

    def pts(cond: Column, n: float) -> Column:
        return F.when(cond, n).otherwise(0.0)

    dist, rsi, pos = F.col("dist_sma20_pct"), F.col("rsi14"), F.col("pos52")
    gap, status = F.coalesce("zone_gap", F.lit(0.0)), F.col("zone_status")
    rows = rows.withColumns(
        {
            "pct_adv": F.when((F.col("last") > 0) & (F.col("adv20") > 0), budget / (F.col("last") * 1000 * F.col("adv20")) * 100.0),
            "anchored": F.col("zone_source").isin("state", "ladder"),
            "crowded": F.coalesce(crowded, F.lit(False)),
        }
    )
    anchored = F.col("anchored")
    zone = (
        F.when(~anchored, 0.0)
        .when(status == "inside", 10.0)
        .when((status == "above") & (gap <= 3), 2.0)
        .when((status == "above") & (gap <= 8), -2.0)
        .when(status == "above", -6.0)
        .when((status == "below") & (gap <= 2), 1.0)
        .when(status == "below", -4.0)
        .otherwise(0.0)
    )
    score = (
        50.0
        + term(F.coalesce("all_score", F.lit(0.0)) * 0.30, -12.0, 12.0)
        + term(F.coalesce("robust_score", F.lit(0.0)) * 0.30, -15.0, 15.0)
        + term(F.col("rel20") * 0.25, -8.0, 8.0)
        + term(F.col("rel60") * 0.15, -5.0, 5.0)
        + term((F.coalesce("sector_positive5", F.lit(0.0)) - 50) * 0.12, -6.0, 6.0)
        + liquidity_points(F.col("pct_adv"))
        + term(F.col("foreign_bn") / 200.0, -4.0, 4.0)
        + pts(F.col("latest_signal"), 6.0)
        + zone
        - F.when(dist > 8, term((dist - 8) * 1.3, 0.0, 16.0)).otherwise(0.0)
        - F.when(rsi > 65, term((rsi - 65) * 0.9, 0.0, 12.0)).otherwise(0.0)
        - F.when(pos >= 0.75, term((pos - 0.75) * 36.0, 0.0, 9.0)).otherwise(0.0)
        + term(F.col("best_edge") * 0.8, -12.0, 12.0)
        + term(F.col("edge10") * 0.3, -6.0, 6.0)
        + term(F.col("forecast_ret") * 1.3, -6.0, 6.0)
        + term(F.col("entry_score") * 1.5, 0.0, 10.0)
        + term(F.col("overlay_score").cast("double"), -6.0, 6.0)
        + term(F.col("archetype_score").cast("double"), -6.0, 6.0)
        - F.when(F.col("crowded"), F.when(status == "above", 8.0).otherwise(4.0)).otherwise(0.0)
    )
    rows = rows.withColumn("score", clamp(score, 0.0, 100.0))
    rows = rows.withColumns(
        {
            "very_stretched": F.coalesce((dist >= 18) | (rsi >= 74), F.lit(False)),
            "stretched": F.coalesce((dist >= 12) | (rsi >= 68), F.lit(False)),
            "timing_bad": F.coalesce((F.col("best_edge") < -1.5) & (F.col("edge10").isNull() | (F.col("edge10") < 0)), F.lit(False)),
            "forecast_bad": F.coalesce(F.col("forecast_ret") < -1, F.lit(False)),
            "liquidity_bad": F.coalesce(F.col("pct_adv") > 20, F.lit(False)),
            "playbook_bad": (F.coalesce("robust_score", F.lit(0.0)) < 0) & (F.coalesce("all_score", F.lit(0.0)) < 20),
        }
    )
    s, very, bad = F.col("score"), F.col("very_stretched"), F.col("timing_bad")
    no_view = F.col("best_edge").isNull() & F.col("forecast_ret").isNull()
    wait_or_no = F.when(s >= 52, HOLD_OFF).otherwise(NO_BUY)
    strong = F.coalesce(F.col("latest_signal"), F.lit(False)) | (F.coalesce("best_edge", F.lit(0.0)) > 4)
    first = (
        F.when(F.col("liquidity_bad") | (very & bad) | (F.col("playbook_bad") & bad), NO_BUY)
        .when(
            status == "inside",
            F.when(anchored & (s >= 62) & ~very & ~bad & ~F.col("forecast_bad"), BUY_NOW)
            .when(anchored & (s >= 58) & no_view & ~F.col("stretched"), BUY_NOW)
            .otherwise(wait_or_no),
        )
        .when(status == "above", F.when((s >= 48) & ~(very & bad), HOLD_OFF).otherwise(NO_BUY))
        .when(status == "below", F.when(s >= 55, HOLD_OFF).otherwise(NO_BUY))
        .otherwise(F.when((s >= 65) & ~F.col("stretched") & strong, BUY_NOW).otherwise(wait_or_no))
    )
    hold = (F.col("crowded") & (status != "inside")) | ~anchored | very | bad
    decision = F.when((first == BUY_NOW) & hold, HOLD_OFF).otherwise(first)
    rows = rows.withColumn("decision", decision)
    reference = F.when((F.col("decision") == BUY_NOW) & (status == "inside"), F.col("last")).otherwise(
        F.coalesce("zone_low", F.when(F.col("limit_price") > 0, F.col("limit_price")), "last")
    )
    return rows.withColumn("reference_price", reference).withColumn(
        "reference_quantity", quantity_for_budget(F.lit(budget), F.col("reference_price"), F.col("lot_size"))
    )


def rank_decisions(rows: DataFrame) -> DataFrame:
    """Place within each decision by rounded score (null last), then name.

    There are three decisions for any number of instruments, so places come from running counts
    over score buckets, and names are only ordered among equal scores.
    """
    place = F.when(F.col("decision") == BUY_NOW, 0).when(F.col("decision") == HOLD_OFF, 1).when(F.col("decision") == NO_BUY, 2).otherwise(9)
    rows = rows.withColumn("candidate_score", F.bround("score", 2)).withColumn("_down", F.coalesce(-F.col("candidate_score"), F.lit(1e18)))
    above = running_totals(rows, ["decision"], "_down", {"_c": F.lit(1)}).select("decision", "_down", "_c_below")
    among = Window.partitionBy("decision", "_down").orderBy("ticker")
    return (
        rows.withColumn("_among", F.row_number().over(among))
        .join(above, ["decision", "_down"])
        .withColumns({"decision_order": place, "decision_rank": (F.col("_c_below") + F.col("_among")).cast("int")})
        .drop("_down", "_among", "_c_below")
    )


def budget_plan(tranches: DataFrame, budget: float, lot: int = 100) -> DataFrame:
    """Budget over each instrument's tranches by weight (allocated, else cap, else 1), in whole lots.

    ``tranches`` has ticker, role, limit_price, allocated, cap and the current price ``last``.
    """
    weight = F.coalesce(
        F.when(F.col("allocated") > 0, F.col("allocated")), F.when(F.col("cap") > 0, F.col("cap")), F.lit(1.0)
    )
    rows = tranches.filter("limit_price > 0").withColumn("_w", weight)
    totals = rows.groupBy("ticker").agg(F.sum("_w").alias("_t"))
    rows = rows.join(totals, "ticker").withColumn("share_pct", F.col("_w") / F.col("_t") * 100.0)
    rows = rows.withColumn("capital", F.bround(budget * F.col("share_pct") / 100.0, 0).cast("long"))
    rows = rows.withColumn("quantity", quantity_for_budget(F.col("capital"), F.col("limit_price"), lot))
    return rows.withColumns(
        {
            "order_value": F.bround(F.col("quantity") * F.col("limit_price") * 1000, 0).cast("long"),
            "actionable": F.col("last") <= F.col("limit_price"),
        }
    ).drop("_w", "_t")


def deploy_now(plan: DataFrame) -> DataFrame:
    """Totals of the tranches that the current price already reaches."""
    now = F.col("actionable")
    return plan.groupBy("ticker").agg(
        F.coalesce(F.sum(F.when(now, F.col("share_pct"))), F.lit(0.0)).alias("now_pct"),
        F.coalesce(F.sum(F.when(now, F.col("order_value"))), F.lit(0)).alias("now_value"),
        F.coalesce(F.sum(F.when(now, F.col("quantity"))), F.lit(0)).alias("now_quantity"),
    )


def verdict(rows: DataFrame) -> DataFrame:
    """Plain verdict from plan, zone, stretch and timing."""
    last, dist, rsi = F.col("last"), F.col("dist_sma20_pct"), F.col("rsi14")
    in_zone = F.coalesce((last >= F.bround("zone_low", 2)) & (last <= F.bround("zone_high", 2)), F.lit(False))
    deep = F.coalesce((dist >= 15) | (rsi >= 74), F.lit(False))
    hot = F.coalesce((dist >= 10) | (rsi >= 68), F.lit(False))
    ret = F.col("forecast_ret")
    v = (
        F.when(F.col("has_plan") & in_zone & (F.col("best_edge") > 0) & (ret >= -0.5), "BUY_NOW")
        .when(F.col("has_plan"), "RESTING_BUY_ONLY")
        .when(deep | ((F.col("best_edge") < 0) & (F.col("edge10") < 0)) | (hot & (ret < 0)), "NO_BUY_NOW")
        .when(last > F.bround("zone_high", 2), "WAIT_FOR_PULLBACK")
        .otherwise("WATCH")
    )
    return rows.withColumn("verdict", v)


# State columns with the words for a positive and a negative state.
STATE_WORDS = {
    "t_streak": ("green streak", "red streak"),
    "t_limit": ("ceiling proxy", "floor proxy"),
    "t_shock": ("shock up", "shock down"),
    "t_impulse": ("3-day impulse up", "3-day impulse down"),
    "t_wide": ("wide-range expansion", "wide-range breakdown"),
    "t_trend": ("hot trend regime", "hot down regime"),
    "t_compression": ("compression above base", "compression below base"),
    "t_reclaim": ("sma20 reclaim", "sma20 loss"),
    "t_rotation": ("relative rotation up", "relative rotation down"),
    "t_exhaustion": ("upside exhaustion", "downside capitulation"),
}


def state_summary(columns: Sequence[str] = tuple(STATE_WORDS)) -> Column:
    """Active states in words; ``neutral`` when all known states are quiet, null when none is known."""
    words = [
        F.when(F.col(c) >= 0.5, STATE_WORDS[c][0]).when(F.col(c) <= -0.5, STATE_WORDS[c][1]) for c in columns
    ]
    text = F.array_join(F.array_compact(F.array(*words)), ", ")
    known = F.coalesce(*[F.col(c) for c in columns]).isNotNull()
    return F.when(text != "", text).when(known, "neutral")


def market_regime(b20: Column, b50: Column, p5: Column, new_high: Column) -> Column:
    b20, b50, p5, new_high = (F.coalesce(x, F.lit(0.0)) for x in (b20, b50, p5, new_high))
    return (
        F.when((b20 >= 65) & (b50 >= 55) & (p5 >= 55) & (new_high >= 15), "risk_on")
        .when((b20 <= 35) & (b50 <= 30) & (p5 <= 40), "risk_off")
        .otherwise("balanced")
    )


def sector_regime(members: Column, b20: Column, b50: Column, rel20: Column) -> Column:
    b20, b50, rel20 = (F.coalesce(x, F.lit(0.0)) for x in (b20, b50, rel20))
    return (
        F.when(members <= 1, "mixed")
        .when((b20 >= 60) & (b50 >= 50) & (rel20 >= 5), "leader")
        .when((b20 <= 40) & (b50 <= 35) & (rel20 <= -3), "laggard")
        .otherwise("mixed")
    )


# Archetype, may add on strength, may add on weakness, hold window, base weight band in percent.
ARCHETYPES = [
    ("special_situation", False, True, "3-10 phiên, chỉ kéo dài nếu follow-through sạch", 6.0, 14.0),
    ("quality_financial_trend", True, True, "2-8 tuần", 18.0, 30.0),
    ("cyclical_beta", True, True, "1-6 tuần tùy chu kỳ", 12.0, 24.0),
    ("quality_trend", True, True, "2-8 tuần", 16.0, 28.0),
    ("momentum_high_beta", True, False, "3-10 phiên", 8.0, 16.0),
    ("balanced_swing", False, True, "1-4 tuần", 10.0, 18.0),
]


def archetype_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ARCHETYPES,
        "archetype string, on_strength boolean, on_weakness boolean, hold_window string, base_min double, base_max double",
    )


def archetype(property_sector: str, finance_sector: str, material_sector: str) -> Column:
    """Trading archetype from sector, quality, valuation, volatility and beta; null counts 0."""
    roe, pb, pe, vol, atr, rel, beta = (
        F.coalesce(c, F.lit(0.0)) for c in ("roe", "pb", "pe", "vol20_pct", "atr_pct", "rel20", "beta")
    )
    sector = F.lower("sector")
    return (
        F.when(F.contains(sector, F.lit(property_sector)) & ((roe <= 8) | (pb <= 1)) & ((vol >= 3) | (atr >= 4)), "special_situation")
        .when(F.contains(sector, F.lit(finance_sector)) & (roe >= 18) & (pb >= 1.5), "quality_financial_trend")
        .when(F.contains(sector, F.lit(material_sector)) & (beta >= 0.8), "cyclical_beta")
        .when((roe >= 18) & (pe > 0) & (pe <= 18) & (vol <= 3), "quality_trend")
        .when((rel >= 10) & (atr >= 3), "momentum_high_beta")
        .otherwise("balanced_swing")
    )


def archetype_score() -> Column:
    """Overlay -6..6 by archetype from timing, burst age and follow-through."""
    edge, e10, age = F.col("best_edge"), F.col("edge10"), F.col("signal_age")
    nxt, third, draw = F.col("next_positive_pct"), F.col("third_negative_pct"), F.col("drawdown3_pct")

    def pts(cond: Column, n: float) -> Column:
        return F.when(cond, n).otherwise(0.0)

    momentum = (
        pts(age <= 1, -2.0) + pts(age.between(2, 4), -1.0) + pts(F.col("bias") == "distribution", -2.0)
        + pts(F.col("burst_bias") == "failed_day2_followthrough", -2.0) + pts(F.col("burst_bias") == "respect_t25_supply", -2.0)
        + pts(e10 < 0, -2.0) + pts(draw <= -2, -1.0)
    )
    cyclical = (
        F.when(edge >= 3, 3.0).when(edge > 0, 1.0).otherwise(0.0) + pts(e10 >= 0, 1.0) + pts(age >= 10, 1.0)
        + pts(nxt >= 70, 1.0) + pts(draw > -1, 1.0)
    )
    trend = pts(edge > 0, 1.0) + pts(e10 > 0, 2.0) + pts(age >= 10, 1.0) + pts(nxt >= 75, 1.0) + pts(draw > -1, 1.0)
    special = pts(edge >= 2, 2.0) + pts(e10 < 0, -3.0) + pts(age <= 10, -1.0) + pts(third >= 35, -1.0) + pts(draw <= -2, -1.0)
    other = F.coalesce(clamp(edge * 0.3, -2.0, 2.0), F.lit(0.0)) + F.coalesce(clamp(e10 * 0.2, -2.0, 2.0), F.lit(0.0))
    kind = F.col("archetype")
    score = (
        F.when(kind == "momentum_high_beta", momentum)
        .when(kind == "cyclical_beta", cyclical)
        .when(kind == "quality_trend", trend)
        .when(kind == "special_situation", special)
        .otherwise(other)
    )
    return F.bround(clamp(score, -6.0, 6.0), 0).cast("int")


def conviction(rows: DataFrame) -> DataFrame:
    """Conviction 0.35..1.8 and target weight band from regime, timing and cycle outlook."""
    edge, e10 = F.coalesce("best_edge", F.lit(0.0)), F.coalesce("edge10", F.lit(0.0))
    rsi, rel = F.coalesce("rsi14", F.lit(0.0)), F.coalesce("rel20", F.lit(0.0))
    leader, laggard = F.col("sector_regime") == "leader", F.col("sector_regime") == "laggard"
    peak, fall = F.col("cycle_peak"), F.col("cycle_drawdown")

    def pick(*cases: tuple[Column, float]) -> Column:
        out = F.when(*cases[0])
        for cond, n in cases[1:]:
            out = out.when(cond, n)
        return out.otherwise(0.0)

    score = (
        1.0
        + pick((leader, 0.25), (laggard, -0.2))
        + pick((edge > 1, 0.15), (edge < 0, -0.15))
        + pick((e10 < 0, -0.2))
        + pick((rel >= 8, 0.1), (rel <= -5, -0.1))
        + pick((rsi >= 75, -0.1))
        + pick((F.col("latest_signal"), 0.1))
        + pick(((peak >= 8) & (fall >= -6), 0.1), ((peak <= 4) | (fall <= -10), -0.1))
    )
    up = leader & (rel >= 5) & (edge > 0)
    low = F.col("base_min") + pick((up, 2.0), (laggard, -2.0)) + pick((edge < 0, -1.0)) + pick((e10 < 0, -1.0)) + pick((rsi >= 75, -1.0))
    high = (
        F.col("base_max") + pick((up, 2.0), (laggard, -2.0)) + pick((edge > 1, 1.0), (edge < 0, -1.0)) + pick((e10 < 0, -2.0)) + pick((rsi >= 75, -1.0))
    )
    multiple = F.col("target_price") / non_zero("last")
    low = F.when(multiple >= 1.8, F.greatest(low, F.lit(12.0))).when(multiple >= 1.4, F.greatest(low, F.lit(10.0))).otherwise(low)
    high = F.when(multiple >= 1.8, F.greatest(high, F.lit(24.0))).when(multiple >= 1.4, F.greatest(high, F.lit(20.0))).otherwise(high)
    return rows.withColumns(
        {"conviction": clamp(score, 0.35, 1.8), "target_min": clamp(low, 4.0, 28.0), "_high": high}
    ).withColumn("target_max", clamp("_high", F.col("target_min") + 4.0, F.lit(40.0))).drop("_high")


def invested_target(regime: Column, atr_rank: Column, b20: Column) -> tuple[Column, Column]:
    """(target invested percent, share kept for adding on strength)."""
    rank = F.coalesce(atr_rank, F.lit(0.0))
    target = (
        F.when((regime == "risk_on") & (rank >= 80), 65.0)
        .when(regime == "risk_on", 70.0)
        .when((regime == "risk_off") & (F.coalesce(b20, F.lit(0.0)) <= 25), 30.0)
        .when(regime == "risk_off", 35.0)
        .when(rank >= 80, 50.0)
        .otherwise(55.0)
    )
    share = F.when(regime == "risk_on", 0.35).when(regime == "risk_off", 0.10).otherwise(0.25)
    return target, share


def single_name_cap(gap: Column, kind: Column, trim: Column, burst: Column) -> Column:
    """Percent of the portfolio one instrument may build in a session."""
    special = kind == "special_situation"
    failing = (trim == "high") | burst.isin("failed_followthrough", "failed_day2_followthrough")
    share = F.when(special | failing, 0.40).otherwise(0.50)
    cap = F.when(failing, 22.5).when(special, 25.0).otherwise(30.0)
    return F.when(gap > 0, F.greatest(F.least(gap * share, cap, gap), F.lit(0.0))).otherwise(0.0)


def session_cap(to_min: Column, to_max: Column, weakness: Column, strength: Column, edge: Column, share: Column, persistent: Column) -> Column:
    """Session cap of an instrument: weakness part up to the minimum, strength part above it."""
    to_min, to_max = F.greatest(to_min, F.lit(0.0)), F.greatest(to_max, F.lit(0.0))
    room = F.greatest(to_max - to_min, F.lit(0.0))
    up = F.least(room, F.greatest(to_max * share, F.lit(2.0))) * F.when(edge > 1, 1.1).otherwise(1.0)
    cap = F.least(F.when(weakness, to_min).otherwise(0.0) + F.when(strength & (room > 0), up).otherwise(0.0), to_max)
    kept = F.least(to_max, F.greatest(cap, F.lit(2.0)))
    return F.greatest(F.when(persistent & (cap < F.least(to_max, F.lit(2.0))), kept).otherwise(cap), F.lit(0.0))


def burst_guidance(rows: DataFrame) -> DataFrame:
    """Execution guidance from the age of the last burst and the tape's bias."""
    age, failed, bias = F.col("signal_age"), F.col("squeeze_failure"), F.col("bias")
    none, fresh = age.isNull(), age <= 1
    absorb, distribute = bias == "absorption", bias == "distribution"
    return rows.withColumns(
        {
            "guide_bias": F.when(none, F.col("burst_bias"))
            .when(fresh & failed, "failed_day2_followthrough")
            .when(fresh & absorb, "respect_day2_followthrough")
            .when(fresh, "wait_for_day2_confirmation")
            .when(distribute, "respect_t25_supply")
            .when(absorb, "keep_core_trim_selectively")
            .otherwise("normal_tactical_management"),
            "guide_trim": F.when(none, F.col("trim"))
            .when((fresh & failed) | (~fresh & distribute), "high")
            .when(fresh & absorb, "light")
            .otherwise("moderate"),
            "urgent_trim": F.when(none | (fresh & ~failed & absorb), "none")
            .when((fresh & failed) | (~fresh & distribute), "frontload_sell")
            .otherwise("staggered_trim"),
            "must_sell_pct": F.when(none | (fresh & ~failed & absorb), 0.0)
            .when(fresh & failed, 35.0)
            .when(~fresh & distribute, 30.0)
            .when(fresh | absorb, 15.0)
            .otherwise(10.0),
        }
    )


def core_tranches(ladder: DataFrame) -> DataFrame:
    """Best three historical limit prices per instrument as shallow, mid and deep tranches whose shares add to 100."""
    old = F.col("anchor_class").isin("historical", "mixed")
    whole = Window.partitionBy("ticker")
    rows = ladder.withColumn("_any", F.max(old).over(whole)).filter(~F.col("_any") | old)
    best = whole.orderBy("entry_rank", "price_rank")
    rows = rows.withColumn("_rn", F.row_number().over(best)).filter("_rn <= 3")
    score = F.greatest(F.coalesce("entry_score", F.lit(0.0)), F.lit(0.0))
    fill = F.least(F.greatest(F.coalesce("fill", F.lit(0.0)), F.lit(0.0)), F.lit(100.0))
    raw = score * (1 + 0.015 * fill) / F.sqrt(F.greatest("entry_rank", F.lit(1)))
    rows = rows.withColumn("_raw", raw).withColumns(
        {"_total": F.sum("_raw").over(whole), "_n": F.count(F.lit(1)).over(whole)}
    )
    share = F.when(F.col("_total") > 0, 100.0 * F.col("_raw") / non_zero("_total")).otherwise(100.0 / F.col("_n"))
    by_price = whole.orderBy(F.desc("limit_price"))
    rows = rows.withColumns({"_share": F.bround(share, 2), "_pos": F.row_number().over(by_price)})
    drift = F.round(100.0 - F.sum("_share").over(whole), 2)
    deepest = F.col("_pos") == F.col("_n")
    return rows.select(
        "ticker",
        F.when(F.col("_pos") == 1, "shallow_core").when(F.col("_pos") == 2, "mid_core").otherwise("deep_core").alias("role"),
        "limit_price",
        "entry_rank",
        F.round(F.col("_share") + F.when(deepest, drift).otherwise(0.0), 2).alias("share_pct"),
    )


# Burst guidance by which a small reserve follows the price, and its share with and without adding on strength.
FOLLOWED = ("respect_day2_followthrough", "keep_core_trim_selectively")
FAILED = ("failed_followthrough", "failed_day2_followthrough")


def session_blueprint(ladder: DataFrame, context: DataFrame) -> DataFrame:
    """A session's buy tranches per instrument in five roles; shares add to 100.

    The core is the best three historical limit prices (any, if there are none). Where the price
    stands over 2 % above it and the instrument may be bought into weakness or strength, part of
    the share goes to a bridge, the lowest ladder price above the core, and to a continuation
    reserve at the lowest grid price above it. ``context`` has a row per ticker: last, ask1, above1,
    weakness, strength, signal_age, guide_bias, guide_trim. Output: ticker, role, limit_price,
    entry_rank, share_pct, base_score, floor_pct.
    """
    old = F.col("anchor_class").isin("historical", "mixed")
    whole = Window.partitionBy("ticker")
    rows = ladder.select("ticker", "limit_price", "anchor_class", "entry_rank", "price_rank", "entry_score", "fill")
    rows = rows.withColumn("_any", F.max(old).over(whole)).filter(~F.col("_any") | old)
    rows = rows.withColumns(
        {
            "_core": F.row_number().over(whole.orderBy("entry_rank", "price_rank")) <= 3,
            "_score": F.greatest(F.coalesce("entry_score", F.lit(0.0)), F.lit(0.0)),
            "_fill": F.greatest(F.coalesce("fill", F.lit(0.0)), F.lit(0.0)),
        }
    )
    rows = rows.withColumns(
        {"_high": F.max(F.when(F.col("_core"), F.col("limit_price"))).over(whole), "_core_fill": F.max(F.when(F.col("_core"), F.col("_fill"))).over(whole)}
    )
    # a row per instrument from here on: the core as an array, and the first ladder price above it
    level = F.struct("limit_price", "entry_rank", "_score", "_fill")
    each = rows.groupBy("ticker").agg(
        F.max("_high").alias("core_high"),
        F.max("_core_fill").alias("core_fill"),
        F.max(F.when(F.col("_core"), F.col("_score"))).alias("core_score"),
        F.array_sort(F.collect_list(F.when(F.col("_core"), level)), lambda a, b: F.signum(b["limit_price"] - a["limit_price"]).cast("int")).alias("core"),
        F.min(F.when(F.col("limit_price") > F.col("_high"), level)).alias("bridge"),
    ).join(context, "ticker")
    above = [F.when(F.col(c) > F.greatest("core_high", F.lit(0.0)), F.col(c)) for c in ("ask1", "above1")]
    failed, high_trim, strong = F.col("guide_bias").isin(*FAILED), F.col("guide_trim") == "high", F.col("strength")
    each = each.withColumn("reserve", F.least(*above)).withColumn(
        "_gate", F.coalesce((F.col("weakness") | strong) & (F.col("core_high") > 0) & (F.col("last") > F.col("core_high") * 1.02), F.lit(False))
    )
    reserve = (
        F.when(F.col("guide_bias").isin(*FOLLOWED), F.when(strong, 9.0).otherwise(7.0))
        .when(F.col("guide_bias") == "normal_tactical_management", F.when(strong, 7.0).otherwise(5.5))
        .when(failed & F.col("weakness"), 4.0)
        .otherwise(0.0)
    )
    reserve = F.least(F.when(high_trim, F.greatest(reserve - 0.5, F.lit(0.0))).otherwise(reserve), F.lit(10.0))
    each = each.withColumn("_reserve_pct", F.when(F.col("_gate") & (F.col("reserve") <= F.col("last") * 1.02), reserve).otherwise(0.0))
    bridge = (
        F.lit(7.5)
        + F.when(F.col("signal_age") <= 1, 1.5).otherwise(0.0)
        + F.when(F.col("bridge._fill") - F.col("core_fill") >= 15, 1.0).otherwise(0.0)
        + F.when((F.col("last") / F.col("core_high") - 1) * 100.0 >= 4, 1.0).otherwise(0.0)
        + F.when(high_trim & failed, 0.5).otherwise(0.0)
    )
    each = each.withColumn("_bridge_pct", F.when(F.col("_gate") & F.col("bridge").isNotNull(), F.least(bridge, F.lit(10.0))).otherwise(0.0))
    each = each.withColumn("_left", F.greatest(100.0 - F.col("_reserve_pct") - F.col("_bridge_pct"), F.lit(0.0)))
    raw = F.transform("core", lambda x: x["_score"] * (1 + 0.015 * F.least(x["_fill"], F.lit(100.0))) / F.sqrt(F.greatest(x["entry_rank"], F.lit(1))))
    each = each.withColumn("_raw", raw).withColumn("_total", F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x))
    share = F.transform(
        "_raw",
        lambda x: F.bround(F.when(F.col("_total") > 0, F.col("_left") * x / non_zero("_total")).otherwise(F.col("_left") / F.size("_raw")), 2),
    )
    each = each.withColumn("_share", share)
    drift = F.bround(100.0 - F.bround("_reserve_pct", 2) - F.bround("_bridge_pct", 2) - F.aggregate("_share", F.lit(0.0), lambda a, x: a + x), 2)
    each = each.withColumn("_drift", F.when(F.abs(drift) >= 0.01, drift).otherwise(0.0))

    def row(role, price, rank, pct, score, floor):
        parts = zip(("role", "limit_price", "entry_rank", "share_pct", "base_score", "floor_pct"), (role, price, rank, pct, score, floor))
        return F.struct(*[x.cast(k).alias(n) for (n, x), k in zip(parts, ("string", "double", "long", "double", "double", "double"))])

    reserve_score = F.greatest(F.col("core_score") * 0.72, F.lit(0.01)) * F.when(strong, 1.08).otherwise(1.0) * F.when(failed, 0.86).otherwise(1.0)
    bridge_score = (
        F.col("bridge._score") * (1 + 0.01 * F.least("bridge._fill", F.lit(100.0))) * F.when(strong, 0.92).otherwise(0.82) * F.when(high_trim, 0.92).otherwise(1.0)
    )

    def core(x, i):
        last = i == F.size("core") - 1
        pct = F.element_at("_share", i + 1)
        role = F.when(i == 0, "shallow_core").when(i == 1, "mid_core").otherwise("deep_core")
        score = x["_score"] * (1 + 0.015 * F.least(x["_fill"], F.lit(100.0)))
        shallow = F.when(strong, 1.02).otherwise(0.95) * F.when(high_trim & failed, 0.92).otherwise(1.0)
        deep = F.lit(1.08) * F.when(F.col("weakness"), 1.12).otherwise(1.0)
        score = score * F.when(i == 0, shallow).when(i >= 2, deep).otherwise(1.0)
        floor = F.when(F.col("weakness") & (i >= 2), F.least(F.greatest(pct * 0.35, F.lit(12.0)), pct)).otherwise(0.0)
        return row(role, x["limit_price"], x["entry_rank"], F.bround(pct + F.when(last, F.col("_drift")).otherwise(0.0), 2), F.bround(score, 6), F.bround(floor, 2))

    tranches = F.concat(
        F.array_compact(
            F.array(
                F.when(F.col("_reserve_pct") > 0, row(F.lit("continuation_reserve"), F.col("reserve"), F.lit(0), F.bround("_reserve_pct", 2), F.bround(reserve_score, 6), F.lit(0.0))),
                F.when(F.col("_bridge_pct") > 0, row(F.lit("bridge"), F.col("bridge.limit_price"), F.col("bridge.entry_rank"), F.bround("_bridge_pct", 2), F.bround(bridge_score, 6), F.lit(0.0))),
            )
        ),
        F.transform("core", core),
    )
    return each.select("ticker", F.explode(tranches).alias("_t")).select("ticker", "_t.*")


def allocate_with_caps(claims: DataFrame, budgets: DataFrame, book: str = "book") -> DataFrame:
    """Share each book's budget by score under caps, for all books at once.

    Filling by score until caps bind ends at ``min(cap, level * score)`` with one level per
    book. Claims are ordered by cap to score; totals below each ratio come from bucketed
    running totals, so even one huge book is never sorted in one task.
    """
    live = claims.filter("score > 0 and cap > 0").withColumn("_r", F.col("cap") / F.col("score"))
    totals = running_totals(live, [book], "_r", {"_c": F.col("cap"), "_s": F.col("score")})
    whole = totals.groupBy(book).agg(F.sum("_s").alias("_all"))
    filled, left = F.col("_c_below") + F.col("_c"), F.col("_all") - F.col("_s_below") - F.col("_s")
    steps = totals.join(whole, book).join(budgets.select(book, "budget"), book)
    full = filled + F.col("_r") * F.greatest(left, F.lit(0.0)) <= F.col("budget")
    level = steps.groupBy(book).agg(
        F.max("budget").alias("_b"),
        F.max("_all").alias("_all"),
        F.coalesce(F.max(F.when(full, filled)), F.lit(0.0)).alias("_done"),
        F.coalesce(F.max(F.when(full, F.col("_s_below") + F.col("_s"))), F.lit(0.0)).alias("_used"),
        F.count(F.when(~full, 1)).alias("_open"),
    )
    level = level.select(
        book, F.when(F.col("_open") > 0, (F.col("_b") - F.col("_done")) / non_zero(F.col("_all") - F.col("_used"))).alias("_level")
    )
    joined = claims.join(level, book, "left")
    share = F.least("cap", F.coalesce(F.col("_level") * F.col("score"), F.col("cap")))
    usable = (F.col("score") > 0) & (F.col("cap") > 0)
    return joined.withColumn("allocated", F.when(usable, F.greatest(share, F.lit(0.0))).otherwise(0.0)).drop("_level")


def floors_first(claims: DataFrame, budgets: DataFrame, book: str = "book") -> DataFrame:
    """Mandatory floors before the rest: floors scale down when they exceed the budget."""
    floors = claims.groupBy(book).agg(F.sum(F.least("floor", "cap")).alias("_f"))
    scaled = claims.join(floors, book).join(budgets, book)
    factor = F.least(F.lit(1.0), F.col("budget") / non_zero("_f"))
    rows = scaled.withColumn("floor_part", F.coalesce(F.least("floor", "cap") * factor, F.lit(0.0)))
    rest = budgets.join(floors, book).select(book, F.greatest(F.col("budget") - F.col("_f"), F.lit(0.0)).alias("budget"))
    claim = rows.drop("budget", "_f").withColumns({"_full": F.col("cap"), "cap": F.col("cap") - F.col("floor_part")})
    out = allocate_with_caps(claim, rest, book)
    return out.withColumns({"allocated": F.col("allocated") + F.col("floor_part"), "cap": F.col("_full")}).drop("_full")


def nested_caps(claims: DataFrame, groups: DataFrame, budgets: DataFrame, group: str, book: str = "book") -> DataFrame:
    """Share each book's budget by score under caps of its claims and of groups of claims within it.

    A group that reaches its cap stops at a level of its own; at that level its claims have what
    then are their caps, and one level fills the book. ``groups`` has (group, group_cap); a group
    without a row there, or with null, has no cap of its own. A group lies within one book.
    """
    limits = claims.groupBy(group).agg(F.sum("cap").alias("_all")).join(groups.select(group, "group_cap"), group, "left")
    limits = limits.select(group, F.when(F.col("group_cap").isNull(), F.col("_all")).otherwise(F.greatest("group_cap", F.lit(0.0))).alias("budget"))
    inner = allocate_with_caps(claims, limits, group).withColumns({"_cap": F.col("cap"), "cap": F.col("allocated")}).drop("allocated")
    out = allocate_with_caps(inner, budgets, book)
    return out.withColumn("cap", F.col("_cap")).drop("_cap")


def floors_under_caps(claims: DataFrame, budgets: DataFrame, group: str, group_cap: str, book: str = "book") -> DataFrame:
    """Floors first (scaled down where they exceed the book's budget), the rest by score under claim and group caps.

    ``group_cap`` is a column of ``claims``, the same for all of a group; floors count towards it.
    """
    floors = claims.groupBy(book).agg(F.sum(F.least("floor", "cap")).alias("_f"))
    factor = F.least(F.lit(1.0), F.col("budget") / non_zero("_f"))
    rows = claims.join(floors, book).join(budgets, book).withColumn("floor_part", F.coalesce(F.least("floor", "cap") * factor, F.lit(0.0)))
    rest = budgets.join(floors, book).select(book, F.greatest(F.col("budget") - F.col("_f"), F.lit(0.0)).alias("budget"))
    left = rows.groupBy(group).agg(F.greatest(F.max(group_cap) - F.sum("floor_part"), F.lit(0.0)).alias("group_cap"))
    rows = rows.drop("budget", "_f").withColumns({"_whole": F.col("cap"), "cap": F.col("cap") - F.col("floor_part")})
    out = nested_caps(rows, left, rest, group, book)
    return out.withColumns({"allocated": F.col("allocated") + F.col("floor_part"), "cap": F.col("_whole")}).drop("_whole")


def tranche_scores(tranches: DataFrame, context: DataFrame) -> DataFrame:
    """Tranches with their claim on the session's budget: ``score``, ``cap`` and ``floor`` in percent of the portfolio.

    ``context`` has a row per ticker: session_cap, conviction, strength, weakness, guide_bias,
    tape_bias, edge10. Tranches without a cap are left out.
    """
    near = F.col("role").isin("bridge", "continuation_reserve")
    factors = (
        (near & ~F.col("strength"), 0.88),
        (near & F.col("guide_bias").isin(*FAILED), 0.86),
        ((F.col("tape_bias") == "distribution") & (near | (F.col("role") == "shallow_core")), 0.9),
        ((F.col("tape_bias") == "absorption") & near, 1.05),
        (F.col("weakness") & (F.col("role") == "deep_core"), 1.12),
        (near & (F.coalesce("edge10", F.lit(0.0)) < 0), 0.9),
    )
    score = F.greatest("base_score", F.lit(0.0)) * F.greatest("conviction", F.lit(0.1))
    for when, factor in factors:
        score = score * F.when(when, factor).otherwise(1.0)
    cap = F.col("session_cap") * F.col("share_pct") / 100.0
    rows = tranches.join(context, "ticker").withColumn("_cap", cap).filter("_cap > 0")
    floor = F.least(F.col("_cap"), F.col("session_cap") * F.col("floor_pct") / 100.0)
    return rows.withColumns({"score": F.greatest(score, F.lit(0.01)), "cap": F.bround("_cap", 4), "floor": F.when(F.col("floor_pct") > 0, floor).otherwise(0.0)}).drop("_cap")
