"""Session tranches and nested caps against plain loops."""

import math

import numpy as np
import pytest

from barloom.operators import decisions as D

LADDER = "ticker string, limit_price double, anchor_class string, entry_rank int, price_rank int, entry_score double, fill double"
CONTEXT = (
    "ticker string, last double, ask1 double, above1 double, weakness boolean, strength boolean, signal_age int, guide_bias string, guide_trim string"
)


def blueprint(ladder, c):
    """Roles, prices and shares of one instrument, step by step."""
    _, last, ask1, above1, weakness, strength, age, bias, trim = c
    rows = sorted(ladder, key=lambda r: (r[3], r[4]))
    old = [r for r in rows if r[2] in ("historical", "mixed")]
    rows = old or rows
    core = rows[:3]
    score, fill = lambda r: max(r[5] or 0, 0), lambda r: max(r[6] or 0, 0)
    high = max(r[1] for r in core)
    ahead = [p for p in (ask1, above1) if p is not None and p > 0 and p > high]
    reserve = min(ahead) if ahead else None
    failed = bias in ("failed_followthrough", "failed_day2_followthrough")
    reserve_pct = bridge_pct = 0.0
    bridge = None
    if (weakness or strength) and last is not None and high > 0 and last > high * 1.02:
        if reserve is not None and reserve <= last * 1.02:
            if bias in ("respect_day2_followthrough", "keep_core_trim_selectively"):
                reserve_pct = 9.0 if strength else 7.0
            elif bias == "normal_tactical_management":
                reserve_pct = 7.0 if strength else 5.5
            elif failed:
                reserve_pct = 4.0 if weakness else 0.0
            if trim == "high":
                reserve_pct = max(reserve_pct - 0.5, 0)
        over = sorted((r for r in rows if r[1] > high), key=lambda r: (r[1], r[3]))
        if over:
            bridge = over[0]
            bridge_pct = 7.5 + 1.5 * (age is not None and age <= 1) + (fill(bridge) - max(map(fill, core)) >= 15) + ((last / high - 1) * 100 >= 4)
            bridge_pct = min(bridge_pct + 0.5 * (trim == "high" and failed), 10.0)
    left = max(100 - reserve_pct - bridge_pct, 0)
    raw = [score(r) * (1 + 0.015 * min(fill(r), 100)) / math.sqrt(max(r[3], 1)) for r in core]
    shares = {id(r): round(left * x / sum(raw) if sum(raw) > 0 else left / len(core), 2) for r, x in zip(core, raw)}
    out = []
    if reserve is not None and reserve_pct > 0:
        out.append(["continuation_reserve", reserve, reserve_pct])
    if bridge and bridge_pct > 0:
        out.append(["bridge", bridge[1], bridge_pct])
    for role, r in zip(("shallow_core", "mid_core", "deep_core"), sorted(core, key=lambda r: -r[1])):
        out.append([role, r[1], shares[id(r)]])
    out[-1][2] = round(out[-1][2] + round(100 - sum(x[2] for x in out), 2), 2)
    return sorted((role, price, pct) for role, price, pct in out)


def test_blueprint_equals_plain_steps(spark):
    draw = np.random.default_rng(4)
    ladder, context, seen = [], [], set()
    biases = ["respect_day2_followthrough", "keep_core_trim_selectively", "normal_tactical_management", "failed_day2_followthrough", "neutral"]
    for k in range(160):
        t = f"t{k:03d}"
        n = int(draw.integers(1, 7))
        for i, p in enumerate(sorted(draw.choice(np.arange(80, 100), n, replace=False).tolist())):
            ladder.append((t, float(p), str(draw.choice(["historical", "mixed", "tactical"])), i + 1, n - i, None if draw.random() < 0.1 else float(draw.normal()), float(draw.integers(0, 100))))
        last = float(draw.integers(88, 106))
        price = lambda: None if draw.random() < 0.1 else last + float(draw.integers(-1, 4))
        context.append((t, last, price(), price(), bool(draw.random() < 0.5), bool(draw.random() < 0.5), None if draw.random() < 0.3 else int(draw.integers(0, 5)), str(draw.choice(biases)), str(draw.choice(["high", "light"]))))
    got = D.session_blueprint(spark.createDataFrame(ladder, LADDER), spark.createDataFrame(context, CONTEXT)).collect()
    for c in context:
        mine = sorted((r.role, r.limit_price, r.share_pct) for r in got if r.ticker == c[0])
        want = blueprint([r for r in ladder if r[0] == c[0]], c)
        assert [m[:2] for m in mine] == [w[:2] for w in want], c
        assert max(abs(m[2] - w[2]) for m, w in zip(mine, want)) < 0.0101 and abs(sum(m[2] for m in mine) - 100) < 1e-9
        seen |= {m[0] for m in mine}
    assert seen == {"continuation_reserve", "bridge", "shallow_core", "mid_core", "deep_core"}


def level_of(items, budget):
    """Bisect the level at which sum(min(cap, level * score)) meets the budget."""
    total = lambda x: sum(min(c, x * s) for s, c in items)
    if sum(c for _, c in items) <= budget:
        return math.inf
    low, high = 0.0, max(c / s for s, c in items)
    for _ in range(200):
        low, high = ((low + high) / 2, high) if total((low + high) / 2) < budget else (low, (low + high) / 2)
    return low


def test_nested_caps_meet_every_layer(spark):
    draw = np.random.default_rng(6)
    rows = [(b, f"{b}{g}", i, float(draw.random() + 0.1), float(draw.random() * 10)) for b in "xy" for g in range(4) for i in range(9)]
    caps = {f"{b}{g}": float(draw.random() * 30) for b in "xy" for g in range(3)}  # the fourth group has none
    budgets = {"x": 60.0, "y": 25.0}
    got = D.nested_caps(
        spark.createDataFrame(rows, "book string, grp string, item int, score double, cap double"),
        spark.createDataFrame(list(caps.items()), "grp string, group_cap double"),
        spark.createDataFrame(list(budgets.items()), "book string, budget double"), "grp",
    ).collect()
    mine = {(r.grp, r.item): r.allocated for r in got}
    for b in "xy":
        own = [r for r in rows if r[0] == b]
        levels = {g: level_of([r[3:] for r in own if r[1] == g], caps.get(g, math.inf)) for g in {r[1] for r in own}}
        inner = [(r[3], min(r[4], levels[r[1]] * r[3])) for r in own]
        top = level_of(inner, budgets[b])
        for r, (s, c) in zip(own, inner):
            assert abs(mine[r[1], r[2]] - min(c, top * s)) < 1e-6
        for g, cap in caps.items():
            assert sum(v for (k, _), v in mine.items() if k == g) <= cap + 1e-6
        assert sum(mine[r[1], r[2]] for r in own) == pytest.approx(min(budgets[b], sum(c for _, c in inner)))


def test_caps_of_names_and_sessions(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(50.0, "x", "light", "neutral"), (100.0, "x", "light", "neutral"), (100.0, "special_situation", "light", "n"), (100.0, "x", "high", "n"), (0.0, "x", "light", "n"), (10.0, "x", "light", "failed_followthrough")],
        "gap double, kind string, trim string, burst string",
    )
    got = [r.c for r in df.select(D.single_name_cap(*map(F.col, ("gap", "kind", "trim", "burst"))).alias("c")).collect()]
    assert got == [25.0, 30.0, 25.0, 22.5, 0.0, 4.0]
    df = spark.createDataFrame(
        [(4.0, 10.0, True, False, 0.0, False), (4.0, 10.0, True, True, 2.0, False), (0.5, 10.0, True, False, None, True), (0.0, 1.0, False, False, None, True), (4.0, 10.0, False, True, 0.5, False)],
        "a double, b double, weak boolean, strong boolean, edge double, kept boolean",
    )
    cap = D.session_cap(F.col("a"), F.col("b"), F.col("weak"), F.col("strong"), F.col("edge"), F.lit(0.25), F.col("kept"))
    assert [round(r.c, 6) for r in df.select(cap.alias("c")).collect()] == [4.0, 6.75, 2.0, 1.0, 2.5]
