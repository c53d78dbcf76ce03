"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from barloom import plans
from barloom.session import build_session

HEADLINE = (
    "daily_bars supplier_bars latest_vs_sma20 ema_series rsi_series macd_series technical_snapshot tick_grid "
    "market_breadth_summary sector_summary relative_strength feature_panel market_rules pick_replay point_in_time_facts "
    "factor_sensitivity factor_shocks weekly_context regime_states horizon_targets excursion_targets intraday_bars "
    "intraday_snapshots signal_trades playbook_scores ohlc_metrics_by_ticker classification_metrics capped_allocation "
    "entry_ladder streaming_bars"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans.QUERIES["daily_bars"](spark, folder).count()  # start-up and code loading
    times = {}
    for name in HEADLINE:
        started = time.time()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries, all rows computed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
