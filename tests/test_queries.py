"""Registered queries against their SQL in DuckDB on the smallest tables.

A quick selection runs by default; ``BARLOOM_ALL=1`` runs every query.
"""

import os

import pytest

from barloom import plans
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUICK = (
    "daily_bars index_bars intraday_bars latest_vs_sma20 bar_upsert_keep_last statement_facts coverage_gaps page_label_values "
    "number_normalisation ema_series price_bands tick_grid instrument_panel market_rules point_in_time_facts factor_shocks "
    "regime_states weekly_context horizon_targets tape_summary burst_patterns signal_trades timing_metrics capped_allocation "
    "streaming_bars streaming_latest page_script_members rsi_series market_regime_targets"
).split()
#: Queries that SQL cannot express, and the unit test that holds each one's operator against brute force.
WITHOUT_SQL = {
    **dict.fromkeys(
        "ohlc_walk_forward next_session_forecast rest_of_session_forecast".split(), "test_operators.test_grouped_ridge_matches_normal_equations"
    ),
    **dict.fromkeys("range_forecast timing_forecast cycle_forecast".split(), "test_chain.test_race_chooses_by_held_out_error"),
    **dict.fromkeys(
        "model_metrics_by_ticker entry_ladder_from_models verdicts_from_models watchlist_from_models".split(),
        "test_chain.test_chain_equals_sql_over_stored_scores",
    ),
    "color_classifier": "test_operators.test_grouped_forecast_by_days",
    **dict.fromkeys("touch_classifier fill_model_choice".split(), "test_chain.test_fill_choice_equals_sql_over_stored_scores"),
    "feature_set_lift_fitted": "test_chain.test_lift_equals_sql_over_stored_scores",
    "pooled_outperform": "test_model_queries.test_pooled_outperform_equals_separate_fits",
    "market_direction": "test_model_queries.test_market_direction_equals_separate_fits",
    "pooled_outperform_boosted": "test_operators.test_pooled_walk_forward_sees_the_past_only",
}
NAMES = list(plans.QUERIES) if os.environ.get("BARLOOM_ALL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    columns, rows, same, _, _, note = compare(spark, con, name, plans.QUERIES[name], plans.ORACLES.get(name), SF)
    assert same if plans.ORACLES.get(name) else columns, note


def test_check_sql_belongs_to_queries():
    assert set(plans.ORACLES) <= set(plans.QUERIES)


def test_queries_without_sql_have_a_unit_test():
    import importlib

    assert set(plans.QUERIES) - set(plans.ORACLES) == set(WITHOUT_SQL)
    for test in set(WITHOUT_SQL.values()):
        module, function = test.split(".")
        assert hasattr(importlib.import_module(f"tests.{module}"), function), test
