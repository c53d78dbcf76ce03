"""Queries over the driver's tables, grouped by theme."""

from barloom.plans import inputs, ingest, snapshot, panel, market, features, intraday, trades, metrics, decisions, models, chain, files, streams  # noqa: F401
from barloom.plans.registry import ORACLES, QUERIES  # noqa: F401
