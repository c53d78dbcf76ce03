"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The statements before their sub-selects are put in front.
STATEMENTS: dict[str, str] = {}
_VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    """A named sub-select that check SQL may refer to."""
    _VIEWS[name] = sql.strip()


def view_text(name: str) -> str:
    return _VIEWS[name]


def with_views(sql: str, replaced: dict[str, str] | None = None) -> str:
    """Prefix the statement with the named sub-selects it needs, in order of definition.

    ``replaced`` gives other texts for some of them, such as a table of stored scores.
    """
    views = _VIEWS | (replaced or {})
    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & views.keys() - needed:
            needed.add(name)
            pending.append(views[name])
    parts = [f"{name} as ({views[name]})" for name in views if name in needed]
    body = sql.strip()
    if not parts:
        return body
    if body[:14].lower() == "with recursive":
        return "with recursive " + ",\n".join(parts) + ",\n" + body[14:]
    if body[:5].lower() == "with ":
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        QUERIES[name] = fn
        if sql is not None:
            STATEMENTS[name] = sql
            ORACLES[name] = with_views(sql)
        return fn

    return register
