"""Registered queries and their oracle SQL."""

from __future__ import annotations


def all_queries() -> dict:
    from leadtide.catalog import basics, learning, reports

    return {**basics.QUERIES, **reports.QUERIES, **learning.QUERIES}


def all_oracles() -> dict[str, str]:
    from leadtide.catalog import oracles_basics, oracles_learning, oracles_reports

    return {**oracles_basics.ORACLES, **oracles_reports.ORACLES, **oracles_learning.ORACLES}
