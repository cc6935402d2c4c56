"""Registered queries, their inputs and their SQL counterparts."""

from __future__ import annotations


def all_queries():
    """Name -> query, with every query module loaded."""
    from starsift.plans import model_queries, score_queries, source_queries, table_queries  # noqa: F401
    from starsift.plans.registry import QUERIES

    return dict(QUERIES)
