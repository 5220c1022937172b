"""All queries of the core, by name."""

from __future__ import annotations

from crestline.plans import address_queries, cluster_queries, fixture_queries, result_queries, score_queries, skew_queries

_PARTS = [skew_queries, address_queries, result_queries, score_queries, cluster_queries, fixture_queries]

QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: s for part in _PARTS for name, s in part.SQL.items()}
