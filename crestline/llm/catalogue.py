"""All queries of this subpackage, by name."""

from __future__ import annotations

from crestline.llm import cluster_queries, langid_queries, leak_queries, link_queries, notation_queries, packing_queries, survivor_queries

_PARTS = [survivor_queries, cluster_queries, link_queries, notation_queries, packing_queries, leak_queries, langid_queries]

QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: s for part in _PARTS for name, s in part.SQL.items()}
