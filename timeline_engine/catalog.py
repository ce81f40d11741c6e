"""All queries of the engine with their SQL oracles."""

from __future__ import annotations

from .plans import aggregate_queries, bitmap_queries, join_queries, report_queries, run_queries, segment_queries, sequence_queries, sweep_queries

_PARTS = (run_queries, join_queries, aggregate_queries, sequence_queries, bitmap_queries, segment_queries, sweep_queries, report_queries)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
