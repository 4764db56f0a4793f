"""The subpackage's named queries and their SQL."""

from __future__ import annotations

from headwaykit.llm import sequence_queries, text_queries

MODULES = [sequence_queries, text_queries]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
