"""All queries of the engine with their SQL."""

from __future__ import annotations

from lodestream.plans import artifact_queries, feed_queries, output_queries, queries, state_queries, stream_queries

_MODULES = (queries, feed_queries, state_queries, output_queries, stream_queries, artifact_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
