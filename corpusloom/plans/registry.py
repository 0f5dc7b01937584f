"""All queries of the core with their SQL, by name."""

from __future__ import annotations

from corpusloom.plans import chunk_queries, profile_queries, reference_queries, vector_queries

CORE = {**reference_queries.QUERIES, **chunk_queries.QUERIES, **profile_queries.QUERIES, **vector_queries.QUERIES}
