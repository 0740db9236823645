"""All named queries of the engine and their SQL."""

from __future__ import annotations

from veilframe import queries, queries_plan  # noqa: F401  the second adds to the first's tables

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
