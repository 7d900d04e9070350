"""All registered queries and their DuckDB statements."""

from __future__ import annotations

from feedlake.plans import audits, monitoring, payloads, platforms, queries, storage
from feedlake.plans.oracle import SQL

QUERIES = {**queries.REGISTRY, **monitoring.QUERIES, **payloads.QUERIES, **platforms.QUERIES, **storage.QUERIES, **audits.QUERIES}
ORACLE = {**SQL, **monitoring.ORACLE, **payloads.ORACLE, **platforms.ORACLE, **storage.ORACLE, **audits.ORACLE}
