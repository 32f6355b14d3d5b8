"""All registered queries with the SQL that checks them."""

from __future__ import annotations

from leadline.plans import log_oracles, log_queries, table_oracles, table_queries, view_oracles, view_queries

QUERIES = {**table_queries.QUERIES, **log_queries.QUERIES, **view_queries.QUERIES}
ORACLE_SQL = {**table_oracles.ORACLE_SQL, **log_oracles.ORACLE_SQL, **view_oracles.ORACLE_SQL}
