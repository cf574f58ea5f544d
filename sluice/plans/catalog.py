"""All queries and their SQL."""

from sluice.plans import call_queries, cast_queries, record_queries

QUERIES = {**record_queries.QUERIES, **cast_queries.QUERIES, **call_queries.QUERIES}
SQL = {**record_queries.SQL, **cast_queries.SQL, **call_queries.SQL}
