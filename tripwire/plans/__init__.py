"""Named query plans over the test tables (the ``queries()`` registry) and
their DuckDB twins (``oracle_sql()``)."""

from tripwire.plans.catalog import batch_queries, flagship
from tripwire.plans.oracle import oracle_queries

__all__ = ["batch_queries", "flagship", "oracle_queries"]
