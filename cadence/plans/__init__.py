"""Named queries over the driver tables (``queries()`` / ``oracle_sql()`` of the entry module)."""

from cadence.plans.catalog import OPERATORS, ORACLE, QUERIES, load_all, query

__all__ = ["OPERATORS", "ORACLE", "QUERIES", "load_all", "query"]
