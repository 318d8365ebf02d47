"""Named queries over the given tables, and the same results in plain SQL."""

from millrace.catalog.oracle import ORACLE
from millrace.catalog.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
