"""The query catalogue over the driver tables, its SQL oracle, plan checks."""

from urbanlens.plans.catalog import QUERIES
from urbanlens.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
