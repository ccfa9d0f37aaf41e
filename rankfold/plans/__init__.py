from rankfold.plans.catalog import QUERIES
from rankfold.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
