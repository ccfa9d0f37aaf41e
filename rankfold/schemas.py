"""A plan-time check of the columns an operator needs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, *cols: str, what: str = "input") -> None:
    """Fail at plan time (no job) when ``df`` lacks any of ``cols``."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing column(s) {missing}; has {df.columns}")
