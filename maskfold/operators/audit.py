"""Audit column removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def drop_audit(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop batch-audit columns when present (a missing name is a no-op)."""
    return df.drop(*columns)
