"""An equi-join that a hot key does not slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot where it holds this part of all rows, so there are at most so many hot keys.
HOT_PART = 4096


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys of ``rows`` that hold one in ``HOT_PART`` of them or more: ``HOT_PART`` rows at most, whatever the input."""
    total = rows.count()
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * HOT_PART >= total).select(key)


def spread_join(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` (a stored table) with ``side`` (one row a key). Rows of hot keys meet a broadcast of these keys'
    side rows, whose number is bounded, and stay where they are; all others are shuffled."""
    hot = hot_keys(rows, key)
    near = rows.join(F.broadcast(side.join(F.broadcast(hot), key, "left_semi")), key)
    return near.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(side, key))
