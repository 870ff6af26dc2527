"""Unions by position and by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """By name; a column that a branch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending with NULLs last, the order the reports expect."""
    return df.orderBy(*[df[c].asc_nulls_last() for c in columns])
