"""Assertions that fail a program with all its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    if bad := repeats(df, keys).orderBy(*keys).limit(3).collect():
        raise ValueError(f"repeated {what}: {[tuple(r) for r in bad]}")
    return df


def require_none(df: DataFrame, bad: Column, what: str) -> DataFrame:
    if found := df.where(bad).limit(3).collect():
        raise ValueError(f"{what}: {found}")
    return df


def require_found(df: DataFrame, lookup: DataFrame, keys: list[str], what: str) -> DataFrame:
    if bad := df.select(*keys).distinct().join(lookup, keys, "left_anti").limit(3).collect():
        raise ValueError(f"no {what} for {[tuple(r) for r in bad]}")
    return df
