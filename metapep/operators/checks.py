"""Constraints that Spark does not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n): the keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    if rows := repeated(df, *keys).limit(3).collect():
        raise ValueError(f"not unique by {keys}: {rows}")
    return df


def assert_not_null(df: DataFrame, *columns: str) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    if bad := {c: n for c, n in counts.items() if n}:
        raise ValueError(f"null values: {bad}")
    return df
