"""What the operators of this subpackage share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..storage import cut, join_checked, shared_dir, stored

__all__ = ["bounded_batches", "cut", "join_checked", "partitions", "shared_dir", "stored", "table"]


#: Most bytes that a Python worker gets at once, but for a longer row.
BATCH_BYTES = 8 << 20
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def size_of_setting(value: str | None) -> int:
    """Bytes of a setting such as 64m or 1gb; no limit (0 or none) as a large number."""
    m = re.fullmatch(r"\s*(\d+)\s*([bkmgtp]?)b?\s*", str(value or "").lower())
    return (int(m[1]) * _UNITS[m[2]] if m else 0) or 1 << 62


def bounded_batches(df: DataFrame) -> None:
    """Limits Arrow batches by bytes, for rows of long texts, unless the session has a smaller limit; by default they are limited by rows alone.

    The limit is read when a query runs, which is after an operator has returned, so it stays in the session.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if size_of_setting(conf.get(name, None)) > BATCH_BYTES:
        conf.set(name, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    """Parts for a shuffle that must keep up with the input: as many as it is read in, or the session's number if that is more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
