"""Dense numbering without a single-task window."""

from __future__ import annotations

import re
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut, join_checked, shuffles_dropped, stored


def number_rows(df: DataFrame, order: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """df with a first column of numbers from start, in the order of the columns (bytewise for text).

    Rows are sorted by range into parts, the parts counted, and each part numbered
    from the count of those before it.  What is collected is a count a part.  Sorted rows
    are kept as a compressed table, as a checkpoint of them takes many times the disk.
    """
    mask = (1 << 33) - 1
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    # Parquet has neither of these types
    ordered = cut(ordered) if {"void", "interval"} & set(re.findall(r"\w+", df.schema.simpleString())) else stored(ordered, "numbered", keep=True, compact=True)
    part = F.shiftright("_at", 33)
    with shuffles_dropped(df.sparkSession):
        counts = {r.p: r.n for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before = accumulate((counts.get(p, 0) for p in range(max(counts, default=0))), initial=start)
    offset = F.get(F.array(*map(F.lit, before)), part.cast("int"))
    return ordered.select((offset + F.col("_at").bitwiseAND(F.lit(mask))).cast("long").alias(name), *df.columns)


def running_offsets(df: DataFrame, count: Column, name: str = "before", id_: str = "id", block: int = 1 << 20) -> DataFrame:
    """df with the sum of `count` over all rows of smaller id, for dense ids from 1: sums by blocks of ids, then inside each block; no task holds more than a block."""
    rows = df.withColumn("_n", count.cast("long")).withColumn("_b", F.floor(F.col(id_) / block))
    sums = cut(rows.groupBy("_b").agg(F.sum("_n").alias("_s")))
    every = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    base = sums.select("_b", F.coalesce(F.sum("_s").over(every), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_b").orderBy(id_).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return join_checked(out, cut(base), "_b", "inner").select(*df.columns, (F.col("_base") + F.col("_inside")).alias(name))


def union_numbered(first: DataFrame, second: DataFrame, column: str = "sequence") -> DataFrame:
    """(id, column): the distinct values of both, numbered in byte order."""
    return number_rows(first.select(column).union(second.select(column)).distinct(), [column])


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of the rows of a key the last in order; a partial aggregate, so a frequent key is no skew."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return last.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])
