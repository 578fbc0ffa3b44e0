"""Ingest of new flat files as a stream, merged by accession.

Every batch writes what it changed, and what it could not use, to folders of its own, so
a batch that runs again overwrites itself; its own and later changes never count when it
asks what is known.  The state is the latest snapshot before the batch and the changes
since, of which a batch reads accession, version and digest.  Snapshots are made every
so many batches; the one before stays, for a batch that has to run again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.numbering import last_by_key
from ..sources.flatfile import parse_entries, piece_value
from ..storage import cut, exists, join_checked, listed, remove, scratch, stored

FIELDS = ("version", "taxon_id", "type", "name", "sequence", "ec", "go", "ipr", "proteomes")


def read_entry_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, value): the text between record ends of the flat files that arrive in a folder."""
    meta = F.col("_metadata")
    rows = spark.readStream.option("lineSep", "\n/").text(folder)
    return rows.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), piece_value().alias("value"))


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The batches whose folder of a kind was written whole."""
    found = [int(m[1]) for name in listed(spark, f"{path}/{kind}") if (m := re.fullmatch(r"batch=(\d+)", name))]
    return sorted(n for n in found if exists(spark, f"{path}/{kind}/batch={n}/_SUCCESS"))


def current_entries(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The entry of every accession (before a batch): the latest snapshot, and of the changes since the last ones; None before the first batch."""
    fits = lambda kind: [n for n in _numbers(spark, path, kind) if before is None or n < before]
    base = fits("snapshots")[-1:]
    since = [n for n in fits("changes") if not base or n > base[0]]
    folders = [*[f"{path}/snapshots/batch={n}" for n in base], *[f"{path}/changes/batch={n}" for n in since]]
    if not folders:
        return None
    rows = spark.read.parquet(folders[-1])
    rows = spark.read.schema(rows.schema).parquet(*folders)
    return rows if len(folders) == 1 else last_by_key(rows, "accession", "batch")


def merge_batch(batch: DataFrame, path: str, number: int, snapshot_every: int = 16) -> DataFrame:
    """The entries that a batch of read_entry_stream() brings or changes, written under path/changes/batch=<number>.

    Of an accession the largest entry version wins, wherever and whenever it arrives; of
    one version the last that arrives.  An entry that says what is known changes nothing,
    and an older version changes nothing.  Malformed records, and the text behind the
    last end of a file, go to path/quarantine/batch=<number> with file, block and error.
    """
    spark = batch.sparkSession
    pieces = batch.withColumn("at", F.monotonically_increasing_id()).withColumn("raw", F.col("value"))
    parsed = parse_entries(pieces, mode="PERMISSIVE")
    with scratch(spark):
        rows = stored(parsed.withColumn("blank", ~F.col("raw").rlike(r"\S")), "pieces")
        last = cut(rows.groupBy("file").agg(F.max(F.struct("block", "at")).alias("l")).select("file", "l.*", F.lit(True).alias("tail")))
        rows = join_checked(rows, last, ["file", "block", "at"], "left").filter("not blank")
        error = F.when(F.col("tail"), "no end").otherwise(F.col("error"))
        rows = rows.withColumn("error", error)
        bad = rows.filter("error is not null").select("file", "block", "error", F.col("raw").alias("value"))
        bad.write.mode("overwrite").parquet(f"{path}/quarantine/batch={number}")
        good = rows.filter("error is null").withColumn("entry_version", F.coalesce(F.expr("try_cast(version AS long)"), F.lit(0).cast("long")))
        good = good.withColumn("digest", F.xxhash64(*FIELDS)).withColumn("_order", F.struct("entry_version", "file", "block", "at"))
        good = last_by_key(good.select("accession", *FIELDS, "entry_version", "digest", "_order"), "accession", "_order").drop("_order")
        known = current_entries(spark, path, number)
        if known is not None:
            good = cut(good)
            old = known.select("accession", F.col("entry_version").alias("_v"), F.col("digest").alias("_d"))
            old = cut(join_checked(old, good.select("accession"), "accession", "left_semi"))
            good = join_checked(good, old, "accession", "left")
            newer = (F.col("entry_version") > F.col("_v")) | ((F.col("entry_version") == F.col("_v")) & (F.col("digest") != F.col("_d")))
            good = good.filter(F.col("_v").isNull() | newer).drop("_v", "_d")
        good.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
    if (number + 1) % snapshot_every == 0:
        snapshot(spark, path, number)
    return spark.read.parquet(f"{path}/changes/batch={number}")


def snapshot(spark: SparkSession, path: str, number: int) -> None:
    """All entries up to a batch as one table; older snapshots but the one before go, and the changes that it holds."""
    remove(spark, f"{path}/snapshots/batch={number}")  # of a batch that runs again
    current_entries(spark, path, number + 1).write.mode("overwrite").parquet(f"{path}/snapshots/batch={number}")
    kept = [n for n in _numbers(spark, path, "snapshots") if n <= number][-2:]
    for kind, gone in (("snapshots", lambda n: n < kept[0]), ("changes", lambda n: len(kept) > 1 and n <= kept[0])):
        for n in _numbers(spark, path, kind):
            if gone(n):
                remove(spark, f"{path}/{kind}/batch={n}")


def upsert_entries(stream: DataFrame, path: str, checkpoint: str, once: bool = True, then: Callable[[DataFrame, int], None] | None = None, snapshot_every: int = 16) -> StreamingQuery:
    """Merges every batch of a read_entry_stream(), then calls then(its changes, its number).

    A batch that runs again gives the same changes, so the sink is exactly-once;
    `then` may be called again with them.
    """

    def write(batch: DataFrame, number: int) -> None:
        changed = merge_batch(batch, path, number, snapshot_every)
        if then:
            then(changed, number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
