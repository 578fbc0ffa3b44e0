"""Shared storage, tables that are removed after use, and size-checked joins."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of a side that is sent to every executor; above, Spark joins by shuffle.
BROADCAST_BYTES = 8 << 20

#: Spark's switch for shuffle files: whether they go at the end of a query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: By thread, so that jobs of other threads (batches of a stream, say) keep theirs apart.
_SCRATCH = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where it is unset, a local master (tests) has a temporary folder; on a cluster that is
    an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), f"metapep-{os.getuid()}-checkpoints")
        os.makedirs(d, exist_ok=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """The same rows without their lineage, kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go as soon as each is over, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, keep: bool = False, compact: bool = False) -> DataFrame:
    """The same rows as a Parquet table in the shared folder; within scratch() it goes at the end unless kept.

    compact: for large tables; in Zstandard, and without the shuffle files that it was made from.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if compact:
        with shuffles_dropped(spark):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    if (open_ := getattr(_SCRATCH, "open", None)) and not keep:
        open_[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, where = _hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that stored() writes inside are removed at the end; lazy results that read them must have been written by then."""
    _SCRATCH.open = [*getattr(_SCRATCH, "open", []), []]
    try:
        yield
    finally:
        for path in _SCRATCH.open.pop():
            remove(spark, path)


def _width(df: DataFrame) -> Column:
    """About the bytes of a row: 8 a number, 16 and the text's own for text, JSON for the rest."""
    fixed, parts = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)) + 16)
        else:
            fixed += 8
    return sum((p.cast("long") for p in parts), F.lit(fixed).cast("long"))


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the rows take at most so many bytes; reads no more rows than that takes."""
    limit = BROADCAST_BYTES if limit is None else limit
    rows = limit // (8 * max(1, len(df.columns)))
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return n <= rows and size <= limit


def join_checked(left: DataFrame, right: DataFrame, on, how: str, limit: int | None = None) -> DataFrame:
    """Join; right goes to every executor only if it is shown to be small, in bytes, else Spark shuffles (and splits skewed keys).

    right is read once more for that, so it should be a table or cut from its lineage.
    """
    few = is_small(right, limit)
    return left.join(F.broadcast(right) if few else right, on, how)


def join_looked_up(rows: DataFrame, table: DataFrame, taken: str, key: str, how: str = "left", limit: int | None = None) -> DataFrame:
    """rows with what the table has for their column `taken`, by its unique `key` (of another name, and left out); how: left, inner or left_semi.

    If the table is too large to be sent whole, the values that rows have are looked up
    first, each once: of a large table few rows may be asked for, which then are sent,
    and rows of few values are never dealt out by them.  rows are read once more for that.
    """
    few = is_small(table, limit)
    if not few:
        table = cut(table.join(rows.select(F.col(taken).alias(key)).distinct(), key, "left_semi"))
    out = rows.join(F.broadcast(table), F.col(taken) == F.col(key), how) if few else join_checked(rows, table, F.col(taken) == F.col(key), how, limit)
    return out.drop(key)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that their Python workers can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="metapep-")) / "metapep_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
