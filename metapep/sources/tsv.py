"""Tab-separated tables without header, quotes or escapes; \\N is null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import validity_byte
from . import lz4


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, compression: str | None = None) -> DataFrame:
    """Rows of the schema; empty text fields stay empty, and a number that is none is an error.

    Spark's reader knows gzip, bzip2 and zstandard by their names; compression "lz4" is for
    LZ4 frames, without a header.
    """
    if header and compression == "lz4":
        raise ValueError("tables in LZ4 frames have no header")
    if header:
        df = spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", escape="", nullValue="\\N", emptyValue="", mode="FAILFAST")
        return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema])
    cells = F.split("value", "\t", -1)

    def cell(k: int, f: T.StructField):
        x = F.nullif(F.get(cells, F.lit(k)), F.lit("\\N"))
        if isinstance(f.dataType, T.BooleanType):
            return F.when(x == "\u0001", True).when(x == "\u0000", False).alias(f.name)
        return x.cast(f.dataType).alias(f.name)

    lines = lz4.read_lines(spark, path) if compression == "lz4" else spark.read.text(path)
    return lines.select(*[cell(k, f) for k, f in enumerate(schema)])


def write_tsv(df: DataFrame, path: str, compression: str | None = None, mode: str = "errorifexists") -> None:
    """One row a line: arrays joined by semicolons, booleans as control characters, nulls as \\N; compression is Spark's, or "lz4" for LZ4 frames that read_tsv() splits."""

    def cell(name: str, kind: str):
        if kind.startswith("array"):
            return F.array_join(F.col(name).cast("array<string>"), ";")
        return validity_byte(F.col(name)) if kind == "boolean" else F.col(name).cast("string")

    cells = [F.coalesce(cell(n, k), F.lit("\\N")) for n, k in df.dtypes]
    lines = df.select(F.concat_ws("\t", *cells).alias("value"))
    if compression == "lz4":
        lz4.write_lines(lines, path, mode=mode)
        return
    (lines.write.mode(mode).option("compression", compression) if compression else lines.write.mode(mode)).text(path)
