"""Taxonomy dumps: nodes and names between bars."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ranks import REWRITES


def unzip_members(archive: str, folder: str, members: tuple[str, ...] = ("names.dmp", "nodes.dmp")) -> list[str]:
    """Takes the members out of a local archive; their paths."""
    with zipfile.ZipFile(archive) as z:
        return [z.extract(m, Path(folder)) for m in members]


def rewritten_rank(rank: Column) -> Column:
    """Ranks that the tables do not have become others: parts of the text, each at its first occurrence, in order."""
    out = rank
    for part, new in REWRITES:
        out = F.regexp_replace(out, f"^(.*?){part}", f"$1{new}")
    return out


def _fields(lines: DataFrame) -> DataFrame:
    return lines.select(F.transform(F.split("value", r"\|"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))).alias("f"))


def parse_nodes(lines: DataFrame) -> DataFrame:
    """(id, parent_id, rank) of lines `value`; a number that is none is an error."""
    f = F.col("f")
    return _fields(lines).select(f[0].cast("int").alias("id"), f[1].cast("int").alias("parent_id"), rewritten_rank(f[2]).alias("rank"))


def parse_names(lines: DataFrame) -> DataFrame:
    """(id, name) of the scientific names."""
    f = F.col("f")
    return _fields(lines).filter(f[3] == "scientific name").select(f[0].cast("int").alias("id"), f[1].alias("name"))


def taxa(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name, rank, parent_id); of repeated ids the largest row; every node must have a name."""
    one = nodes.groupBy("id").agg(F.max(F.struct("parent_id", "rank")).alias("n")).select("id", "n.*")
    called = names.groupBy("id").agg(F.max("name").alias("name"))
    return one.join(called, "id", "left").select("id", F.coalesce("name", F.raise_error(F.concat(F.lit("no name for taxon "), F.col("id").cast("string"))).cast("string")).alias("name"), "rank", "parent_id")


def read_taxa(spark: SparkSession, nodes_path: str, names_path: str) -> DataFrame:
    return taxa(parse_nodes(spark.read.text(nodes_path)), parse_names(spark.read.text(names_path)))
