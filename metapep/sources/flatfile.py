"""Protein flat files: records of lines, ended by a line of two slashes.

Spark's text reader cuts files at a line end and a slash, whatever kind of line end a file
has.  Every piece but the first of a file then begins with the second slash of an end,
and the last piece of a file, be it blank or a record without end, is never a record:
so ends need no look at the files themselves, and compressed files are read once like
the others.  A record's place is its file, the offset of the block that Spark read it
from, and its place in there; that order is the files' own, however they are split.
Fields are decoded with column expressions: looked for in order, each from where the
last one ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata_cut
from ..storage import cut, join_checked, stored

# Database names in the first date line.
DATABASES = (("UniProtKB/Swiss-Prot.", "swissprot"), ("UniProtKB/TrEMBL.", "trembl"))
#: The place of a record: sorted by these columns, records are in file order, files by path.
PLACE = ("file", "block", "at")


def piece_value() -> Column:
    """The text of a piece that a reader with line ends of LF and a slash gives as `value`: without the end's second slash and line end, and with lines ending in LF."""
    return F.regexp_replace(F.regexp_replace("value", "\r(?=\n|$)", ""), "^/\n?", "")


def scan_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, at, value): the text between ends, lines ending in LF; read lazily, and in one pass.

    The last piece of every file is none of its records: without_tails() takes it away.
    """
    rows = spark.read.option("lineSep", "\n/").text(path)
    meta = F.col("_metadata")
    return rows.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), piece_value().alias("value"))


def without_tails(pieces: DataFrame) -> DataFrame:
    """The pieces but for the last of each file, found by one aggregate over places; pieces should be a table, of which that reads three columns."""
    last = pieces.groupBy("file").agg(F.max(F.struct("block", "at")).alias("l")).select("file", "l.*")
    return join_checked(pieces, cut(last), list(PLACE), "left_anti")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, at, value): one row a record of the files of a path (file, folder, glob or list).

    An end is a line that begins with two slashes; lines may end in LF or CR LF, file by
    file.  What follows the last end of a file, compressed or not, is no record and is
    dropped, and so are blank records.  Files are read once, into a table of the shared
    folder.  No line of a record may begin with one slash: it would be cut there, and
    be malformed.
    """
    return without_tails(stored(scan_pieces(spark, path), "records")).filter(F.col("value").rlike(r"\S"))


def _from(lines: Column, start: Column) -> Column:
    return F.slice(lines, start, F.size(lines) + 1)


def _first(lines: Column, prefix: str, holds: bool = True) -> Column:
    """Place from 1 of the first line with the prefix (or without it); 0 if there is none."""
    return F.array_position(F.transform(lines, lambda x: x.startswith(prefix)), F.lit(holds)).cast("int")


def _block(lines: Column, prefix: str) -> Column:
    """The leading lines with the prefix."""
    n = _first(lines, prefix, False)
    return F.when(n == 0, lines).otherwise(F.slice(lines, F.lit(1), n - 1))


def _names(block: Column) -> Column:
    """The preferred name of a description block."""
    begin = F.struct(F.lit(False).alias("dom"), F.lit(False).alias("comp"), F.array(*[F.lit(None).cast("string")] * 6).alias("names"))

    def step(s: Column, raw: Column) -> Column:
        line = F.ltrim(F.substring(raw, F.lit(6), F.length(raw)))
        rec, sub = line.startswith("RecName: Full="), line.startswith("SubName: Full=")
        at = F.when(s["dom"], 1).when(s["comp"], 0).otherwise(2) + F.when(rec, 0).otherwise(3)
        name = metadata_cut(F.substring(line, F.lit(15), F.length(line)))
        names = F.when(rec | sub, F.transform(s["names"], lambda x, i: F.when(i == at, name).otherwise(x))).otherwise(s["names"])
        return F.struct((s["dom"] | (line == "Includes:")).alias("dom"), (s["comp"] | (line == "Contains:")).alias("comp"), names.alias("names"))

    return F.coalesce(F.aggregate(block, begin, step, lambda s: F.get(F.filter(s["names"], lambda x: x.isNotNull()), F.lit(0))), F.lit(""))


def _references(block: Column, label: str, at: int, length: int) -> Column:
    own = F.filter(F.transform(block, lambda x: F.substring(x, F.lit(6), F.length(x))), lambda x: x.startswith(label))
    return F.transform(own, lambda x: F.substring(x, at + 1, length))


def parse_entries(records: DataFrame, column: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Entries of records: accession, version, taxon_id, type, name, sequence, ec, go, ipr, proteomes, and the other columns of records.

    Junk before the first AC line is skipped.  A record without AC, date, known
    database, taxon or sequence header is malformed: FAILFAST raises when it is read,
    PERMISSIVE keeps it with its complaint in a last column `error`, null for the others.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    rest = [c for c in records.columns if c != column]
    x = records.withColumn("_l", F.split(F.col(column), "\n"))
    x = x.withColumn("_ac", _first(F.col("_l"), "AC"))
    x = x.withColumn("_acs", F.substring(F.get("_l", F.col("_ac") - 1), 6, 1 << 20)).withColumn("_l", _from(F.col("_l"), F.col("_ac") + 1))
    x = x.withColumn("_dt", _first(F.col("_l"), "DT")).withColumn("_l", _from(F.col("_l"), F.greatest("_dt", F.lit(1))))
    x = x.withColumns({"_db": F.substring(F.get("_l", F.lit(0)), 35, 1 << 20), "_v": F.substring(F.get("_l", F.lit(2)), 33, 1 << 20), "_l": _from(F.col("_l"), F.lit(4))})
    x = x.withColumn("_de", _block(F.col("_l"), "DE")).withColumn("_l", _from(F.col("_l"), F.size("_de") + 1))
    x = x.withColumn("_ox", _first(F.col("_l"), "OX")).withColumns({"_tax": metadata_cut(F.substring(F.get("_l", F.col("_ox") - 1), 17, 1 << 20)), "_l": _from(F.col("_l"), F.col("_ox") + 1)})
    x = x.withColumn("_drn", _first(F.col("_l"), "DR"))
    x = x.withColumn("_dr", F.when(F.col("_drn") > 0, _block(_from(F.col("_l"), F.greatest("_drn", F.lit(1))), "DR")).otherwise(F.array().cast("array<string>")))
    x = x.withColumn("_l", F.when(F.col("_drn") > 0, _from(F.col("_l"), F.col("_drn") + F.size("_dr"))).otherwise(F.col("_l")))
    x = x.withColumn("_sq", _first(F.col("_l"), "SQ")).withColumn("_l", _from(F.col("_l"), F.col("_sq") + 1))
    kind = F.lit(None).cast("string")
    for text, name in DATABASES:
        kind = F.when(F.col("_db") == text, name).otherwise(kind)
    ec = F.filter(F.transform("_de", lambda r: F.ltrim(F.substring(r, F.lit(6), F.length(r)))), lambda line: line.startswith("EC="))
    error = (
        F.when(F.col("_ac") == 0, "no AC line")
        .when(F.instr("_acs", ";") == 0, "no accession")
        .when(F.col("_dt") == 0, "no DT line")
        .when(kind.isNull(), "unknown database")
        .when(F.col("_v").isNull(), "no version")
        .when(F.col("_ox") == 0, "no OX line")
        .when(F.expr("try_cast(_tax AS int)").isNull(), "no taxon")
        .when(F.col("_sq") == 0, "no SQ line")
    )
    out = x.select(
        *rest,
        F.substring_index("_acs", ";", 1).alias("accession"),
        F.substring("_v", F.lit(1), F.greatest(F.length("_v") - 1, F.lit(0))).alias("version"),
        F.expr("try_cast(_tax AS int)").alias("taxon_id"),
        kind.alias("type"),
        _names(F.col("_de")).alias("name"),
        F.array_join(F.transform("_l", lambda s: F.replace(F.substring(s, F.lit(6), F.length(s)), F.lit(" "), F.lit(""))), "").alias("sequence"),
        F.array_distinct(F.transform(ec, lambda line: metadata_cut(F.substring(line, F.lit(4), F.length(line))))).alias("ec"),
        _references(F.col("_dr"), "GO;", 4, 10).alias("go"),
        _references(F.col("_dr"), "InterPro;", 10, 9).alias("ipr"),
        _references(F.col("_dr"), "Proteomes;", 11, 11).alias("proteomes"),
        error.alias("error"),
    )
    return out if mode == "PERMISSIVE" else no_errors(out)


def no_errors(entries: DataFrame) -> DataFrame:
    """Entries of a PERMISSIVE parse; one that is malformed is an error when it is read."""
    told = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("malformed record: "), F.col("error"))).cast("string")).otherwise(F.col("accession"))
    return entries.withColumn("accession", told).drop("error")


def read_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entries of the files of a path, with their place; parsed as they are read, in one pass, and kept as a table in the shared folder.

    A malformed record is an error when it is read; the text behind a file's last end is no record.
    """
    pieces = scan_pieces(spark, path).withColumn("blank", ~F.col("value").rlike(r"\S"))
    return no_errors(without_tails(stored(parse_entries(pieces, mode="PERMISSIVE"), "entries")).filter("not blank").drop("blank"))
