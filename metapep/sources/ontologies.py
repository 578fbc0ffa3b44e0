"""Ontology lists: enzyme classes and entries, OBO terms, InterPro entries, proteomes, release version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import namespace_text
from ..operators.numbering import number_rows
from .tsv import read_tsv


def enzyme_classes(lines: DataFrame) -> DataFrame:
    """(code, name) of lines `value` that begin with a digit but 0."""
    tight = F.regexp_replace("value", r"\. *([-0-9])", ".$1")
    both = F.split(F.regexp_replace(tight, r"\.*$", ""), " +", 2)
    return lines.filter(F.col("value").rlike("^[1-9]")).select(both[0].alias("code"), F.coalesce(F.get(both, F.lit(1)), F.lit("")).alias("name"))


def enzyme_entries(records: DataFrame) -> DataFrame:
    """(code, name) of records `value`.

    A name is the second field of every DE line, fields being apart by three blanks,
    each without its last character and with nothing between; that is the format of
    the table, not of the source.
    """
    lines = F.split("value", "\n")
    ids = F.filter(lines, lambda x: x.startswith("ID"))
    de = F.transform(F.filter(lines, lambda x: x.startswith("DE")), lambda x: F.coalesce(F.get(F.split(x, "   "), F.lit(1)), F.lit("")))
    name = F.array_join(F.transform(de, lambda x: F.regexp_replace(x, ".$", "")), "")
    return records.filter(F.size(ids) > 0).select(F.get(F.split(F.get(ids, F.lit(0)), "   "), F.lit(1)).alias("code"), name.alias("name"))


def obo_terms(stanzas: DataFrame) -> DataFrame:
    """(code, namespace, name): a row for each id and alternative id of every [Term] stanza `value`; obsolete terms stay."""
    lines = F.filter(F.split("value", "\n"), lambda x: x != "")
    own = stanzas.filter(F.get(lines, F.lit(0)) == "[Term]").select(lines.alias("l"))
    text = lambda x: F.regexp_replace(x, r"^[^:]*: ", "")
    value = lambda key: F.coalesce(F.get(F.reverse(F.transform(F.filter("l", lambda x: x.startswith(f"{key}:")), text)), F.lit(0)), F.lit(""))
    ids = F.transform(F.filter("l", lambda x: x.startswith("id") | x.startswith("alt_id")), text)
    return own.select(F.explode(ids).alias("code"), namespace_text(value("namespace")).alias("namespace"), value("name").alias("name"))


def interpro_entries(lines: DataFrame) -> DataFrame:
    """(code, category, name) of lines `value` that begin with IPR."""
    f = F.split("value", "\t")
    return lines.filter(F.col("value").startswith("IPR")).select(f[0].alias("code"), F.get(f, F.lit(1)).alias("category"), F.get(f, F.lit(2)).alias("name"))


def reference_proteomes(spark: SparkSession, path: str) -> DataFrame:
    """(upid, organism_id, protein_count) of a table with a header line."""
    schema = T.StructType([T.StructField("upid", T.StringType()), T.StructField("organism_id", T.IntegerType()), T.StructField("protein_count", T.IntegerType())])
    return read_tsv(spark, path, schema, header=True)


def release_version(documents: DataFrame) -> DataFrame:
    """(version) of XML documents `value`: the first element named version in any namespace, its first underscore as a dot; none is an error."""
    found = F.regexp_replace(F.xpath_string("value", F.lit('//*[local-name()="version"]')), "^([^_]*)_", "$1.")
    return documents.select(F.when(F.length(found) > 0, found).otherwise(F.raise_error(F.lit("no version")).cast("string")).alias("version"))


def read_ec_numbers(spark: SparkSession, classes_path: str, entries_path: str) -> DataFrame:
    """(id, code, name): classes, then entries, numbered in file order."""
    at = F.monotonically_increasing_id().alias("_o")
    classes = enzyme_classes(spark.read.text(classes_path)).select(F.lit(0).alias("_s"), at, "code", "name")
    entries = enzyme_entries(spark.read.option("lineSep", "\n//\n").text(entries_path)).select(F.lit(1).alias("_s"), at, "code", "name")
    return number_rows(classes.union(entries), ["_s", "_o"]).select("id", "code", "name")


def read_go_terms(spark: SparkSession, path: str) -> DataFrame:
    """(id, code, namespace, name), in file order; a last stanza that no blank line follows counts too."""
    terms = obo_terms(spark.read.option("lineSep", "\n\n").text(path)).select(F.monotonically_increasing_id().alias("_o"), "code", "namespace", "name")
    return number_rows(terms, ["_o"]).select("id", "code", "namespace", "name")


def read_interpro(spark: SparkSession, path: str) -> DataFrame:
    """(id, code, category, name), in file order."""
    rows = interpro_entries(spark.read.text(path)).select(F.monotonically_increasing_id().alias("_o"), "code", "category", "name")
    return number_rows(rows, ["_o"]).select("id", "code", "category", "name")


def read_release(spark: SparkSession, path: str) -> DataFrame:
    return release_version(spark.read.option("wholetext", True).text(path))
