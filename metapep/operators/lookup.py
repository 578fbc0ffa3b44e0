"""Lookups: exact, by words, and in the peptide and k-mer indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut, join_checked


def tokens(text: Column) -> Column:
    """Distinct words of letters and digits in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{Nd}]+"), lambda x: x != ""))


def inverted_index(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(token, key): which rows hold a word in one of the columns; written bucketed by token it serves lookups without a scan."""
    return df.select(F.explode(F.array_distinct(F.flatten(F.array(*[tokens(F.col(c)) for c in columns])))).alias("token"), key).distinct()


def search(df: DataFrame, text: str, *columns: str) -> DataFrame:
    """The rows that hold every word of the text in one of the columns or another."""
    wanted = tokens(F.lit(text))
    return df.filter((F.size(wanted) > 0) & F.forall(wanted, lambda w: F.exists(F.array(*[tokens(F.col(c)) for c in columns]), lambda t: F.array_contains(t, w))))


def exact(df: DataFrame, **values: object) -> DataFrame:
    """The rows with the given values; on Parquet the filters reach the scan."""
    out = df
    for name, value in values.items():
        out = out.filter(F.col(name) == F.lit(value))
    return out


def in_index(wanted: DataFrame, index: DataFrame, key: str = "sequence") -> DataFrame:
    """The wanted rows with the columns of the index; null where the index has none.

    Each key is looked up once: distinct keys are dealt out like the index's buckets and
    merged with them, so an index of write_index() is not shuffled, and a key that very many
    rows want is no skew.
    """
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    return join_checked(wanted, cut(keys.join(index.hint("merge"), key)), key, "left")


def under_taxon(rows: DataFrame, tree: DataFrame, taxon: int, number: str = "taxon_first") -> DataFrame:
    """The rows whose taxon lies below the given one, itself included, by its range in a nested_set(); on a table sorted by the number only that range is read."""
    found = tree.filter(F.col("id") == taxon).select("first", "last").first()
    return rows.filter(F.col(number).between(found["first"], found["last"]) if found else F.lit(False))


#: Ids of a block of postings.
POSTINGS = 1 << 16


def posting_blocks(index: DataFrame, key: str, block: int = POSTINGS) -> DataFrame:
    """(token, block, n, ids): the sorted ids of an inverted_index(), by ranges of ids, so a frequent word is many rows of bounded size."""
    own = index.withColumn("block", F.floor(F.col(key) / block).cast("long"))
    return own.groupBy("token", "block").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(key)).alias("ids"))


def search_blocks(blocks: DataFrame, text: str, key: str) -> DataFrame:
    """(key): which rows of a table of posting_blocks() hold every word of the text.

    Only the words' buckets are read; blocks that miss a word go before anything is
    intersected, and the lists of a block are, from the shortest on.
    """
    words = [r.t for r in blocks.sparkSession.range(1).select(F.explode(tokens(F.lit(text))).alias("t")).collect()]  # the words of a query
    own = blocks.filter(F.col("token").isin(words)).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("n", "ids"))).alias("l"))
    lists = F.filter("l", lambda x: x["n"] > 0)["ids"]
    common = F.aggregate(lists, F.get(lists, F.lit(0)), lambda a, x: F.array_intersect(a, x))
    return own.filter((F.size("l") == len(words)) & F.lit(bool(words))).select(F.explode(common).alias(key))
