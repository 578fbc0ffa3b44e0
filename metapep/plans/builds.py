"""Builds from input paths to written tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ranks import ENTRIES, INDEX, LINEAGES
from ..sources import flatfile
from ..sources.ontologies import reference_proteomes
from ..sources.search_sink import bulk_load
from ..sources.taxdump import read_taxa
from ..sources.tsv import read_tsv, write_tsv
from . import check_sources, have, kmer_index, search_documents, suffix_array_tables, tryptic_tables

#: Columns that put the entries of read_entries() in order.
ORDER = ["database", *flatfile.PLACE]


def read_entries(spark: SparkSession, flatfiles: Mapping[str, str], sources: str = "swissprot,trembl") -> DataFrame:
    """Entries of the named databases with their fields and place: by ORDER, in the order of the databases and of their files.

    flatfiles: path (file, folder or glob) by database.  Databases that are not asked for
    are not read; a path that does not exist, or a malformed record, is an error.  Files
    are parsed once: the entries are a table in the shared folder.
    """
    wanted = check_sources(sources)
    if missing := [s for s in wanted if s not in flatfiles]:
        raise ValueError(f"no path for {', '.join(missing)}")
    have(spark, *[flatfiles[s] for s in wanted])
    own = [flatfile.read_entries(spark, flatfiles[s]).withColumn("database", F.lit(k)) for k, s in enumerate(dict.fromkeys(wanted))]
    return reduce(DataFrame.unionByName, own)


def write_tables(tables: Mapping[str, DataFrame], out: str, compression: str | None = "gzip") -> dict[str, str]:
    """Every table as tab-separated text under out/<name>, by Spark's compressions or in LZ4 frames ("lz4"); paths by name."""
    for name, df in tables.items():
        write_tsv(df, f"{out}/{name}", compression=compression)
    return {name: f"{out}/{name}" for name in tables}


def build_suffix_array_tables(spark: SparkSession, flatfiles: Mapping[str, str], nodes: str, names: str, proteomes: str, out: str, sources: str = "swissprot,trembl", compression: str | None = "gzip") -> dict[str, str]:
    """Taxa, lineages, entries and reference proteomes, written; paths by name."""
    have(spark, nodes, names, proteomes)
    entries = read_entries(spark, flatfiles, sources)
    built = suffix_array_tables(entries, read_taxa(spark, nodes, names), reference_proteomes(spark, proteomes), ORDER)
    return write_tables(built, out, compression)


def build_tryptic_tables(spark: SparkSession, flatfiles: Mapping[str, str], nodes: str, names: str, out: str, sources: str = "swissprot,trembl", min_length: int = 5, max_length: int = 50, compression: str | None = "gzip") -> dict[str, str]:
    """Taxa, lineages, peptides, sequences and the tryptic index, written; paths by name."""
    have(spark, nodes, names)
    entries = read_entries(spark, flatfiles, sources)
    return write_tables(tryptic_tables(entries, read_taxa(spark, nodes, names), min_length, max_length, ORDER), out, compression)


def build_kmer_index(spark: SparkSession, flatfiles: Mapping[str, str], lineages: str, out: str, k: int = 9, sources: str = "swissprot,trembl", compression: str | None = "gzip") -> dict[str, str]:
    """The k-mer index over a written table of lineages, compressed likewise; paths by name."""
    have(spark, lineages)
    index = kmer_index(read_entries(spark, flatfiles, sources), read_tsv(spark, lineages, LINEAGES, compression=compression), k)
    return write_tables({"index": index.select(F.col("kmer").alias("sequence"), F.col("lca").alias("taxon_id"))}, out, compression)


def read_index(spark: SparkSession, path: str, compression: str | None = None) -> DataFrame:
    """(sequence, taxon_id) of a written index."""
    return read_tsv(spark, path, INDEX, compression=compression)


#: Text and keyword fields of a search document; an accession is looked up, names are searched.
MAPPING = {
    "settings": {"number_of_replicas": 0},
    "mappings": {"properties": {"accession": {"type": "keyword"}, "version": {"type": "integer"}, "taxon_id": {"type": "integer"}, "type": {"type": "keyword"}, "name": {"type": "text"}, "sequence": {"type": "keyword", "index": False, "doc_values": False}, "fa": {"type": "keyword", "index": False, "doc_values": False}}},
}


def replace_search_index(client, alias: str, version: str, load) -> str:
    """Creates an index with the mapping, calls load(its name), then lets the alias name it; its name.

    client has create(name, mapping), point(alias, name) and drop(name).  If loading
    fails the new index goes and the alias still names the old one.
    """
    name = f"{alias}-{version.lower().replace('.', '-')}"
    client.create(name, MAPPING)
    try:
        load(name)
    except BaseException:
        client.drop(name)
        raise
    client.point(alias, name)
    return name


def build_search_index(spark: SparkSession, entries: str, connect, alias: str, version: str, batch: int = 2500, as_text: bool = False, tries: int = 6, wait: float = 0.5) -> str:
    """From a written table of entries to an alias that names their search index; the index's name.

    connect() gives a client with create, point and drop, as replace_search_index() takes
    it, and bulk and count, as bulk_load() does.  If anything fails, the alias still
    names the index before.
    """
    have(spark, entries)
    documents = search_documents(read_tsv(spark, entries, ENTRIES), as_text)
    return replace_search_index(connect(), alias, version, lambda name: bulk_load(documents, connect, name, batch, tries, wait))
