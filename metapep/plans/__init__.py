"""Whole builds: functions of inputs that return the tables by name; writing is the caller's."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import document_json, kmers, standard_alphabet
from ..operators import tables
from ..operators.aggregates import lca_of, with_cells
from ..operators.ancestors import CLASS, ancestor_of, lineage_classes, lowest_common_ancestors, summary_columns, with_classes
from ..operators.checks import assert_not_null, assert_unique
from ..operators.lookup import inverted_index, posting_blocks
from ..operators.numbering import last_by_key
from ..operators.packed import packed_kmers, unpacked, word_names
from ..operators.taxonomy import lineage_table, taxon_table, with_paths
from ..storage import join_checked, scratch, stored

_SOURCES = re.compile(r"(swissprot|trembl)(,(swissprot|trembl))*")


def check_sources(sources: str) -> list[str]:
    """Database names between commas."""
    if not _SOURCES.fullmatch(sources):
        raise ValueError(f"unknown database in {sources!r}")
    return sources.split(",")


def check_number(value: object, name: str) -> int:
    if not re.fullmatch(r"[0-9]+", str(value)):
        raise ValueError(f"{name} is no number: {value!r}")
    return int(str(value))


def have(spark: SparkSession, *paths: str) -> None:
    """Stops unless all inputs exist, in whatever store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = [p for p in paths if not (where := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).globStatus(where)]
    if missing:
        raise FileNotFoundError(", ".join(missing))


def taxonomy_tables(taxa: DataFrame) -> dict[str, DataFrame]:
    return _of_paths(with_paths(taxa))


def _of_paths(paths: DataFrame) -> dict[str, DataFrame]:
    return {"taxons": taxon_table(paths), "lineages": lineage_table(paths)}


def suffix_array_tables(entries: DataFrame, taxa: DataFrame, reference: DataFrame, order: list[str] | None = None) -> dict[str, DataFrame]:
    """Taxa, lineages, entries and reference proteomes of parsed entries."""
    out = taxonomy_tables(taxa)
    numbered = tables.entry_table(entries, out["taxons"], order or ["accession"])
    out["uniprot_entries"] = numbered.select("id", "accession", "version", "taxon_id", "type", "name", "sequence", "fa")
    out["proteomes"] = tables.proteome_table(tables.proteome_rows(entries), reference)
    return out


def tryptic_tables(entries: DataFrame, taxa: DataFrame, min_length: int = 5, max_length: int = 50, order: list[str] | None = None) -> dict[str, DataFrame]:
    """Peptides, their numbered sequences, common ancestors, annotation histograms, and the index."""
    min_length, max_length = check_number(min_length, "min_length"), check_number(max_length, "max_length")
    paths = with_paths(taxa)
    out = _of_paths(paths)
    numbered = tables.entry_table(entries, out["taxons"], order or ["accession"])
    peptides = tables.peptide_table(numbered, min_length, max_length)
    out |= {"peptides": peptides, "sequences": stored(tables.sequence_table(peptides, lineage_table(paths, numbered)), "sequences")}
    out["index"] = tryptic_index(out["sequences"])
    return out


def tryptic_index(sequences: DataFrame, compat_drop_n: bool = False) -> DataFrame:
    """(sequence, taxon_id): the sequences of a table of them that have a common ancestor; compat_drop_n leaves out all that hold an N, as a known tool's filter does."""
    own = sequences.filter(F.col("lca").isNotNull())
    if compat_drop_n:
        own = own.filter(~F.col("sequence").contains("N"))
    return own.select("sequence", F.col("lca").alias("taxon_id"))


def peptide_index(peptides: DataFrame, lineages: DataFrame, compat_drop_n: bool = False) -> DataFrame:
    """tryptic_index() from the peptides themselves, for those who need no histograms or numbers: one shuffle of a row a sequence and task."""
    return tryptic_index(lowest_common_ancestors(peptides, lineages, "sequence"), compat_drop_n)


def kmer_index(entries: DataFrame, lineages: DataFrame, k: int = 9, aggregate: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """(kmer, lca) of every k-mer of sequences with standard residues only: the common ancestor of its taxa, or what `aggregate` makes of rows (kmer, taxon_id, cells of the lineage).

    The classes of lineages are joined to entries, before these become k-mers; k-mers
    are packed in integers, and shuffled once, as partial aggregates of six integers.
    Entries are dealt out so that a task has about TASK_LETTERS residues: what it holds of
    distinct k-mers is bounded, however large the input's files are.
    """
    k = check_number(k, "k")
    own = entries.filter(standard_alphabet(F.col("sequence"))).select("taxon_id", "sequence")
    classes = lineage_classes(lineages) if aggregate is None and k else None
    if classes is None:
        slots = [c for c in lineages.columns if c != "taxon_id"]
        rows = with_cells(own, lineages).select("taxon_id", *slots, F.explode(kmers(F.col("sequence"), k)).alias("kmer"))
        return (aggregate or lca_of)(rows, "kmer")
    letters = own.agg(F.sum(F.length("sequence"))).first()[0] or 0
    rows = with_classes(own, classes).select("sequence", *CLASS)
    words = packed_kmers(rows.repartition(-(-letters // TASK_LETTERS)) if letters > TASK_LETTERS else rows, k)
    found = ancestor_of(words.groupBy(*word_names(k)).agg(*summary_columns()), classes)
    return found.select(unpacked(k).alias("kmer"), "lca")


#: Rows of an index that a bucket holds, which a task sorts, and letters whose k-mers a task aggregates before they are shuffled.
BUCKET_ROWS, TASK_LETTERS = 1 << 21, 1 << 21


def write_index(index: DataFrame, table: str, key: str, buckets: int = 256, path: str | None = None) -> DataFrame:
    """The index as a table of the catalog, read back: one sorted file a bucket of the key, with a Bloom filter on it.

    Joins on the key need no shuffle of the index.  A lookup reads one file, of which the
    statistics of blocks and pages, and the Bloom filters, leave few.  A bucket is
    written by one task, so their number grows with the index: it is `buckets`, or one for
    BUCKET_ROWS rows if that is more.  path: folder of the files, where it isn't the catalog's own.
    """
    with scratch(index.sparkSession):
        rows = stored(index, "index")
        _write_buckets(rows, table, key, max(buckets, -(-rows.count() // BUCKET_ROWS)), path)
    return index.sparkSession.table(table)


def _write_buckets(index: DataFrame, table: str, key: str, buckets: int, path: str | None) -> None:
    out = index.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    out = out.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    (out.option("path", path) if path else out).saveAsTable(table)


def write_by_taxon(rows: DataFrame, tree: DataFrame, path: str, taxon: str = "taxon_id") -> DataFrame:
    """rows with `taxon_first`, the number of their taxon in a nested_set(), as a Parquet table in that order, read back; taxa that the tree lacks are null and come first.

    What lies under a taxon is then a range of the table: see lookup.under_taxon().
    """
    own = join_checked(rows, tree.select(F.col("id").alias(taxon), F.col("first").alias("taxon_first")), taxon, "left")
    own.repartitionByRange("taxon_first").sortWithinPartitions("taxon_first").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(own.schema).parquet(path)


#: Keys of the static tables.
KEYS = {"taxons": ("id",), "lineages": ("taxon_id",), "ec_numbers": ("id", "code"), "go_terms": ("id", "code"), "interpro_entries": ("id", "code")}


def static_database(built: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The built tables, checked for keys and nulls (lineages may have empty slots), and the word index of taxon names as posting blocks."""
    for name, own in KEYS.items():
        if name in built:
            for k in own:
                assert_unique(built[name], k)
            assert_not_null(built[name], *(("taxon_id",) if name == "lineages" else built[name].columns))
    out = dict(built)
    if "taxons" in built:
        out["virtual_taxons"] = posting_blocks(inverted_index(built["taxons"], "id", "name", "rank"), "id")
    return out


def save_static_database(built: dict[str, DataFrame], database: str, buckets: int = 16) -> list[str]:
    """static_database() as tables of a catalog database, bucketed and sorted by their key, so that lookups read one bucket; their names."""
    tables_ = static_database(built)
    for name, df in tables_.items():
        write_index(df, f"{database}.{name}", "token" if name == "virtual_taxons" else KEYS.get(name, (df.columns[0],))[0], buckets)
    return [f"{database}.{name}" for name in tables_]


def search_documents(entries: DataFrame, as_text: bool = False) -> DataFrame:
    """(accession, document): JSON by accession; of a repeated one the row with the largest id."""
    own = last_by_key(entries.select("id", "accession", "version", "taxon_id", "type", "name", "sequence", "fa"), "accession", "id")
    typed = own if as_text else own.withColumn("version", F.col("version").cast("int"))
    return typed.select("accession", document_json("accession", "version", "taxon_id", "type", "name", "sequence", "fa", as_text=as_text).alias("document"))


def export_search_documents(documents: DataFrame, send, batch: int = 2500, target: str = "uniprot_entries") -> None:
    """Calls send(text of one bulk request) for every batch of each partition; send raises to stop.

    Requests address documents by accession, so a task that runs again repeats them
    without effect.
    """

    def part(rows):
        import json

        lines: list[str] = []
        for r in rows:
            lines += [json.dumps({"index": {"_index": target, "_id": r.accession}}), r.document]
            if len(lines) >= 2 * batch:
                send("\n".join(lines) + "\n")
                lines = []
        if lines:
            send("\n".join(lines) + "\n")

    documents.foreachPartition(part)
