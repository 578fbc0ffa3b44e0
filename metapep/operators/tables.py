"""Entry, peptide, proteome and sequence tables, and their joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import entry_annotations, equate_il, peptide_annotations, tryptic_digest
from ..storage import join_looked_up, scratch, stored
from .aggregates import collapse
from .ancestors import sequence_summary
from .numbering import number_rows, running_offsets


def known_taxa(entries: DataFrame, taxa: DataFrame) -> DataFrame:
    """The entries whose taxon exists, valid or not."""
    return join_looked_up(entries, taxa.select(F.col("id").alias("_t")).distinct(), "taxon_id", "_t", "left_semi")


def entry_table(entries: DataFrame, taxa: DataFrame, order: list[str]) -> DataFrame:
    """Entries of known taxa, numbered in the given order, with annotations (fa) and the lists they come from."""
    own = known_taxa(entries, taxa).withColumn("fa", entry_annotations(F.col("ec"), F.col("go"), F.col("ipr")))
    return number_rows(own.select(*dict.fromkeys([*order, "accession", "version", "taxon_id", "type", "name", "sequence", "fa", "ec", "go", "ipr"])), order)


def peptide_table(numbered: DataFrame, min_length: int = 5, max_length: int = 50) -> DataFrame:
    """(peptide_id, eq_sequence, sequence, entry_id, fa, taxon_id), numbered by entry and place."""
    summary = peptide_annotations(F.col("ec"), F.col("go"), F.col("ipr"))
    digest = tryptic_digest(F.col("sequence"), min_length, max_length)
    # entries are numbered already, so offsets by entry number peptides without a sort of them; counts alone are put in blocks
    counts = stored(numbered.select("id", F.size(digest).alias("_n")), "peptide-counts", keep=True)
    placed = numbered.join(running_offsets(counts, F.col("_n")).select("id", "before"), "id")
    rows = placed.select("before", F.col("id").alias("entry_id"), summary.alias("fa"), "taxon_id", F.posexplode(digest).alias("_place", "sequence"))
    return rows.select((F.col("before") + F.col("_place") + 1).alias("peptide_id"), equate_il(F.col("sequence")).alias("eq_sequence"), "sequence", "entry_id", "fa", "taxon_id")


def proteome_rows(entries: DataFrame) -> DataFrame:
    """(upid, accession): a row for each proteome reference of every entry, of unknown taxa too."""
    return entries.select(F.explode("proteomes").alias("upid"), "accession")


def proteome_table(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference proteomes in order with their accessions; those without entries have an empty list, others are left out."""
    listed = collapse(rows, "upid", "accession", "accessions")
    joined = reference.join(listed, "upid", "left").withColumn("accessions", F.coalesce("accessions", F.lit("")))
    return number_rows(joined.select("upid", "organism_id", "protein_count", "accessions"), ["upid"])


def dictionary_encode(peptides: DataFrame, sequences: DataFrame) -> DataFrame:
    """peptides with ids (eq_seq_id, seq_id) in place of both sequences."""
    ids = sequences.select(F.col("id"), F.col("sequence").alias("_s"))
    one = peptides.join(ids.withColumnRenamed("id", "eq_seq_id"), F.col("eq_sequence") == F.col("_s")).drop("_s")
    two = one.join(ids.withColumnRenamed("id", "seq_id"), F.col("sequence") == F.col("_s")).drop("_s")
    return two.select("peptide_id", "eq_seq_id", "seq_id", "entry_id", "fa", "taxon_id")


def sequence_table(peptides: DataFrame, lineages: DataFrame) -> DataFrame:
    """(id, sequence, lca, lca_il, fa, fa_il): all sequences and equated ones in byte order, with common ancestors and histograms of either side; what is missing is null.

    Summaries are made by text, so only distinct sequences are sorted and numbered, and
    no number is joined to a peptide.  They are written before, as a sort by range reads
    them twice, and go once they are numbered.
    """
    summary = sequence_summary(peptides, lineages).select("sequence", "lca", "lca_il", "fa", "fa_il")
    with scratch(peptides.sparkSession):
        return number_rows(stored(summary, "summaries", compact=True), ["sequence"])
