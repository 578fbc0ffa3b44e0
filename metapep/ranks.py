"""Ranks, their rewrites, and the schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The ranks in order, from the root down.
RANKS = (
    "no rank", "domain", "realm", "kingdom", "subkingdom", "superphylum", "phylum", "subphylum", "superclass", "class", "subclass", "superorder", "order", "suborder", "infraorder",
    "superfamily", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "species group", "species subgroup", "species", "subspecies", "strain", "varietas", "forma",
)

# Parts of rank names and what they become; each at its first occurrence, in this order.
REWRITES = (
    *((x, "no rank") for x in ("subcohort", "cohort", "subsection", "section", "series", "biotype", "serogroup", "morph", "genotype", "subvariety", "pathogroup", "forma specialis", "serotype", "clade", "isolate", "infraclass")),
    ("acellular root", "domain"),
    ("cellular root", "no rank"),
    ("parvorder", "no rank"),
)

#: Columns of a lineage, one for each rank below the root.
SLOTS = tuple(r.replace(" ", "_") for r in RANKS[1:])
ROOT = 1


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TAXONS = _schema(("id", _I), ("name", _S), ("rank", _S), ("parent_id", _I), ("valid", _B))
LINEAGES = _schema(("taxon_id", _I), *((s, _I) for s in SLOTS))
ENTRIES = _schema(("id", _L), ("accession", _S), ("version", _S), ("taxon_id", _I), ("type", _S), ("name", _S), ("sequence", _S), ("fa", _S))
PEPTIDES = _schema(("peptide_id", _L), ("eq_sequence", _S), ("sequence", _S), ("entry_id", _L), ("fa", _S), ("taxon_id", _I))
PROTEOMES = _schema(("id", _L), ("upid", _S), ("organism_id", _I), ("protein_count", _I), ("accessions", _S))
EC_NUMBERS = _schema(("id", _L), ("code", _S), ("name", _S))
GO_TERMS = _schema(("id", _L), ("code", _S), ("namespace", _S), ("name", _S))
INTERPRO = _schema(("id", _L), ("code", _S), ("category", _S), ("name", _S))
SEQUENCES = _schema(("id", _L), ("sequence", _S), ("lca", _I), ("lca_il", _I), ("fa", _S), ("fa_il", _S))
INDEX = _schema(("sequence", _S), ("taxon_id", _I))
