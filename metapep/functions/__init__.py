"""Column functions; all are built-in expressions that Catalyst sees through."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def metadata_cut(text: Column) -> Column:
    """The text before the first blank that an opening brace follows; without one, the text but for its last character."""
    at = F.instr(text, " {")
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(F.substring(text, F.lit(1), F.greatest(F.length(text) - 1, F.lit(0))))


def equate_il(sequence: Column) -> Column:
    """Isoleucine written as leucine: mass spectrometers can't tell them apart."""
    return F.translate(sequence, "I", "L")


def prefixed(refs: Column, prefix: str) -> Column:
    return F.transform(F.filter(refs, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))


def entry_annotations(ec: Column, go: Column, ipr: Column) -> Column:
    """EC, GO and InterPro terms of an entry: three lists between semicolons, empty or not."""
    return F.concat_ws(";", F.array_join(prefixed(ec, "EC:"), ";"), F.array_join(go, ";"), F.array_join(prefixed(ipr, "IPR:"), ";"))


def peptide_annotations(ec: Column, go: Column, ipr: Column) -> Column:
    """GO, EC and InterPro terms of a peptide's entry, without empty fields."""
    return F.array_join(F.concat(go, prefixed(ec, "EC:"), prefixed(ipr, "IPR:")), ";")


def tryptic_digest(sequence: Column, min_length: int = 5, max_length: int = 50) -> Column:
    """Peptides in order: cut behind K or R unless P or the end follows; lengths within the bounds."""
    return F.filter(F.split(sequence, "(?<=[KR])(?=[^P])"), lambda x: F.length(x).between(min_length, max_length))


def kmers(sequence: Column, k: int = 9, chunk: int = 128) -> Column:
    """All windows of k residues; none of a shorter sequence.

    A substring is found by counting characters from the start, so the sequence is cut
    in overlapping chunks first: the work is linear in its length.
    """

    def windows(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - (k - 1)), lambda i: F.substring(text, i, F.lit(k)))

    starts = F.sequence(F.lit(1), F.length(sequence) - (k - 1), F.lit(chunk))
    chunks = F.transform(starts, lambda i: F.substring(sequence, i, F.lit(chunk + k - 1)))
    none = F.array().cast("array<string>")
    return F.when(F.length(sequence) >= k, F.flatten(F.transform(chunks, windows))).otherwise(none)


def standard_alphabet(sequence: Column) -> Column:
    """Whether the sequence has the twenty standard residues only; an empty one has."""
    return sequence.rlike("^[ACDEFGHIKLMNPQRSTVWY]*$")


def term_category(term: Column) -> Column:
    return F.when(term.startswith("G"), "GO").when(term.startswith("E"), "EC").otherwise("IPR")


def namespace_text(namespace: Column) -> Column:
    """The first underscore as a blank."""
    return F.regexp_replace(namespace, "^([^_]*)_", "$1 ")


def validity_byte(valid: Column) -> Column:
    """The control character that stands for a boolean in tab-separated files."""
    return F.when(valid, F.lit("\u0001")).otherwise(F.lit("\u0000"))


def document_json(*columns: str, as_text: bool = False) -> Column:
    """A search document of the columns; as_text writes every value as a string."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if as_text else F.col(c) for c in columns]))
