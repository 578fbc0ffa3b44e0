"""SQL functions made of built-ins, which Catalyst inlines, and views of built tables.

Aggregates are functions of what collect_list() gathers: lca(collect_list(cells)),
term_histogram(collect_list(fa)), collapse(collect_list(accession)).  For groups of very
many rows the operators do the same with partial aggregates of fixed size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators.taxonomy import INVALID_ANYWHERE, INVALID_AT_END, INVALID_IDS
from .ranks import ROOT, SLOTS
from .sources.flatfile import read_entries

_OPEN = " OR ".join(f"i = {SLOTS.index(s)}" for s in ("genus", "species"))
_BAD = " OR ".join([*[f"contains(name, '{x}')" for x in INVALID_ANYWHERE], *[f"endswith(name, '{x}')" for x in INVALID_AT_END], f"id IN {INVALID_IDS}"])
_VAGUE = r"(name RLIKE '\\p{Nd}' AND NOT contains(name, 'virus')) OR endswith(name, ' sp.') OR endswith(name, ' genomosp.') OR contains(name, ' bacterium')"
_TERMS = "filter(split(coalesce(r, ''), ';'), t -> t <> '')"
_WITH = "CAST(size(filter(rows, r -> exists(" + _TERMS + ", t -> {}))) AS STRING)"
_ALL = f"flatten(transform(rows, r -> {_TERMS}))"
_DIGEST = "filter(split(s, '(?<=[KR])(?=[^P])'), x -> length(x) BETWEEN lo AND hi)"
# overlapping chunks first, as a substring counts characters from the start
_KMERS = "CASE WHEN length(s) >= k THEN flatten(transform(transform(sequence(1, length(s) - k + 1, 128), i -> substring(s, i, 127 + k)), c -> transform(sequence(1, length(c) - k + 1), j -> substring(c, j, k)))) ELSE cast(array() AS ARRAY<STRING>) END"

_FUNCTIONS = (
    "equate_il(s STRING) RETURNS STRING RETURN translate(s, 'I', 'L')",
    f"tryptic_digest(s STRING, lo INT, hi INT) RETURNS ARRAY<STRING> RETURN {_DIGEST}",
    f"kmers(s STRING, k INT) RETURNS ARRAY<STRING> RETURN {_KMERS}",
    "metadata_cut(s STRING) RETURNS STRING RETURN CASE WHEN instr(s, ' {') > 0 THEN substring(s, 1, instr(s, ' {') - 1) ELSE substring(s, 1, greatest(length(s) - 1, 0)) END",
    "standard_alphabet(s STRING) RETURNS BOOLEAN RETURN s RLIKE '^[ACDEFGHIKLMNPQRSTVWY]*$'",
    "collapse(v ARRAY<STRING>) RETURNS STRING RETURN array_join(array_sort(v), ';')",
    f"self_valid(id INT, name STRING, rank STRING) RETURNS BOOLEAN RETURN NOT ((rank = 'species' AND ({_VAGUE})) OR {_BAD})",
    # of each rank the distinct cells that count, until two differ
    f"""lca(cells ARRAY<ARRAY<INT>>) RETURNS INT RETURN aggregate(
        transform(sequence(0, {len(SLOTS) - 1}), i -> array_distinct(filter(transform(cells, c -> coalesce(c[i], 0)), x -> x > 0 OR (x = 0 AND NOT ({_OPEN}))))),
        named_struct('lca', {ROOT}, 'stop', false),
        (s, own) -> CASE WHEN s.stop THEN s WHEN size(own) > 1 THEN named_struct('lca', s.lca, 'stop', true) WHEN coalesce(get(own, 0), 0) > 0 THEN named_struct('lca', get(own, 0), 'stop', false) ELSE s END,
        s -> s.lca)""",
    f"""term_histogram(rows ARRAY<STRING>) RETURNS STRING RETURN CASE WHEN size({_ALL}) > 0 THEN concat(
        '{{"num":{{"all":', CAST(size(rows) AS STRING), ',"EC":', {_WITH.format("startswith(t, 'E')")}, ',"GO":', {_WITH.format("startswith(t, 'G')")}, ',"IPR":', {_WITH.format("NOT (startswith(t, 'E') OR startswith(t, 'G'))")}, '}},"data":{{',
        array_join(transform(array_sort(array_distinct({_ALL})), d -> concat(substring(to_json(array(d)), 2, length(to_json(array(d))) - 2), ':', CAST(size(filter({_ALL}, t -> t = d)) AS STRING))), ','), '}}}}') END""",
    f"peptide_rows(s STRING, lo INT, hi INT) RETURNS TABLE (place INT, peptide STRING, equated STRING) RETURN SELECT pos, col, translate(col, 'I', 'L') FROM posexplode({_DIGEST})",
    f"kmer_rows(s STRING, k INT) RETURNS TABLE (place INT, kmer STRING) RETURN SELECT pos, col FROM posexplode({_KMERS})",
    "number_rows(v ARRAY<STRING>) RETURNS TABLE (id BIGINT, value STRING) RETURN SELECT CAST(pos + 1 AS BIGINT), col FROM posexplode(array_sort(array_distinct(v)))",
)
#: Table functions over a view that has to be there.
_OVER = {
    "lineages": f"lineage_table() RETURNS TABLE (taxon_id INT, cells ARRAY<INT>) RETURN SELECT taxon_id, array({', '.join(SLOTS)}) FROM lineages",
    "taxons": "validate_taxa() RETURNS TABLE (id INT, valid BOOLEAN) RETURN SELECT id, valid FROM taxons",
    "entries": "parse_flatfile() RETURNS TABLE (accession STRING, version STRING, taxon_id INT, type STRING, name STRING, sequence STRING) RETURN SELECT accession, version, taxon_id, type, name, sequence FROM entries",
}


def register(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None, flatfiles: str | None = None) -> None:
    """Temporary functions and, for the given tables, temporary views; flatfiles: a path whose entries become the view `entries`.

    lineage_table(), validate_taxa() and parse_flatfile() are functions over the views
    lineages, taxons and entries, so they are there if these are.
    """
    views = dict(tables or {}) | ({"entries": read_entries(spark, flatfiles)} if flatfiles else {})
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for f in (*_FUNCTIONS, *[f for view, f in _OVER.items() if view in views]):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}")
