"""Goldens and loop models of the domain operators."""

import json
import random

import pytest
from pyspark.sql import functions as F

from metapep import plans, storage
from metapep import sql as functions_sql
from metapep.functions import document_json, entry_annotations, equate_il, kmers, metadata_cut, peptide_annotations, standard_alphabet, tryptic_digest, validity_byte
from metapep.operators import aggregates, ancestors, checks, dictionary, lookup, numbering, packed, tables, taxonomy
from metapep.operators.numbering import last_by_key, number_rows, union_numbered
from metapep.plans import builds
from metapep.ranks import LINEAGES, RANKS, SLOTS, TAXONS
from metapep.sources import taxdump


def model_digest(s: str, lo: int, hi: int) -> list[str]:
    out, begin = [], 0
    for i, c in enumerate(s):
        if c in "KR" and i + 1 < len(s) and s[i + 1] != "P":
            out.append(s[begin : i + 1])
            begin = i + 1
    out.append(s[begin:])
    return [x for x in out if lo <= len(x) <= hi]


def test_digest_and_kmers_match_loops(spark):
    rng = random.Random(1)
    rows = [("AAKPGGRK",), ("KRPK",), ("",)] + [("".join(rng.choice("AKRPG") for _ in range(rng.randrange(400))),) for _ in range(300)]
    df = spark.createDataFrame(rows, "s string")
    for r in df.select("s", tryptic_digest(F.col("s"), 1, 50).alias("d"), tryptic_digest(F.col("s"), 0, 5).alias("z"), kmers(F.col("s"), 9).alias("k")).collect():
        assert r.d == model_digest(r.s, 1, 50)
        assert r.z == model_digest(r.s, 0, 5)
        assert r.k == [r.s[i : i + 9] for i in range(len(r.s) - 8)]
    assert df.filter("s = ''").select(tryptic_digest(F.col("s"), 5, 50).alias("d")).first().d == []


def test_text_functions(spark):
    df = spark.createDataFrame([("X {ECO:1};", "AILI"), ("X{inner} {ECO:1};", "ACB"), ("X;", ""), ("", "ACD")], "t string, s string")
    assert [r[0] for r in df.select(metadata_cut(F.col("t"))).collect()] == ["X", "X{inner}", "X", ""]
    assert [tuple(r) for r in df.select(equate_il(F.col("s")), standard_alphabet(F.col("s"))).collect()] == [("ALLL", True), ("ACB", False), ("", True), ("ACD", True)]
    refs = spark.createDataFrame([([], ["GO:1", "GO:2"], ["I1", ""]), ([], [], [])], "ec array<string>, go array<string>, ipr array<string>")
    cols = [F.col(c) for c in ("ec", "go", "ipr")]
    assert [tuple(r) for r in refs.select(entry_annotations(*cols), peptide_annotations(*cols)).collect()] == [(";GO:1;GO:2;IPR:I1", "GO:1;GO:2;IPR:I1"), (";;", "")]
    assert spark.range(1).select(validity_byte(F.lit(True)), document_json("id", as_text=True)).first()[1] == '{"id":"0"}'


NODES = """1|1|no rank|root
131567|1|cellular root|cellular organisms
10239|1|acellular root|Viruses
28384|1|no rank|other sequences
2|131567|domain|Bacteria
1224|2|phylum|Pseudomonadota
1236|1224|class|Gammaproteobacteria
91347|1236|order|Enterobacterales
543|91347|family|Enterobacteriaceae
561|543|genus|Escherichia
562|561|species|Escherichia coli
83333|562|strain|Escherichia coli K-12
900001|561|species|Escherichia sp.
900002|10239|species|Frog virus 3
900003|561|species|Escherichia 042
900004|900003|strain|Escherichia 042 a
900005|562|species|Escherichia coli minor
900006|561|clade|unclassified Escherichia"""


@pytest.fixture(scope="module")
def taxa(spark):
    rows = [x.split("|") for x in NODES.split("\n")]
    nodes = spark.createDataFrame([(f"{i}\t|\t{p}\t|\t{r}\t|\tXX\t|",) for i, p, r, _ in rows], "value string")
    names = spark.createDataFrame([(f"{i}\t|\t{n}\t|\t\t|\tscientific name\t|",) for i, _, _, n in rows] + [("2\t|\teubacteria\t|\t\t|\tsynonym\t|",)], "value string")
    return taxdump.taxa(taxdump.parse_nodes(nodes), taxdump.parse_names(names))


@pytest.fixture(scope="module")
def built(taxa):
    return plans.taxonomy_tables(taxa)


def test_validity_and_ranks(built):
    rows = {r.id: (r.rank, r.valid) for r in built["taxons"].collect()}
    assert {k for k, (_, v) in rows.items() if not v} == {28384, 900001, 900003, 900004}
    assert rows[10239][0] == "domain" and rows[131567][0] == "no rank" and rows[900006][0] == "no rank"


def test_lineages(built):
    rows = {r.taxon_id: {k: v for k, v in r.asDict().items() if v is not None and k != "taxon_id"} for r in built["lineages"].collect()}
    up = {"domain": 2, "phylum": 1224, "class": 1236, "order": 91347, "family": 543, "genus": 561}
    assert rows[1] == rows[131567] == rows[28384] == {}
    assert rows[83333] == up | {"species": 562, "strain": 83333}
    below = {s: -1 for s in ("subgenus", "species_group", "species_subgroup", "subspecies", "strain", "varietas", "forma")}
    assert rows[900001] == up | below | {"species": -900001}
    assert rows[900004] == up | below | {"species": -900003, "strain": -900004}
    assert rows[900005] == up | {"species_subgroup": 562, "species": 900005}
    assert rows[900006] == up


def test_common_ancestors(spark, built):
    want = {(562, 83333): 562, (562, 900001): 562, (562, 900002): 1, (2, 562): 2, (561, 562): 562, (543, 562): 562, (900001,): 561, (900004,): 561, (900003, 900001): 561, (28384,): 1, (1, 562): 1, (562, 900005): 561, (900005,): 900005, (77,): 1}
    rows = spark.createDataFrame([(str(k), t) for k in want for t in k], "k string, taxon_id int")
    assert dict(map(tuple, ancestors.lowest_common_ancestors(rows, built["lineages"], "k").collect())) == {str(k): v for k, v in want.items()}


def model_lineage(chain: list[tuple[int, int, bool]]) -> list:
    """chain: (id, rank, valid) from the taxon up, ranked ones only."""
    out, at, valid = [None] * len(RANKS), len(RANKS), chain[0][2] if chain else True
    for id_, rank, ok in chain:
        new = min(rank, at - 1)
        for k in range(max(new + 1, 1), at):
            out[k] = None if valid else -1
        if new < 1:
            at = 0
            break
        out[new], at, valid = id_ if ok else -id_, new, ok
    for k in range(1, at):
        out[k] = None if valid else -1
    return out[1:]


def test_random_trees_match_a_model(spark):
    rng = random.Random(5)
    ranks = ["no rank", "domain", "phylum", "class", "genus", "species", "strain", "forma"]
    rows = [(1, "root", "no rank", 1)]
    for i in range(2, 400):
        parent = rng.choice(rows)[0] if rng.random() < 0.97 else 5000 + i
        rows.append((i, rng.choice(["alpha", "alpha 1", "uncultured x", "beta"]), rng.choice(ranks), parent))
    got = plans.taxonomy_tables(spark.createDataFrame(rows, "id int, name string, rank string, parent_id int"))
    by = {r[0]: r for r in rows}
    ok_self = lambda r: not ((r[2] == "species" and r[1] == "alpha 1") or "uncultured" in r[1])

    def valid(i: int) -> bool:
        r = by[i]
        return ok_self(r) and (i == 1 or (r[3] in by and valid(r[3])))

    def chain(i: int) -> list:
        out = []
        while i in by and i != 1:
            if by[i][2] != "no rank":
                out.append((i, RANKS.index(by[i][2]), valid(i)))
            i = by[i][3]
        return out

    assert {r.id: r.valid for r in got["taxons"].collect()} == {i: valid(i) for i in by}
    assert {r.taxon_id: list(r)[1:] for r in got["lineages"].collect()} == {i: model_lineage(chain(i)) for i in by}


def test_cycles_and_unknown_ranks_are_errors(spark):
    with pytest.raises(ValueError, match="not connected"):
        taxonomy.with_paths(spark.createDataFrame([(1, "r", "no rank", 1), (2, "a", "genus", 3), (3, "b", "genus", 2)], "id int, name string, rank string, parent_id int"))
    with pytest.raises(Exception, match="unknown rank"):
        taxonomy.with_paths(spark.createDataFrame([(1, "r", "superkingdom", 1)], "id int, name string, rank string, parent_id int"))


def model_lca(lineages: list[list[int]]) -> int:
    lca = 1
    for k, s in enumerate(SLOTS):
        own = {x[k] for x in lineages if (x[k] > 0 if s in ("genus", "species") else x[k] >= 0)}
        if len(own) > 1:
            return lca
        if own and max(own) > 0:
            lca = max(own)
    return lca


def test_random_ancestors_match_a_loop(spark):
    rng = random.Random(2)
    table = [(t, *(rng.choice([None, None, 1 + k, 1 + k, 50 + rng.randrange(2), -3]) for k in range(28))) for t in range(40)]
    lineages = spark.createDataFrame(table, "taxon_id int, " + ", ".join(f"{s} int" for s in SLOTS))
    groups = {g: [rng.randrange(40) for _ in range(rng.randrange(1, 4))] for g in range(200)}
    got = ancestors.lowest_common_ancestors(spark.createDataFrame([(g, t) for g, v in groups.items() for t in v], "g int, taxon_id int"), lineages, "g")
    assert dict(map(tuple, got.collect())) == {g: model_lca([[x or 0 for x in table[t][1:]] for t in v]) for g, v in groups.items()}


def test_ancestors_by_class_match_a_loop(spark):
    """Paths that are usable up to somewhere, as those of lineage_table() are."""
    rng = random.Random(9)

    def lineage():
        end = rng.choice([28, 28, rng.randrange(29)])
        return [(rng.choice([None, 1 + k, 1 + k, 1 + k, 50 + k]) if k < end else -3) for k in range(28)]

    table = [(t, *lineage()) for t in range(60)]
    lineages = spark.createDataFrame(table, "taxon_id int, " + ", ".join(f"{s} int" for s in SLOTS))
    assert ancestors.lineage_classes(lineages) is not None
    groups = {g: [rng.randrange(62) for _ in range(rng.randrange(1, 5))] for g in range(400)}  # two taxa have no lineage
    rows = spark.createDataFrame([(g, t) for g, v in groups.items() for t in v], "g int, taxon_id int")
    want = {g: model_lca([[x or 0 for x in table[t][1:]] for t in v if t < 60]) for g, v in groups.items()}
    assert dict(map(tuple, ancestors.lowest_common_ancestors(rows, lineages, "g").collect())) == want


def test_ancestors_of_trees_match_a_loop(spark, built):
    ids = [r.id for r in built["taxons"].collect()]
    cells = {r.taxon_id: [x or 0 for x in list(r)[1:]] for r in built["lineages"].collect()}
    pairs = [(f"{a} {b}", t) for a in ids for b in ids for t in (a, b)]
    got = ancestors.lowest_common_ancestors(spark.createDataFrame(pairs, "k string, taxon_id int"), built["lineages"], "k")
    assert all(r.lca == model_lca([cells[int(t)] for t in r.k.split()]) for r in got.collect())
    cut_down = built["lineages"].drop("strain")  # not all slots: no classes, other ancestors
    assert ancestors.lineage_classes(cut_down) is None
    assert ancestors.lowest_common_ancestors(spark.createDataFrame([(1, 83333)], "k int, taxon_id int"), cut_down, "k").first().lca == 562


@pytest.mark.parametrize("k", [1, 9, 12, 13, 25])
def test_packed_kmers(spark, monkeypatch, k):
    monkeypatch.setattr(packed, "CHUNK", 50)
    rng = random.Random(k)
    texts = [None, "", "ACD", "A" * 12, *["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=rng.randrange(80))) for _ in range(30)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, sequence string").repartition(3)
    words = packed.packed_kmers(df, k)
    assert words.columns == [*packed.word_names(k), "id"]
    got = words.select("id", packed.unpacked(k).alias("kmer"), *packed.word_names(k)).collect()
    want = [(i, t[a : a + k]) for i, t in enumerate(texts) if t for a in range(len(t) - k + 1)]
    assert sorted((r.id, r.kmer) for r in got) == sorted(want)
    assert all(list(r)[2:] == packed.packed_key(r.kmer) for r in got)
    assert [r.kmer for r in sorted(got, key=lambda r: list(r)[2:])] == sorted(r.kmer for r in got)


def test_kmer_index_takes_other_aggregates(spark, built):
    entries = spark.createDataFrame([(562, "ACDEFGHIKL"), (83333, "CDEFGHIKLM"), (900002, "ACDEFGHIKX")], "taxon_id int, sequence string")
    index = dict(map(tuple, plans.kmer_index(entries, built["lineages"]).collect()))
    assert index == {"ACDEFGHIK": 562, "CDEFGHIKL": 562, "DEFGHIKLM": 83333}
    counted = plans.kmer_index(entries, built["lineages"], aggregate=lambda rows, key: rows.groupBy(key).agg(F.count("*").alias("lca")))
    assert dict(map(tuple, counted.collect())) == {"ACDEFGHIK": 1, "CDEFGHIKL": 2, "DEFGHIKLM": 1}


def test_nested_set(spark):
    rng = random.Random(4)
    rows = [(1, 1)] + [(i, rng.randrange(1, i)) for i in range(2, 300)] + [(500, 499), (501, 500)]
    parent = dict(rows)

    def up(i):
        return [i, *(up(parent[i]) if i != 1 and parent[i] in parent else [])]

    tree = {r.id: r for r in taxonomy.nested_set(spark.createDataFrame(rows, "id int, parent_id int")).collect()}
    assert sorted(r.first for r in tree.values()) == list(range(1, len(rows) + 1))
    for i, r in tree.items():
        assert [x for x, o in tree.items() if r.first <= o.first <= r.last] == [x for x in tree if i in up(x)] and r.depth == len(up(i))
    sets = [(k, rng.sample(range(1, 300), rng.randrange(1, 4))) for k in range(100)] + [(100, [500, 501]), (101, [2, 501])]
    numbers = spark.createDataFrame([(k, min(tree[i].first for i in s), max(tree[i].first for i in s)) for k, s in sets], "k int, lo long, hi long")
    got = {r.k: r.ancestor for r in taxonomy.tree_ancestors(numbers, spark.createDataFrame(list(tree.values()))).collect()}
    for k, s in sets:
        common = set.intersection(*[set(up(i)) for i in s])
        assert got[k] == max(common, key=lambda i: len(up(i)), default=None)


def test_subtree_is_a_pushed_range(spark, tmp_path, taxa):
    tree = storage.cut(taxonomy.nested_set(taxa))
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([562, 83333, 10239, 543, 77, 2, 900002])], "k int, taxon_id int")
    table = plans.write_by_taxon(rows, tree, str(tmp_path / "t"))
    under = lookup.under_taxon(table, tree, 543)
    assert sorted(r.taxon_id for r in under.collect()) == [543, 562, 83333]
    plan = under._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(taxon_first" in plan and "LessThanOrEqual(taxon_first" in plan
    assert lookup.under_taxon(table, tree, 424242).count() == 0


def test_index_is_served_by_bucket(spark, tmp_path):
    keys = [f"K{i:05d}" for i in range(3000)]
    index = plans.write_index(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "sequence string, taxon_id int"), "served", "sequence", 8, str(tmp_path / "served"))
    files = [f for f in (tmp_path / "served").iterdir() if f.name.startswith("part-")]
    assert len(files) == 8
    one = lookup.exact(index, sequence="K01234")
    assert one.first().taxon_id == 1234
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    spark.conf.set("spark.sql.files.openCostInBytes", "1m")  # a task a file
    assert one.select("*").rdd.getNumPartitions() == 1 and index.filter("taxon_id = 1234").rdd.getNumPartitions() == 8
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    wanted = spark.createDataFrame([(k, "K00007") for k in range(500)] + [(1000, "none"), (1001, None), (1002, "K02999")], "k int, sequence string")
    got = {r.k: r.taxon_id for r in lookup.in_index(wanted, index).collect()}
    assert len(got) == 503 and got[3] == 7 and got[1000] is None and got[1001] is None and got[1002] == 2999
    joined = wanted.select("sequence").distinct().join(index.hint("merge"), "sequence")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.rindex("Scan parquet") - 400 :]
    assert "SortMergeJoin" in plan and "Exchange" not in side[: side.index("Scan parquet")].split("Sort [sequence")[-1]
    spark.sql("DROP TABLE served")


def test_posting_blocks(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.sample(["red", "green", "Blue", "old", "new"], 3))) for i in range(400)]
    index = lookup.inverted_index(spark.createDataFrame(rows, "id int, name string"), "id", "name")
    blocks = storage.cut(lookup.posting_blocks(index, "id", block=64))
    assert blocks.agg(F.max("n")).first()[0] <= 64
    for text in ("red", "BLUE old", "new green red", "red missing", "", "red red"):
        want = [i for i, t in rows if text and set(text.lower().split()) <= set(t.lower().split())]
        assert sorted(r.id for r in lookup.search_blocks(blocks, text, "id").collect()) == want


def test_dictionary_grows(spark, tmp_path):
    """Known strings keep their ids, a release is made once, and a new session finds it."""

    def words(*own):
        return spark.createDataFrame([(w,) for w in own], "w string")

    one = dictionary.Dictionary(spark, str(tmp_path / "d"), 4)
    assert one.releases() == [] and one.read().count() == 0
    assert sorted(map(tuple, one.append(words("b", "d", "b", None, "ü"), "w", 1).collect())) == [(1, "b"), (2, "d"), (3, "ü")]
    assert sorted(map(tuple, one.append(words("a", "d", "z", "", "ü"), "w", 3).collect())) == [(4, ""), (5, "a"), (6, "z")]
    assert sorted(map(tuple, one.append(words("never"), "w", 3).collect())) == [(4, ""), (5, "a"), (6, "z")]  # it is there
    with pytest.raises(ValueError, match="older"):
        one.append(words("x"), "w", 2)
    assert one.append(words("a", "b"), "w", 4).count() == 0 and one.releases() == [1, 3, 4]
    assert sorted(map(tuple, one.read(1).collect())) == [(1, "b", 1), (2, "d", 1), (3, "ü", 1)]
    for t in spark.catalog.listTables():
        if t.name.startswith("dictionary_"):
            spark.sql(f"DROP TABLE {t.name}")  # what a new session knows: nothing; the files are not the catalog's
    again = dictionary.Dictionary(spark, str(tmp_path / "d"), 4)
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(["a", "b", "a", None, "?", "z"])], "k int, w string")
    assert [r.id for r in again.encode(rows, "w").orderBy("k").collect()] == [5, 1, 5, None, None, 6]
    assert [r.n for r in again.encode(rows, "w", "n", 1).orderBy("k").collect()] == [None, 1, None, None, None, None]
    assert [r.id for r in again.append(words("0", "a"), "w", 5).collect()] == [7]


def test_histogram(spark):
    rows = spark.createDataFrame([(1, "GO:1;EC:1.1.1.1;IPR:IPR1"), (1, "GO:1;GO:1"), (1, ""), (2, ""), (3, None)], "id int, fa string")
    got = aggregates.histogram_json(aggregates.term_histogram(rows, "id", "fa"), "id").collect()
    assert [tuple(r) for r in got] == [(1, '{"num":{"all":3,"EC":1,"GO":2,"IPR":1},"data":{"EC:1.1.1.1":1,"GO:1":3,"IPR:IPR1":1}}')]


def test_numbering(spark):
    df = spark.createDataFrame([(f"{x:03d}",) for x in random.Random(3).sample(range(900), 500)], "s string").repartition(7)
    got = number_rows(df, ["s"]).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.s)] == list(range(1, 501))
    assert number_rows(df.limit(0), ["s"]).count() == 0
    both = union_numbered(spark.createDataFrame([("b",), ("a",)], "sequence string"), spark.createDataFrame([("b",), ("C",)], "sequence string"))
    assert sorted(map(tuple, both.collect())) == [(1, "C"), (2, "a"), (3, "b")]
    assert {tuple(r) for r in last_by_key(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 0, "z")], "k string, o int, v string"), "k", "o").collect()} == {("a", 2, "y"), ("b", 0, "z")}


def test_proteomes(spark):
    rows = spark.createDataFrame([("UP1", "B"), ("UP1", "A"), ("UP3", "C")], "upid string, accession string")
    reference = spark.createDataFrame([("UP2", 9, 20), ("UP1", 7, 10)], "upid string, organism_id int, protein_count int")
    assert sorted(map(tuple, tables.proteome_table(rows, reference).collect())) == [(1, "UP1", 7, 10, "A;B"), (2, "UP2", 9, 20, "")]


def _entries(spark):
    kind = "accession string, version string, taxon_id int, type string, name string, sequence string, ec array<string>, go array<string>, ipr array<string>, proteomes array<string>"
    return spark.createDataFrame(
        [("A1", "1", 562, "swissprot", "one", "AAAAIKCCCCCR", ["1.1.1.1"], ["GO:1"], [], ["UP1"]), ("A2", "2", 83333, "trembl", "two", "AAAALKNNNNNK", [], ["GO:2"], ["I"], ["UP1"]), ("A3", "1", 5, "trembl", "lost", "AAAAIK", [], [], [], ["UP9"])],
        kind,
    )


def test_whole_builds(spark, taxa):
    reference = spark.createDataFrame([("UP1", 7, 10)], "upid string, organism_id int, protein_count int")
    sa = plans.suffix_array_tables(_entries(spark), taxa, reference)
    assert [tuple(r) for r in sa["uniprot_entries"].select("id", "accession", "fa").orderBy("id").collect()] == [(1, "A1", "EC:1.1.1.1;GO:1;"), (2, "A2", ";GO:2;IPR:I")]
    assert [tuple(r) for r in sa["proteomes"].collect()] == [(1, "UP1", 7, 10, "A1;A2")]
    built = plans.tryptic_tables(_entries(spark), taxa)
    rows = {r.sequence: r for r in built["sequences"].collect()}
    assert rows["AAAALK"].lca == 83333 and rows["AAAALK"].lca_il == 562
    assert rows["AAAAIK"].lca == 562 and rows["AAAAIK"].lca_il is None
    assert rows["AAAALK"].fa_il == '{"num":{"all":2,"EC":1,"GO":2,"IPR":1},"data":{"EC:1.1.1.1":1,"GO:1":1,"GO:2":1,"IPR:I":1}}'
    assert {r.sequence for r in plans.tryptic_index(built["sequences"]).collect()} == {"AAAAIK", "AAAALK", "CCCCCR", "NNNNNK"}
    assert {r.sequence for r in plans.tryptic_index(built["sequences"], compat_drop_n=True).collect()} == {"AAAAIK", "AAAALK", "CCCCCR"}
    index = dict(map(tuple, plans.kmer_index(_entries(spark).filter("taxon_id > 5"), sa["lineages"], 5).collect()))
    assert index["AAAAL"] == 83333 and index["AAAAI"] == 562 and len(index) == 8 + 8
    found = lookup.in_index(spark.createDataFrame([("AAAALK",), ("XX",)], "sequence string"), built["index"])
    assert dict(map(tuple, found.collect())) == {"AAAALK": 83333, "XX": None}


def test_search_and_checks(spark, built):
    own = plans.static_database(built)
    assert {r.id for r in own["virtual_taxons"].filter("token = 'escherichia'").select(F.explode("ids").alias("id")).collect()} >= {561, 562}
    assert {r.id for r in lookup.search(built["taxons"], "COLI k", "name", "rank").collect()} == {83333}
    assert lookup.search(built["taxons"], "", "name").count() == 0
    entries = spark.createDataFrame([(1, "A", "3", 5, "swissprot", "n", "S", ";;"), (2, "A", "4", 5, "swissprot", "n", "S", ";;")], "id long, accession string, version string, taxon_id int, type string, name string, sequence string, fa string")
    docs = plans.search_documents(entries)
    assert [r.document for r in docs.collect()] == ['{"accession":"A","version":4,"taxon_id":5,"type":"swissprot","name":"n","sequence":"S","fa":";;"}']
    assert '"version":"4"' in plans.search_documents(entries, as_text=True).first().document
    with pytest.raises(ValueError, match="not unique"):
        checks.assert_unique(entries, "accession")
    with pytest.raises(ValueError, match="null"):
        checks.assert_not_null(spark.createDataFrame([(None,)], "a int"), "a")


def test_bulk_export(spark, tmp_path):
    docs = spark.createDataFrame([(f"A{i}", "{}") for i in range(7)], "accession string, document string").coalesce(1)

    def send(text: str) -> None:
        with open(tmp_path / "sent", "a") as f:
            f.write(str(text.count("\n")) + " ")

    plans.export_search_documents(docs, send, batch=3)
    assert (tmp_path / "sent").read_text() == "6 6 2 "


def test_arguments(spark, tmp_path):
    assert plans.check_sources("swissprot,trembl") == ["swissprot", "trembl"]
    for bad in ("", "x", "swissprot,", "swissprot trembl"):
        with pytest.raises(ValueError):
            plans.check_sources(bad)
    with pytest.raises(ValueError):
        plans.check_number("-1", "k")
    with pytest.raises(FileNotFoundError):
        plans.have(spark, str(tmp_path / "none"))


def test_bucketed_index(spark):
    index = spark.createDataFrame([(f"S{i}", i) for i in range(50)], "sequence string, taxon_id int")
    plans.write_index(index, "peptide_index", "sequence", 4)
    table = spark.table("peptide_index")
    plan = lookup.in_index(spark.createDataFrame([("S3",)], "sequence string"), table)
    assert plan.first().taxon_id == 3
    assert lookup.exact(table, sequence="S7").first().taxon_id == 7


def test_sql_functions(spark):
    functions_sql.register(spark, {"numbers": spark.range(3)})
    assert tuple(spark.sql("SELECT equate_il('AI'), tryptic_digest('AAKPGGRK', 1, 50), kmers('ABCD', 3), metadata_cut('X {E};'), standard_alphabet('B')").first()) == ("AL", ["AAKPGGR", "K"], ["ABC", "BCD"], "X", False)
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 3


def test_sql_tables_and_aggregates(spark, built, tmp_path):
    """Table functions, aggregates over lists, and functions over views, against the operators."""
    record = "AC   Q1;\nDT   01-JAN-2000, integrated into UniProtKB/TrEMBL.\nDT   x.\nDT   01-JAN-2000, entry version 3.\nOX   NCBI_TaxID=562;\nSQ   x\n     ACDK\n//\n"
    (tmp_path / "a.dat").write_text(record)
    functions_sql.register(spark, {"lineages": built["lineages"], "taxons": built["taxons"]}, str(tmp_path))
    assert [tuple(r) for r in spark.sql("SELECT accession, taxon_id, sequence FROM parse_flatfile()").collect()] == [("Q1", 562, "ACDK")]
    assert {r.id for r in spark.sql("SELECT id FROM validate_taxa() WHERE NOT valid").collect()} == {28384, 900001, 900003, 900004}
    bad = spark.sql("SELECT id FROM taxons WHERE NOT self_valid(id, name, rank)").collect()
    assert {r.id for r in bad} == {28384, 900001, 900003}
    got = spark.sql("SELECT lca(collect_set(cells)) AS a, count(*) AS n FROM lineage_table() WHERE taxon_id IN (562, 900005)").first()
    assert tuple(got) == (561, 2) and spark.sql("SELECT lca(collect_set(cells)) FROM lineage_table() WHERE taxon_id IN (543, 83333, 900001)").first()[0] == 562
    assert spark.sql("SELECT lca(collect_set(cells)) FROM lineage_table() WHERE taxon_id = 0").first()[0] == 1
    long = "".join(random.Random(1).choices("ACDEFGHIKLMNPQRSTVWY", k=700))
    spark.createDataFrame([(1, long), (2, "AC"), (3, None)], "id int, s string").createOrReplaceTempView("proteins")
    rows = spark.sql("SELECT id, place, kmer FROM proteins, LATERAL kmer_rows(s, 9) k").collect()
    assert sorted((r.place, r.kmer) for r in rows) == [(i, long[i : i + 9]) for i in range(692)]
    peptides = spark.sql("SELECT p.* FROM proteins, LATERAL peptide_rows(s, 5, 50) p").collect()
    assert [r.peptide for r in sorted(peptides)] == spark.range(1).select(tryptic_digest(F.lit(long))).first()[0] and all(r.equated == r.peptide.replace("I", "L") for r in peptides)
    terms = ["GO:1;EC:1.1.1.1;IPR:IPR1", "GO:1;GO:1", "", 'q"x']
    spark.createDataFrame([(1, t) for t in terms], "k int, fa string").createOrReplaceTempView("terms")
    want = aggregates.histogram_json(aggregates.term_histogram(spark.table("terms"), "k", "fa"), "k").first().fa
    assert spark.sql("SELECT term_histogram(collect_list(fa)) FROM terms").first()[0] == want
    assert spark.sql("SELECT term_histogram(collect_list('')) FROM terms").first()[0] is None
    assert spark.sql("SELECT collapse(collect_list(fa)) FROM terms WHERE fa > 'H'").first()[0] == 'q"x'
    assert [tuple(r) for r in spark.sql("SELECT * FROM number_rows(array('b', 'a', 'b', 'ü'))").collect()] == [(1, "a"), (2, "b"), (3, "ü")]


def test_terms_that_json_must_escape(spark):
    rows = spark.createDataFrame([(1, 'GO:"x";EC:\\'), (1, "GO:2"), (2, ""), (2, None)], "id int, fa string")
    got = aggregates.histogram_json(aggregates.term_histogram(rows, "id", "fa"), "id").collect()
    assert len(got) == 1 and json.loads(got[0].fa) == {"num": {"all": 2, "EC": 1, "GO": 2, "IPR": 0}, "data": {'GO:"x"': 1, "EC:\\": 1, "GO:2": 1}}


def test_running_offsets_over_blocks(spark):
    rows = spark.createDataFrame([(i, i % 4) for i in range(1, 101)], "id long, n long").repartition(5)
    got = {r.id: r.before for r in numbering.running_offsets(rows, F.col("n"), block=7).collect()}
    assert got == {i: sum(k % 4 for k in range(1, i)) for i in range(1, 101)}


def test_a_pluggable_aggregate(spark):
    lineages = spark.createDataFrame([(1, *[None] * 28)], LINEAGES)
    entries = spark.createDataFrame([(1, "ACDA"), (2, "ACD"), (3, "AXD")], "taxon_id int, sequence string")
    got = plans.kmer_index(entries, lineages, 3, lambda rows, key: rows.groupBy(key).agg(F.count_distinct("taxon_id").alias("taxa")))
    assert sorted(map(tuple, got.collect())) == [("ACD", 2), ("CDA", 1)]


def test_search_index_is_replaced_whole(spark):
    class Client:
        def __init__(self):
            self.held, self.alias = {}, {}

        def create(self, name, mapping):
            self.held[name] = mapping

        def point(self, alias, name):
            self.alias[alias] = name

        def drop(self, name):
            del self.held[name]

    client, loaded = Client(), []
    assert builds.replace_search_index(client, "entries", "2024.01", loaded.append) == "entries-2024-01" and loaded == ["entries-2024-01"]

    def fails(name):
        raise OSError(name)

    with pytest.raises(OSError):
        builds.replace_search_index(client, "entries", "2024.02", fails)
    assert list(client.held) == ["entries-2024-01"] and client.alias == {"entries": "entries-2024-01"}


def test_static_tables_are_saved_with_their_keys(spark):
    taxa = spark.createDataFrame([(1, "root", "no rank", 1, True), (2, "Frog virus", "species", 1, True)], TAXONS)
    spark.sql("CREATE DATABASE IF NOT EXISTS static")
    plans.save_static_database({"taxons": taxa}, "static")
    assert spark.table("static.taxons").count() == 2
    assert [r.id for r in lookup.search_blocks(spark.table("static.virtual_taxons"), "FROG species", "id").collect()] == [2]
    assert lookup.search_blocks(spark.table("static.virtual_taxons"), "frog root", "id").count() == 0
    with pytest.raises(ValueError):
        plans.static_database({"taxons": taxa.union(taxa)})
    with pytest.raises(ValueError):
        plans.static_database({"taxons": taxa.withColumn("name", F.nullif("name", F.lit("root")))})


def test_builds_name_what_is_missing(spark, tmp_path):
    with pytest.raises(ValueError, match="trembl"):
        builds.read_entries(spark, {"swissprot": str(tmp_path)})
    with pytest.raises(FileNotFoundError, match="nowhere"):
        builds.read_entries(spark, {"swissprot": str(tmp_path / "nowhere")}, "swissprot")


def test_a_cluster_needs_a_shared_folder():
    class Bare:
        class sparkContext:  # noqa: N801
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        storage.shared_dir(Bare)


def test_sides_are_measured_and_tables_removed(spark):
    from pathlib import Path

    df = spark.createDataFrame([("x" * 1000,)] * 50, "t string")
    assert not storage.is_small(df, 10_000) and storage.is_small(df, 100_000)
    with storage.scratch(spark):
        one, two = storage.stored(df, "one"), storage.stored(df, "two", keep=True)
        paths = [Path(x.inputFiles()[0].removeprefix("file://")).parent for x in (one, two)]
        assert all(p.exists() for p in paths)
    assert [p.exists() for p in paths] == [False, True]
