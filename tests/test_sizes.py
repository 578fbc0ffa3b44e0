"""What shows in large tables only, on small ones."""

import json
from collections import Counter
from glob import glob

import pytest
from pyspark.sql import functions as F

from metapep import demo, plans, storage
from metapep.operators import ancestors, dictionary, numbering, tables, taxonomy
from metapep.ranks import SLOTS


@pytest.fixture(scope="module")
def numbered_like_invalid_taxa(spark, tmp_path_factory):
    """Suppliers whose taxa have ids that the NCBI taxonomy's invalid ones have, as 60,000 suppliers do."""
    top = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{top}/region.parquet")
    spark.createDataFrame([(7, "FRANCE", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{top}/nation.parquet")
    spark.createDataFrame([(k, f"Supplier#{k}", 7) for k in (5, 18_384, 38_479)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{top}/supplier.parquet")
    spark.createDataFrame([(k, 7) for k in range(8)], "c_custkey long, c_nationkey int").write.parquet(f"{top}/customer.parquet")
    return top


def test_lineages_of_suppliers_numbered_like_invalid_taxa(spark, numbered_like_invalid_taxa):
    rows = {r.taxon_id: r for r in demo.lineages(spark, numbered_like_invalid_taxa).collect()}
    assert {i: rows[i].genus for i in (10_005, 28_384, 48_479)} == {i: i for i in (10_005, 28_384, 48_479)}
    assert rows[28_384].subspecies is None and rows[10_000_001].species == -10_000_001


def test_validity_of_suppliers_numbered_like_invalid_taxa(spark, numbered_like_invalid_taxa):
    valid = {r.id: r.valid for r in demo.taxon_validity(spark, numbered_like_invalid_taxa).collect()}
    assert valid[10_005] and valid[28_384] and valid[48_479] and not valid[10_000_001]


@pytest.fixture(scope="module")
def meeting_ids(spark, tmp_path_factory):
    """Keys shifted so far that taxa of suppliers and customers have an id in common; a nation twice; nations that are missing, null or of no region; no names and no keys."""
    top = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "EUROPE"), (2, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{top}/region.parquet")
    spark.createDataFrame([(7, "FRANCE", 1), (8, "CHINA", 2), (8, "TWICE", 1), (9, "NOWHERE", 77)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{top}/nation.parquet")
    suppliers = [(5, "Supplier#5", 7), (9_990_001, "Supplier#6", 7), (9_990_002, "Supplier#7", 8), (9_990_003, "water sample", 7), (10, "lost", 99), (11, "lost", 9), (12, "lost", None), (13, None, 7), (14, "uncultured", 99), (None, "none", 7)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{top}/supplier.parquet")
    spark.createDataFrame([*[(k, 7 + k % 2) for k in range(8)], (2, 8), (3, 7), (20, 99), (None, 7)], "c_custkey long, c_nationkey int").write.parquet(f"{top}/customer.parquet")
    return top


def test_validity_of_taxa_whose_ids_meet_is_that_of_the_sql(spark, meeting_ids):
    """Each row is judged by itself, once for every way to the root, and without such a way it has none."""
    con = pytest.importorskip("duckdb").connect()
    for t in ("region", "nation", "supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{meeting_ids}/{t}.parquet/*.parquet')")
    want = Counter(con.execute(f"SELECT id, name, rank, parent_id, valid FROM ({demo.ORACLES['taxon_validity']})").fetchall())
    got = Counter(map(tuple, demo.taxon_validity(spark, meeting_ids).collect()))
    assert got == want
    assert {r[3:] for r in got if r[0] == 10_000_001} == {(107, True), (108, False)} and got[10_000_002, "Supplier#7", "genus", 108, True] == 2
    assert [r[4] for r in got if r[0] == 10_013] == [None] and not any(r[0] in (10_010, 10_011, 10_012, 10_014, 10_000_020, None) for r in got)


def test_lineages_of_taxa_whose_ids_meet(spark, meeting_ids):
    rows = Counter((r.taxon_id, r.phylum, r.genus, r.species) for r in demo.lineages(spark, meeting_ids).collect() if r.taxon_id in (10_000_001, 10_000_020, 10_010))
    assert rows == {(10_000_001, 107, 10_000_001, None): 1, (10_000_001, 108, -1, -10_000_001): 2}


def test_nested_set_of_taxa_whose_ids_meet(spark):
    """A row for each, not one for each pair."""
    rows = [(1, 1), (2, 1), (3, 1), (7, 2), (7, 3), (8, 2)]
    tree = storage.cut(taxonomy.nested_set(spark.createDataFrame(rows, "id int, parent_id int")))
    got = sorted(map(tuple, tree.select("first", "id", "parent_id", "depth").collect()))
    assert got == [(1, 1, 1, 1), (2, 2, 1, 2), (3, 7, 2, 3), (4, 8, 2, 3), (5, 3, 1, 2), (6, 7, 3, 3)]
    sets = spark.createDataFrame([(0, 3, 4), (1, 4, 6), (2, 6, 6)], "k int, lo long, hi long")
    assert sorted(map(tuple, taxonomy.tree_ancestors(sets, tree).collect())) == [(0, 2), (1, 1), (2, 7)]


def test_tree_ancestors_deal_no_row_out_by_an_ancestor(spark, monkeypatch):
    """No join of the sets' rows is by an ancestor: a key that all have in common would be a task's."""
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    parents = [(1, 1)] + [(i, 1) for i in range(2, 6)] + [(i, 2 + i % 4) for i in range(10, 60)] + [(100, 99), (101, 100)]
    tree = storage.cut(taxonomy.nested_set(spark.createDataFrame(parents, "id int, parent_id int")))
    first = {r.id: r.first for r in tree.collect()}
    rows = [(k, [10 + k % 50, 10 + (k * 7) % 50]) for k in range(200)] + [(200, [100, 101]), (201, [2, 101]), (202, [101, 101])]
    sets = spark.createDataFrame([(k, min(first[i] for i in t), max(first[i] for i in t)) for k, t in rows] + [(203, None, None)], "k int, lo long, hi long")
    plans: list[str] = []
    whole = storage.cut
    monkeypatch.setattr(taxonomy, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or whole(df))
    out = taxonomy.tree_ancestors(sets, tree)
    got = {r.k: r.ancestor for r in out.collect()}
    assert {k: got[k] for k in range(200, 204)} == {200: 100, 201: None, 202: 101, 203: None}
    assert all(got[k] == (a if a == b else 2 + a % 4 if a % 4 == b % 4 else 1) for k, (a, b) in rows[:200])
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert "Join" in plans[-1] and not any("explode" in p for p in plans)


def test_few_keys_of_a_large_table_are_looked_up(spark, monkeypatch):
    """Rows of few values are not dealt out by them, however large the table is."""
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 4096)
    rows = spark.createDataFrame([(i, i % 3 if i % 7 else None) for i in range(300)], "i int, t int")
    table = spark.range(5000).select(F.col("id").cast("int").alias("_t"), (F.col("id") * 2).alias("v")).filter("_t <> 1")
    out = storage.join_looked_up(rows, table, "t", "_t")
    assert {(r.i, r.t, r.v) for r in out.collect()} == {(i, t, None if t in (1, None) else 2 * t) for i, t in ((i, i % 3 if i % 7 else None) for i in range(300))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for how in ("inner", "left_semi"):
        assert storage.join_looked_up(rows, table, "t", "_t", how).count() == sum(1 for i in range(300) if i % 7 and i % 3 != 1)


def test_peptides_are_numbered_by_counts_alone(spark, monkeypatch):
    """What is put in blocks of entries, each a task's, is a number an entry and not its text."""
    seen: list[list[str]] = []
    whole = numbering.running_offsets
    monkeypatch.setattr(tables, "running_offsets", lambda df, count: seen.append(df.columns) or whole(df, count, block=4))
    none = F.array().cast("array<string>")
    entries = spark.range(1, 31).select("id", F.repeat(F.lit("ACDEFK"), (F.col("id") % 4).cast("int")).alias("sequence"), F.lit(1).alias("taxon_id"), none.alias("ec"), none.alias("go"), none.alias("ipr"))
    got = sorted(map(tuple, tables.peptide_table(entries.repartition(3)).select("peptide_id", "entry_id", "sequence").collect()))
    assert got == [(n, i, "ACDEFK") for n, i in enumerate((i for i in range(1, 31) for _ in range(i % 4)), 1)]
    assert seen == [["id", "_n"]]


def test_kmers_of_a_task_and_rows_of_a_bucket_are_bounded(spark, tmp_path, monkeypatch):
    """However large the input's files, a task makes k-mers of so many residues, and a bucket has so many rows."""
    monkeypatch.setattr(plans, "TASK_LETTERS", 2000)
    monkeypatch.setattr(plans, "BUCKET_ROWS", 100)
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 4096)
    parts: list[int] = []
    whole = plans.packed_kmers
    monkeypatch.setattr(plans, "packed_kmers", lambda rows, k: parts.append(rows.rdd.getNumPartitions()) or whole(rows, k))
    lineages = spark.range(2, 500).select(F.col("id").cast("int").alias("taxon_id"), *[F.col("id").cast("int").alias(s) if s == "species" else F.lit(1_000).alias(s) if s == "genus" else F.lit(None).cast("int").alias(s) for s in SLOTS])
    letters = "ACDEFGHIKLMNPQRSTVWY"
    texts = ["".join(letters[(i * 7 + j * j) % 20] for j in range(100)) for i in range(60)]
    entries = spark.createDataFrame([(2 + i % 3, t) for i, t in enumerate(texts)], "taxon_id int, sequence string").coalesce(1)
    index = plans.write_index(plans.kmer_index(entries, lineages), "bounded", "kmer", 2, str(tmp_path / "bounded"))
    taxa: dict[str, set[int]] = {}
    for i, t in enumerate(texts):
        for j in range(92):
            taxa.setdefault(t[j : j + 9], set()).add(2 + i % 3)
    assert {r.kmer: r.lca for r in index.collect()} == {k: next(iter(v)) if len(v) == 1 else 1_000 for k, v in taxa.items()}
    assert parts == [3]
    assert spark.sql("DESCRIBE EXTENDED bounded").filter("col_name = 'Num Buckets'").first().data_type == str(-(-len(taxa) // 100))
    spark.sql("DROP TABLE bounded")


def test_lineages_of_the_taxa_that_are_asked_for(spark, monkeypatch):
    """Of a large taxonomy only they have a row, and the same as among all."""
    taxa = spark.createDataFrame([(1, "root", "no rank", 1), (11, "A", "domain", 1), *[(i, f"T{i % 5}" if i % 5 else "T sample", "species", 11) for i in range(100, 160)]], "id int, name string, rank string, parent_id int")
    paths = taxonomy.with_paths(taxa)
    every = {r.taxon_id: r for r in taxonomy.lineage_table(paths).collect()}
    for limit in (storage.BROADCAST_BYTES, 0):
        monkeypatch.setattr(storage, "BROADCAST_BYTES", limit)
        few = taxonomy.lineage_table(paths, spark.createDataFrame([(i,) for i in (100, 101, 101, 11, 7, None)], "taxon_id int")).collect()
        assert sorted(few, key=lambda r: r.taxon_id) == [every[i] for i in (11, 100, 101)]


def test_peptide_index_without_n_makes_no_histograms(spark, monkeypatch):
    """Who needs common ancestors alone pays for no annotations and no numbers."""
    monkeypatch.setattr(tables, "sequence_table", lambda *_: pytest.fail("made the whole table"))
    rows = demo.tryptic_index_compat(spark, "/root/testdata/sf0.001").collect()
    assert rows and not any("N" in r.sequence for r in rows)


def test_summaries_are_made_once_for_their_numbers(spark, monkeypatch):
    """A sort by range reads its input twice: that is a table, not the aggregates."""
    plans_: list[str] = []
    whole = tables.number_rows
    monkeypatch.setattr(tables, "number_rows", lambda df, order: plans_.append(df._jdf.queryExecution().optimizedPlan().toString()) or whole(df, order))
    lineages = spark.range(2, 5).select(F.col("id").cast("int").alias("taxon_id"), *[F.col("id").cast("int").alias(s) if s == "species" else F.lit(None).cast("int").alias(s) for s in SLOTS])
    peptides = spark.createDataFrame([("AI", "AL", 2, "GO:1"), ("AL", "AL", 2, ""), ("AL", "AL", 3, "GO:1")], "sequence string, eq_sequence string, taxon_id int, fa string")
    rows = tables.sequence_table(peptides, lineages).select("id", "sequence", "lca", "lca_il").collect()
    assert sorted(map(tuple, rows)) == [(1, "AI", 2, None), (2, "AL", 1, 1)]
    assert len(plans_) == 1 and "Aggregate" not in plans_[0]


def test_buckets_of_a_dictionary_grow_with_its_first_release(spark, tmp_path, monkeypatch):
    """A bucket has so many strings, however many there are; later releases are dealt out as the first."""
    monkeypatch.setattr(dictionary, "BUCKET_ROWS", 10)
    known = dictionary.Dictionary(spark, str(tmp_path / "grown"), 2)
    known.append(spark.range(45).select(F.format_string("a%03d", "id").alias("s")), "s", 1)
    known.append(spark.range(40, 50).select(F.format_string("a%03d", "id").alias("s")), "s", 2)
    assert [storage.listed(spark, f"{tmp_path}/grown/release={r}") for r in (1, 2)] == [["data-b5"], ["data-b5"]]
    assert {(r.id, r.text, r.release) for r in known.read().collect()} == {(i + 1, f"a{i:03d}", 1 if i < 45 else 2) for i in range(50)}


def _summaries(spark, peptides, lineages):
    rows = tables.sequence_table(peptides, lineages).collect()
    return [tuple(r) for r in sorted(rows, key=lambda r: r.id)]


def test_sequences_that_very_many_peptides_have(spark, monkeypatch):
    """Those are counted by partial aggregates, the others behind one shuffle; a row is the same either way, with taxa sent whole or looked up."""
    lineages = spark.range(2, 7).select(F.col("id").cast("int").alias("taxon_id"), *[F.col("id").cast("int").alias(s) if s == "species" else F.when(F.col("id") < 5, 40).otherwise(50).cast("int").alias(s) if s == "genus" else F.lit(None).cast("int").alias(s) for s in SLOTS])
    i = F.col("id")
    peptides = spark.range(900).select(F.when(i < 500, F.when(i % 2 == 0, "AIK").otherwise("ALK")).otherwise(F.concat(F.lit("A"), F.element_at(F.array(F.lit("I"), F.lit("L"), F.lit("V")), (i % 3 + 1).cast("int")), (i % 40).cast("string"))).alias("sequence"), (i % 6 + 2).cast("int").alias("taxon_id"), F.element_at(F.array(F.lit(""), F.lit("GO:1;EC:2"), F.lit("GO:1;GO:1"), F.lit(None).cast("string")), (i % 4 + 1).cast("int")).alias("fa"))
    peptides = peptides.withColumn("eq_sequence", F.translate("sequence", "I", "L"))
    whole = _summaries(spark, peptides, lineages)
    monkeypatch.setattr(ancestors, "TASK_ROWS", 100)
    total, frequent = ancestors.frequent_keys(peptides, F.col("eq_sequence"))
    assert total == 900 and {r.sequence for r in peptides.filter(frequent).select("sequence").distinct().collect()} == {"AIK", "ALK"}
    assert _summaries(spark, peptides, lineages) == whole
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    assert _summaries(spark, peptides, lineages) == whole
    # by hand
    rows = [(r.sequence, r.eq_sequence, r.fa) for r in peptides.collect()]
    assert [r[1] for r in whole] == sorted({x for r in rows for x in r[:2]})
    for r in whole:
        for k, fa in ((0, r[4]), (1, r[5])):
            terms = [t for x in rows if x[k] == r[1] for t in (x[2] or "").split(";") if t]
            assert (json.loads(fa)["data"] if fa else {}) == {t: terms.count(t) for t in terms}
            assert fa is None or json.loads(fa)["num"]["all"] == sum(x[k] == r[1] for x in rows)


def test_disk_of_a_sequence_table(spark, monkeypatch):
    """Peptides are shuffled once; shuffle files and summaries are gone when the rows are numbered."""
    plans_: list[str] = []
    whole = tables.stored
    monkeypatch.setattr(tables, "stored", lambda df, *a, **b: plans_.append(df._jdf.queryExecution().executedPlan().toString()) or whole(df, *a, **b))
    lineages = spark.range(2, 5).select(F.col("id").cast("int").alias("taxon_id"), *[F.col("id").cast("int").alias(s) if s == "species" else F.lit(None).cast("int").alias(s) for s in SLOTS])
    peptides = spark.range(2000).select(F.concat(F.lit("AI"), F.col("id")).alias("sequence"), F.concat(F.lit("AL"), F.col("id")).alias("eq_sequence"), (F.col("id") % 3 + 2).cast("int").alias("taxon_id"), F.lit("GO:1").alias("fa"))
    shared = storage.shared_dir(spark)
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files() -> tuple[set, set]:
        return {f for d in dirs for f in glob(f"{d}/*/shuffle_*.data")}, {n for n in storage.listed(spark, shared) if n.startswith("summaries")}

    number, seen = tables.number_rows, []
    monkeypatch.setattr(tables, "number_rows", lambda df, order: seen.append(files()[0]) or number(df, order))
    before = files()
    table = tables.sequence_table(peptides, lineages)
    after = files()
    assert plans_[0].count("Exchange hashpartitioning") == 1
    assert not after[1] - before[1] and not after[0] - seen[0]
    assert table.count() == 4000 and [r.sequence for r in table.filter("id IN (1, 4000)").orderBy("id").collect()] == ["AI0", "AL999"]


def test_numbers_of_rows_that_parquet_cannot_hold(spark):
    """A column without a type is numbered as before; parts without rows count nothing."""
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3)], "s string, v int").withColumn("none", F.lit(None))
    assert sorted(tuple(r) for r in numbering.number_rows(rows, ["s", "v"], start=5).collect()) == [(5, "a", 2, None), (6, "a", 3, None), (7, "b", 1, None)]
