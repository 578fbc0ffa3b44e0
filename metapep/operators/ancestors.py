"""Lowest common ancestors by lineage classes.

Lineages whose usable cells agree are one class; without genus and species, whose empty
cells agree with everything, a class is a path from the root that ends where its taxon
stops being valid.  Classes are numbered twice, in the order of their paths: `pre` puts a
path before those that go on from it, `post` behind them.  Of any set of classes the
least post is the leftmost path that none of the set goes on from, the largest pre the
rightmost; where these two part, the common ancestor ends.  So a set of lineages is
summarised by two numbers, and by the least and largest genus and species, in place of
two cells a rank; paths are looked up once a set.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import equate_il
from ..ranks import ROOT, SLOTS
from ..storage import cut, is_small, join_checked, join_looked_up, shuffles_dropped
from .aggregates import CATEGORIES, histogram_columns, histogram_text, lca_columns, lca_fold, marked, terms_of, with_cells
from .numbering import number_rows

#: Slots whose empty cells agree with every other.
OPEN = ("genus", "species")
PATH = tuple(s for s in SLOTS if s not in OPEN)
#: What a row has of its class, and what a set of rows has.
CLASS = ("_pre", "_post", "_genus", "_species")
SUMMARY = ("_pre", "_post", "_genus0", "_genus1", "_species0", "_species1")
#: Most bytes of the paths that go to every executor.
PATH_BYTES = 64 << 20
#: Peptides that a task summarises, and buckets by which they are counted before.
TASK_ROWS, COUNT_BUCKETS = 1 << 18, 1 << 16


@dataclass
class Classes:
    """taxa: (taxon_id, _pre, _post, _genus, _species); paths: (_pre, _post, _path, _deepest), the last by number of cells from the root the place of the last one that holds a taxon, or -1."""

    taxa: DataFrame
    paths: DataFrame


def _usable_path() -> Column:
    cells = F.array(*[F.coalesce(F.col(s), F.lit(0)) for s in PATH])
    bad = F.array_position(F.transform(cells, lambda x: x < 0), F.lit(True)).cast("int")
    return F.when(bad == 0, cells).otherwise(F.slice(cells, F.lit(1), F.greatest(bad - 1, F.lit(0))))


def _deepest() -> Column:
    return F.aggregate("_path", F.array(F.lit(-1)), lambda out, x: F.concat(out, F.array(F.when(x > 0, F.size(out) - 1).otherwise(F.element_at(out, -1)))))


def lineage_classes(lineages: DataFrame) -> Classes | None:
    """The classes of a table of lineages with all slots; None if a usable cell follows an unusable one in a path, which no lineage_table() has."""
    if set(lineages.columns) != {"taxon_id", *SLOTS}:
        return None
    tail = F.array(*[F.coalesce(F.col(s), F.lit(0)) for s in PATH])
    path = _usable_path()
    gap = F.exists(F.slice(tail, F.size(path) + 1, F.lit(len(PATH))), lambda x: x >= 0)
    own = cut(lineages.select("taxon_id", path.alias("_path"), gap.alias("_gap"), *[F.when(F.col(s) > 0, F.col(s)).alias(f"_{s}") for s in OPEN]))
    if not own.filter("_gap").isEmpty():
        return None
    paths = number_rows(own.select("_path").distinct(), ["_path"], "_pre")
    behind = F.concat("_path", F.array(F.lit((1 << 31) - 1)))
    paths = number_rows(paths.withColumn("_behind", behind), ["_behind"], "_post")
    paths = cut(paths.select(F.col("_pre").cast("int").alias("_pre"), F.col("_post").cast("int").alias("_post"), "_path", _deepest().alias("_deepest")))
    return Classes(cut(own.join(paths, "_path").select("taxon_id", *CLASS)), paths)


def with_classes(rows: DataFrame, classes: Classes, taxon: str = "taxon_id") -> DataFrame:
    """rows with the class of their taxon, four integers; null where it has no lineage. Taxa that rows have are looked up, so one that very many rows have is no skew."""
    own = classes.taxa.withColumnRenamed("taxon_id", "_t")
    return join_looked_up(rows, own, taxon, "_t")


def summary_columns() -> list[Column]:
    """Aggregates over rows with a class."""
    ends = [f(f"_{s}").alias(f"_{s}{k}") for s in OPEN for k, f in enumerate((F.min, F.max))]
    return [F.max("_pre").alias("_pre"), F.min("_post").alias("_post"), *ends]


def ancestor_of(sets: DataFrame, classes: Classes, name: str = "lca") -> DataFrame:
    """sets, which have the SUMMARY, with the common ancestor in its place; the root for sets without lineage.

    Cells are compared only where a set has more than one path; else, and behind that,
    what a row takes is the same work for any number of slots.
    """
    rest = [c for c in sets.columns if c not in SUMMARY]
    left = classes.paths.select("_post", F.col("_pre").alias("_first"), F.col("_path").alias("_left"))
    right = classes.paths.select("_pre", F.col("_path").alias("_right"), "_deepest")
    both = join_checked(join_checked(sets, left, "_post", "left", PATH_BYTES), right, "_pre", "left", PATH_BYTES)
    at, slots = {s: i for i, s in enumerate(SLOTS)}, len(SLOTS)
    # where the paths part, as a place in a path and then as a slot
    differ = F.array_position(F.zip_with("_left", "_right", lambda x, y: x != y), True).cast("int")
    parts = F.when(F.col("_first") == F.col("_pre"), len(PATH)).when(differ > 0, differ - 1).otherwise(len(PATH))
    ends = [F.when(F.col(f"_{s}0") != F.col(f"_{s}1"), at[s]).otherwise(slots) for s in OPEN]
    both = both.withColumn("_part", F.least(F.get(F.array(*[F.lit(at[s]) for s in PATH], F.lit(slots)), parts), *ends))
    # cells of the path before that slot, and the last of them with a taxon
    cells = F.col("_part") - sum((F.when(F.col("_part") > at[s], 1).otherwise(0) for s in OPEN), F.lit(0))
    both = both.withColumn("_last", F.get("_deepest", F.least(cells, F.size("_deepest") - 1)))
    slot = F.coalesce(F.get(F.array(*[F.lit(at[s]) for s in PATH]), F.col("_last")), F.lit(-1))
    found = F.get("_right", F.col("_last"))
    for s in sorted(OPEN, key=SLOTS.index):
        found = F.when((F.col("_part") > at[s]) & (slot < at[s]) & (F.col(f"_{s}1") > 0), F.col(f"_{s}1")).otherwise(found)
    return both.select(*rest, F.coalesce(found, F.lit(ROOT)).cast("int").alias(name))


def lowest_common_ancestors(rows: DataFrame, lineages: DataFrame, key: str, taxon: str = "taxon_id", name: str = "lca") -> DataFrame:
    """(key, name): the lowest common ancestor of the key's taxa; taxa without lineage are ignored, without any it is the root.

    What is shuffled is one row of six integers a key and task.
    """
    own = rows.select(key, F.col(taxon).alias("_taxon"))
    classes = lineage_classes(lineages)
    if classes is None:
        slots = tuple(c for c in lineages.columns if c != "taxon_id")
        cells = with_cells(own, lineages, "_taxon")
        return cells.groupBy(key).agg(*lca_columns(slots)).select(key, lca_fold(slots).cast("int").alias(name))
    return ancestor_of(with_classes(own, classes, "_taxon").groupBy(key).agg(*summary_columns()), classes, name)


def frequent_keys(rows: DataFrame, key: Column) -> tuple[int, Column | None]:
    """The number of rows, and a condition on those whose key may have more than a task should by itself; None if there are none.

    Rows are counted by buckets of the key's hash.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(COUNT_BUCKETS)).cast("int")
    large = F.when(F.col("n") > TASK_ROWS, F.struct("_b", "n"))
    counts = rows.groupBy(bucket.alias("_b")).agg(F.count("*").alias("n"))
    with shuffles_dropped(rows.sparkSession):
        total, found = counts.agg(F.sum("n"), F.collect_list(large)).first()
    total = total or 0
    found = [x["_b"] for x in found if x["n"] > 4 * total // COUNT_BUCKETS]
    return total, bucket.isin(found) if found else None


def sequence_summary(peptides: DataFrame, lineages: DataFrame) -> DataFrame:
    """(sequence, lca, lca_il, fa, fa_il) of rows (sequence, taxon_id, fa), by text.

    Every row counts for its sequence and, apart from that, for its equated one; what a
    sequence isn't is null.  Peptides are shuffled once, a narrow row each, by their
    equated sequence: with it go all rows of both sides, which are made and counted
    behind the shuffle.  Sequences that very many peptides have are counted by partial
    aggregates instead.
    """
    every, has = marked(terms_of(F.col("fa")))
    classes = lineage_classes(lineages)
    cells = [c for c in lineages.columns if c != "taxon_id"] if classes is None else [*CLASS]
    ends = lca_columns() if classes is None else summary_columns()
    flags = [f"_{c}" for c in CATEGORIES]
    parts = [*flags, *cells]
    row, one, other = F.col("_term").isNull(), ~F.col("il"), F.col("il")
    side = F.array(F.struct(F.col("sequence"), F.lit(False).alias("il")), F.struct(F.col("_eq").alias("sequence"), F.lit(True).alias("il")))

    def placed(rows: DataFrame) -> DataFrame:
        return with_cells(rows, lineages) if classes is None else with_classes(rows, classes)

    def summed(rows: DataFrame) -> DataFrame:
        rows = rows.select(equate_il(F.col("sequence")).alias("_eq"), "sequence", every.alias("_every"), *has, *cells)
        rows = rows.select("_eq", F.explode(side).alias("s"), "_every", *parts).select("_eq", "s.sequence", "s.il", F.explode("_every").alias("_term"), *parts)
        rows = rows.select("_eq", "sequence", "il", "_term", *[c if c in flags else F.when(row, F.col(c)).alias(c) for c in parts])
        counts = rows.groupBy("_eq", "sequence", "il", "_term").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in flags], *ends)
        counts = counts.withColumn("_lca", lca_fold().cast("int")) if classes is None else ancestor_of(counts, classes, "_lca")
        lca = [F.max(F.when(x & row, F.col("_lca"))).alias(name) for x, name in ((one, "lca"), (other, "lca_il"))]
        both = counts.groupBy("_eq", "sequence").agg(*lca, *histogram_columns(one), *histogram_columns(other, "_il"))
        return both.select("sequence", "lca", "lca_il", histogram_text().alias("fa"), histogram_text("_il").alias("fa_il"))

    own, eq = peptides.select("sequence", "taxon_id", "fa"), equate_il(F.col("sequence"))
    total, frequent = frequent_keys(own, eq)
    tasks = max(-(-total // TASK_ROWS), peptides.sparkSession.sparkContext.defaultParallelism)
    few = own if frequent is None else own.filter(~frequent)
    # a small table of taxa is sent to where the rows are, and so need not be shuffled with them
    if is_small(lineages if classes is None else classes.taxa):
        out = summed(placed(few.repartition(tasks, eq)))
    else:
        out = summed(placed(few).repartition(tasks, eq))
    return out if frequent is None else out.union(summed(placed(own.filter(frequent))))
