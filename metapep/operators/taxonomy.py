"""Taxonomy: validity of taxa and their lineages of 28 ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ranks import RANKS, ROOT, SLOTS
from ..storage import cut, join_checked, join_looked_up, stored
from .numbering import number_rows

# Taxa and parts of names that make a taxon invalid.
INVALID_IDS = (28384, 48479, 1869227)
INVALID_ANYWHERE = ("enrichment culture", "mixed culture", "uncultured", "unidentified", "unspecified", "undetermined", "sample")
INVALID_AT_END = ("metagenome", "library")


def self_valid(id_: Column, name: Column, rank: Column, invalid_ids: tuple[int, ...] = INVALID_IDS) -> Column:
    """Whether a taxon is valid but for its ancestors.  invalid_ids: taxa of the NCBI taxonomy; none where ids are of another numbering."""
    vague = (name.rlike(r"\p{Nd}") & ~name.contains("virus")) | name.endswith(" sp.") | name.endswith(" genomosp.") | name.contains(" bacterium")
    bad = (rank == "species") & vague
    for x in INVALID_ANYWHERE:
        bad = bad | name.contains(x)
    for x in INVALID_AT_END:
        bad = bad | name.endswith(x)
    return ~(bad | id_.isin(*invalid_ids))


def rank_index(rank: Column) -> Column:
    """Place of the rank in RANKS; an unknown one is an error."""
    known = F.create_map(*[F.lit(x) for i, r in enumerate(RANKS) for x in (r, i)])
    return F.coalesce(F.try_element_at(known, rank), F.raise_error(F.concat(F.lit("unknown rank: "), F.coalesce(rank, F.lit("null")))).cast("int"))


#: Rounds of pointer doubling, for trees of 4096 levels.
ROUNDS = 12


def _chains(own: DataFrame, *kept: str) -> DataFrame:
    """(id, the columns kept, chain): every taxon's ancestors, root end first and itself last, as structs of id, rank and validity of its own.

    Pointers are doubled: every taxon has the chain up to a pointer, and takes over the
    chain and pointer found there, so the rounds grow with the logarithm of the depth.
    Rows of one id stay rows of their own, each with what is kept of it; a taxon whose
    ancestor has several has a row for each.
    """
    own = own.filter("id is not null")
    known = own.select(F.col("id").alias("_id")).distinct()
    up = F.when((F.col("id") != ROOT) & F.col("_id").isNotNull(), F.col("parent_id"))
    ok = F.col("_ok") & ((F.col("id") == ROOT) | F.col("_id").isNotNull())
    link = F.array(F.struct("id", F.col("_rank").alias("rank"), ok.alias("ok")))
    chains = cut(own.join(known, F.col("parent_id") == F.col("_id"), "left").select("id", *kept, up.alias("up"), link.alias("chain")))
    for k in range(ROUNDS + 1):
        open_ = chains.filter("up is not null")
        if open_.isEmpty():
            break
        if k == ROUNDS:
            raise ValueError(f"{open_.count()} taxa are not connected with the root or a missing parent")
        # those that have ended wait
        above = chains.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("chain").alias("_chain"))
        moved = open_.join(above, F.col("up") == F.col("_id")).select("id", *kept, F.col("_up").alias("up"), F.concat("_chain", "chain").alias("chain"))
        chains = cut(chains.filter("up is null").union(moved))
    return chains.drop("up")


def nested_set(taxa: DataFrame) -> DataFrame:
    """(id, parent_id, first, last, depth) of taxa (id, parent_id): first numbers them from 1 in preorder, children by id, and last is the greatest number below a taxon or its own.

    So what lies below a taxon is a range of numbers.  Paths of ids stand in preorder
    when they are sorted, so no tree is walked; the taxa below are counted by one
    aggregate over all ancestors.  A taxon whose parent is missing starts a tree of its own.
    """
    own = cut(taxa.select("id", "parent_id", F.lit(0).alias("_rank"), F.lit(True).alias("_ok")))
    paths = cut(_chains(own, "parent_id").select("id", "parent_id", F.col("chain.id").alias("_path")))
    below = paths.select(F.explode("_path").alias("id")).groupBy("id").agg(F.count("*").alias("_n"))
    numbered = number_rows(paths, ["_path"], "first")
    return numbered.join(below, "id").select("id", "parent_id", "first", (F.col("first") + F.col("_n") - 1).alias("last"), F.size("_path").alias("depth"))


def tree_ancestors(sets: DataFrame, tree: DataFrame, name: str = "ancestor") -> DataFrame:
    """sets (…, lo, hi: the least and greatest `first` of some taxa) with their lowest common ancestor: the last taxon that the paths of both share; null for taxa of different trees.

    Paths are looked up by the two numbers, so no row is dealt out by an ancestor, of
    which the root is everyone's.  Taxa without any below may have an id in common.
    """
    sets = stored(sets, "sets", keep=True)
    up = _chains(tree.select("id", "parent_id", "first", F.lit(0).alias("_rank"), F.lit(True).alias("_ok")), "first")
    paths = cut(up.select("first", F.col("chain.id").alias("_path")))
    both = sets
    for end in ("lo", "hi"):
        both = join_looked_up(both, paths.select(F.col("first").alias("_first"), F.col("_path").alias(f"_{end}")), end, "_first")
    shared = F.array_intersect("_lo", "_hi")
    return both.withColumn(name, F.get(shared, F.size(shared) - 1)).drop("lo", "hi", "_lo", "_hi")


def with_paths(taxa: DataFrame, invalid_ids: tuple[int, ...] = INVALID_IDS) -> DataFrame:
    """(id, name, rank, parent_id, valid, path, rooted) of taxa (id, name, rank, parent_id); invalid_ids as self_valid() takes them.

    path holds the ranked ancestors, root end first and the taxon itself last, as
    structs of id, rank and validity.  A taxon whose parent is missing starts a tree
    of its own, is invalid and not rooted.  Taxa in a cycle other than the root's never
    end and are an error.  Taxa that have an id in common are judged each by its own row.
    """
    own = cut(taxa.select("id", "name", "rank", "parent_id", self_valid(F.col("id"), F.col("name"), F.col("rank"), invalid_ids).alias("_ok"), rank_index(F.col("rank")).alias("_rank")))
    chains = _chains(own, "name", "rank", "parent_id")
    # the cast lets it become null, as a taxon without name is neither
    begin = F.struct(F.lit(True).alias("valid"), F.array().alias("path")).cast("struct<valid:boolean,path:array<struct<id:int,rank:int,valid:boolean>>>")

    def step(s: Column, x: Column) -> Column:
        valid = s["valid"] & x["ok"]
        ranked = (x["rank"] > 0) & (x["id"] != ROOT)
        put = F.concat(s["path"], F.array(F.struct(x["id"].alias("id"), x["rank"].alias("rank"), valid.alias("valid"))))
        return F.struct(valid.alias("valid"), F.when(ranked, put).otherwise(s["path"]).alias("path"))

    rooted = F.get("chain", F.lit(0))["id"] == ROOT
    folded = chains.select("id", "name", "rank", "parent_id", F.aggregate("chain", begin, step).alias("f"), rooted.alias("rooted"))
    return cut(folded.select("id", "name", "rank", "parent_id", "f.valid", "f.path", "rooted"))


def taxon_table(paths: DataFrame) -> DataFrame:
    """(id, name, rank, parent_id, valid)."""
    return paths.select("id", "name", "rank", "parent_id", "valid")


def lineage_table(paths: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """(taxon_id, 28 slots): positive ids of valid ancestors, negative of invalid ones.

    From the taxon up, every ranked ancestor takes the slot of its rank, or the next
    free more general one if that is taken or passed.  A slot without ancestor is null
    below a valid chain member (the closest more specific one; the first, for slots more
    specific than all) and -1 below an invalid one; without any ranked ancestor all are null.
    taxa: (taxon_id), repeated or not, of those that are asked for: only these have a row
    then, which spares the work on a large taxonomy of which few taxa occur.
    """
    if taxa is not None:
        paths = join_checked(paths, cut(taxa.select(F.col("taxon_id").alias("_t")).distinct()), F.col("id") == F.col("_t"), "left_semi")
    chain = F.reverse("path")
    begin = F.struct(F.lit(len(RANKS)).alias("at"), F.array().cast("array<struct<at:int,id:int,valid:boolean>>").alias("put"))

    def place(state: Column, x: Column) -> Column:
        at = F.least(x["rank"], state["at"] - 1)
        put = F.concat(state["put"], F.array(F.struct(at.alias("at"), x["id"].alias("id"), x["valid"].alias("valid"))))
        return F.struct(at.alias("at"), F.when(at >= 1, put).otherwise(state["put"]).alias("put"))

    placed = paths.select(F.col("id").alias("taxon_id"), F.aggregate(chain, begin, place, lambda s: s["put"]).alias("put"))

    def slot(k: int) -> Column:
        here = F.get(F.filter("put", lambda x: x["at"] == k), F.lit(0))
        # placed from specific to general: the last one beyond k is the closest
        beyond = F.filter("put", lambda x: x["at"] > k)
        closest = F.when(F.size(beyond) > 0, F.get(beyond, F.size(beyond) - 1)["valid"]).otherwise(F.get(F.col("put"), F.lit(0))["valid"])
        gap = F.when(F.coalesce(closest, F.lit(True)), F.lit(None).cast("int")).otherwise(-1)
        return F.when(here.isNotNull(), F.when(here["valid"], here["id"]).otherwise(-here["id"])).otherwise(gap)

    return placed.select("taxon_id", *[slot(k).cast("int").alias(s) for k, s in enumerate(SLOTS, 1)])
