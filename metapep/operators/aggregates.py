"""Aggregations of the tables: collapsed lists, common ancestors, annotation histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import term_category
from ..ranks import ROOT, SLOTS
from ..storage import join_looked_up


def collapse(df: DataFrame, key: str, value: str, name: str = "values") -> DataFrame:
    """(key, name): the key's values in byte order, with repetitions, between semicolons."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), ";").alias(name))


def lca_columns(slots: tuple[str, ...] = SLOTS) -> list[Column]:
    """Least and largest usable cell of each slot.

    Negative cells (invalid taxa) are never used; at genus and species neither are
    empty ones.  Rows without lineage are null in every slot and count nowhere.
    """
    out = []
    for s in slots:
        x = F.col(s)
        usable = x > 0 if s in ("genus", "species") else x >= 0
        out += [F.min(F.when(usable, x)).alias(f"lo_{s}"), F.max(F.when(usable, x)).alias(f"hi_{s}")]
    return out


def lca_fold(slots: tuple[str, ...] = SLOTS) -> Column:
    """From the root down: the value that all agree on, until two differ."""
    pairs = F.array(*[F.struct(F.col(f"lo_{s}").alias("lo"), F.col(f"hi_{s}").alias("hi")) for s in slots])
    begin = F.struct(F.lit(ROOT).alias("lca"), F.lit(False).alias("stop"))

    def step(state: Column, x: Column) -> Column:
        stop = F.struct(state["lca"].alias("lca"), F.lit(True).alias("stop"))
        go = F.struct(x["hi"].alias("lca"), F.lit(False).alias("stop"))
        return F.when(state["stop"], state).when(x["lo"] != x["hi"], stop).when(x["hi"] > 0, go).otherwise(state)

    return F.aggregate(pairs, begin, step, lambda s: s["lca"])


def with_cells(rows: DataFrame, lineages: DataFrame, taxon: str = "taxon_id") -> DataFrame:
    """rows with the lineage of their taxon, 28 cells by slot; all null where it has none. Taxa that rows have are looked up, so one that very many rows have is no skew."""
    slots = tuple(c for c in lineages.columns if c != "taxon_id")
    cells = lineages.select(F.col("taxon_id").alias("_t"), *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in slots])
    return join_looked_up(rows, cells, taxon, "_t")


def lca_of(rows: DataFrame, key: str, name: str = "lca", slots: tuple[str, ...] = SLOTS) -> DataFrame:
    """(key, name) of rows with cells: one partial aggregate of 56 integers."""
    return rows.groupBy(key).agg(*lca_columns(slots)).select(key, lca_fold(slots).cast("int").alias(name))


def terms_of(terms: Column) -> Column:
    return F.filter(F.split(F.coalesce(terms, F.lit("")), ";"), lambda x: x != "")


CATEGORIES = ("EC", "GO", "IPR")


def marked(terms: Column) -> tuple[Column, list[Column]]:
    """The terms behind a null that stands for the row itself, and for each category whether the row has one of it."""

    def having(category: str) -> Column:
        return F.exists(terms, lambda x: term_category(x) == category).cast("int").alias(f"_{category}")

    return F.concat(F.array(F.lit(None).cast("string")), terms), [having(c) for c in CATEGORIES]


def term_histogram(rows: DataFrame, key: str, terms: str) -> DataFrame:
    """(key, num_all, num_ec, num_go, num_ipr, data): rows of the key, rows with a term of each category, and the counts by term.

    terms is text between semicolons; a key without any term has no row.  Rows and terms
    are counted in one pass, by (key, term).
    """
    every, has = marked(terms_of(F.col(terms)))
    own = rows.select(key, F.explode(every).alias("_term"), *has)
    counts = own.groupBy(key, "_term").agg(F.count("*").alias("n"), *[F.sum(f"_{c}").alias(f"_{c}") for c in CATEGORIES])
    return counts.groupBy(key).agg(*histogram_columns()).filter(F.size("data") > 0)


def histogram_columns(condition: Column | None = None, tag: str = "") -> list[Column]:
    """Aggregates over rows (_term, n, _EC, _GO, _IPR): the figures of the rows themselves and the list of terms."""
    ok = F.lit(True) if condition is None else condition
    row = ok & F.col("_term").isNull()
    figures = [F.max(F.when(row, F.col(c))).alias(f"{name}{tag}") for c, name in (("n", "num_all"), ("_EC", "num_ec"), ("_GO", "num_go"), ("_IPR", "num_ipr"))]
    term = F.struct(F.col("_term").alias("term"), F.col("n").alias("n"))
    return [*figures, F.array_sort(F.collect_list(F.when(ok & F.col("_term").isNotNull(), term))).alias(f"data{tag}")]


def histogram_text(tag: str = "") -> Column:
    """The histogram as JSON, terms in byte order; null without any term."""
    c = lambda name: F.col(f"{name}{tag}")
    quoted = F.transform(c("data"), lambda x: F.concat(_quoted(x["term"]), F.lit(":"), x["n"].cast("string")))
    parts = F.concat(F.lit('{"num":{"all":'), c("num_all"), F.lit(',"EC":'), c("num_ec"), F.lit(',"GO":'), c("num_go"), F.lit(',"IPR":'), c("num_ipr"), F.lit('},"data":{'), F.array_join(quoted, ","), F.lit("}}"))
    return F.when(F.size(c("data")) > 0, parts)


def _quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def histogram_json(df: DataFrame, key: str, name: str = "fa") -> DataFrame:
    """(key, name): the histogram as JSON."""
    return df.select(key, histogram_text().alias(name))
