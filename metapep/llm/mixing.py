"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 24-bit key from the md5 of its id and text.  Word counts are
summed by source and coarse key bucket (4096 a source, whatever the number of
documents); running sums find the one bucket in which a source's budget runs out,
only that bucket is summed again by the finer half of the key, and the mix is then
a filter on the key: nothing is sorted but histograms.  A smaller budget gives a
smaller threshold, so mixes nest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, join_checked

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
_FINE = 4096


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _key(doc_id: Column, text: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("null"))))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("int")


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """For each row of docs: its `keep` columns, size, source_size, target and taken.

    size is the words of the text (null: 0).  The sources' targets sum to `share`
    times all sizes, by weight; none exceeds `max_repeat` times its source's size,
    what is above goes to the others by weight.  taken is size times the copies:
    target // source_size whole copies of every document and one more of those whose
    key is below the source's threshold.

    Empty and null texts have size 0 and take 0; a very long one counts all its words.  Rows that agree in id and text
    share a key, so they get the extra copy together.  A null source is a source of
    its own, ordered last; a null doc_id is a value like any other.  No rows give no
    rows.  Columns of docs outside `keep` are left out, so their names can't clash.
    """
    if clash := {"size", "source_size", "target", "taken"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    rows = docs.select(*[docs[c].alias(f"k_{c}") for c in keep], docs["source"].alias("m_source"), size_of(docs["text"]).alias("m_size"), _key(docs["doc_id"], docs["text"]).alias("m_key"))
    rows = rows.withColumns({"m_b1": F.floor(F.col("m_key") / _FINE).cast("int"), "m_b2": (F.col("m_key") % _FINE).cast("int")})
    coarse = cut(rows.groupBy("m_source", "m_b1").agg(F.sum("m_size").alias("words")))
    plan = cut(_targets(coarse, weights, share, max_repeat))
    joined = F.col("m_source").eqNullSafe(F.col("p_source"))
    edge = join_checked(coarse, plan, joined, "inner")
    upto = Window.partitionBy("p_source").orderBy("m_b1").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("through", F.sum("words").over(upto)).withColumn("before", F.col("through") - F.col("words"))
    edge = cut(edge.filter("before <= rest and rest < through").select("p_source", "rest", F.col("m_b1").alias("edge"), "before"))
    fine = join_checked(rows, edge, joined & (F.col("m_b1") == F.col("edge")), "inner").groupBy("p_source", "rest", "edge", "before", "m_b2").agg(F.sum("m_size").alias("words"))
    upto = Window.partitionBy("p_source").orderBy("m_b2").rowsBetween(Window.unboundedPreceding, 0)
    fine = fine.withColumn("through", F.col("before") + F.sum("words").over(upto)).filter("2 * through - words <= 2 * rest")
    last = fine.groupBy(F.col("p_source").alias("f_source")).agg(F.max("m_b2").alias("fine"))
    edge = edge.select(F.col("p_source").alias("e_source"), "edge")
    bounds = plan.join(edge, F.col("p_source").eqNullSafe(F.col("e_source")), "left").join(last, F.col("p_source").eqNullSafe(F.col("f_source")), "left")
    bounds = cut(bounds.select("p_source", "source_size", "target", "copies", F.coalesce("edge", F.lit(_FINE)).alias("edge"), F.coalesce("fine", F.lit(-1)).alias("fine")))
    out = join_checked(rows, bounds, joined, "inner")
    extra = (F.col("m_b1") < F.col("edge")) | ((F.col("m_b1") == F.col("edge")) & (F.col("m_b2") <= F.col("fine")))
    # whole copies that use up the budget leave no rest: then only documents without words would have an extra copy
    taken = F.col("m_size") * (F.col("copies") + F.when(extra & (F.col("copies") < max_repeat), 1).otherwise(0))
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], F.col("m_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"))


def _targets(coarse: DataFrame, weights: tuple[int, ...], share: float, max_repeat: int) -> DataFrame:
    """One row a source: p_source, source_size, target, copies (whole ones), rest (words of the target beyond them)."""
    by = coarse.groupBy(F.col("m_source").alias("p_source")).agg(F.sum("words").alias("source_size"))
    order = Window.orderBy(F.col("p_source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long"))
    by = by.withColumns({"cap": max_repeat * F.col("source_size"), "goal": share * F.sum("source_size").over(every)})
    # sources in the order in which a rising level w * x meets their caps
    first = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("p_source").asc_nulls_last())
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    from_here = first.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(from_here)
    by = by.withColumn("capped", level >= F.col("cap") / F.col("w"))
    left = F.col("goal") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    level = F.try_divide(left, F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(every))  # null if all are capped
    by = by.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(F.col("w") * level, F.col("cap").cast("double"))))
    by = by.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    return by.select("p_source", "source_size", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"))
