"""Audit of filters that interact: what each removes, in every order, by multilinear extension.

Every document has a mask of the filters it fails.  The masks' counts of a part of the
corpus are the only thing that is gathered.  The removal polynomial of a part is
multilinear in one variable a filter: at a corner (each variable 0 or 1) its value is
the number of documents that the chosen filters remove together.  Corners give survivors
after any set of filters, hence every step of every order; the integral of a partial
derivative along the diagonal is the filter's Shapley value.  Its terms are fractions
whose denominators divide the factorial of the number of filters, so all is exact in integers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, join_checked, stored

FILTERS = "ABCDE"
#: Bytes of a text whose words are held at once, about.
PIECE = 1 << 20
# Bounds of the filters, and the characters that one of them looks for.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
MARKS = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[ \t-\r]")
_NO_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_INSIDE = bytes(range(0x80, 0xC0))


def words_of(raw: bytes) -> tuple[int, int]:
    """Words, and distinct words, of a text: maximal runs without space and 0x09 to 0x0D; a long text is read in pieces."""
    n, known, at = 0, set(), 0
    while at < len(raw):
        cut_at = _SPACE.search(raw, at + PIECE)
        end = cut_at.start() if cut_at else len(raw)
        own = raw[at:end].split()
        n += len(own)
        known.update(own)
        at = end
    return n, len(known)


def mask_of(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, distinct = words_of(raw)
    chars = len(raw.translate(None, _INSIDE))
    capitals = len(raw.translate(None, _NO_CAPITAL))
    fails = (n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * chars, MARKS.search(raw) is not None)
    return sum(1 << k for k, x in enumerate(fails) if x)


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raws = [x or b"" for x in batch["text"].cast(pa.large_binary()).to_pylist()]
        masks, digests = [mask_of(x) for x in raws], [sha256(x).digest() for x in raws]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, total, good, toxic): rows by part and by the filters they fail.

    Which row of a text comes first is found by one aggregate over digests and one
    join by digest and id, so copies of a text never meet in one task.
    """
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"))
    bounded_batches(own)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = cut(known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    rows = stored(own.mapInArrow(_masked, "doc_id long, part string, mask int, digest binary"), "masks")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null")
    later = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    rows = rows.join(least.withColumn("_first", F.lit(True)), ["digest", "doc_id"], "left")
    rows = rows.select("doc_id", "part", (F.col("mask") + F.when(later, 1 << 4).otherwise(0)).alias("mask"))
    rows = join_checked(rows, known, "doc_id", "left")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", "mask").agg(F.count("*").alias("total"), *sums)


def _subsets(k: int) -> list[list[int]]:
    return [[t for t in range(1 << k) if t & s == t] for s in range(1 << k)]


def removal_polynomial(counts: Column, k: int) -> Column:
    """Coefficients, by the set of variables, of the sum over masks m of counts[m] * (1 - prod over i in m of (1 - x_i)).

    The product's coefficient at a set S within m is (-1)**|S|, so S has minus that times
    the rows whose mask holds S.
    """
    full = (1 << k) - 1

    def coefficient(s: int) -> Column:
        if s == 0:
            return F.lit(0).cast("long")
        holding = sum((F.get(counts, F.lit(m)) for m in range(full + 1) if m & s == s), F.lit(0).cast("long"))
        return holding if s.bit_count() % 2 else -holding

    return F.array(*[coefficient(s) for s in range(full + 1)])


def corners(polynomial: Column, k: int) -> Column:
    """The polynomial at every corner: at the corner of a set, the sum of the coefficients of its subsets."""
    return F.array(*[sum((F.get(polynomial, F.lit(t)) for t in own), F.lit(0).cast("long")) for own in _subsets(k)])


def scaled_shapley(polynomial: Column, k: int) -> Column:
    """k! times the integral from 0 to 1 of each partial derivative at (t, ..., t): a coefficient of a set S gives 1 / |S| of itself to each variable in S."""
    scale = factorial(k)

    def value(i: int) -> Column:
        return sum((F.get(polynomial, F.lit(s)) * F.lit(scale // s.bit_count()) for s in range(1, 1 << k) if s >> i & 1), F.lit(0).cast("long"))

    return F.array(*[value(i) for i in range(k)])


def steps_of(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, its filter's number, the set of those before) of every order of the filters."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            out.append(("".join(filters[j] for j in order), step, i, before))
            before |= 1 << i
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order and step of the filters for each part of mask_counts()."""
    k = len(filters)
    full = (1 << k) - 1

    def by_mask(c: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in range(full + 1)])

    kinds = ("total", "good", "toxic")
    by_part = counts.groupBy("part").agg(*[by_mask(c).alias(c) for c in kinds], F.sum("total").alias("n"))
    polynomials = cut(by_part.select("part", "n", *[removal_polynomial(F.col(c), k).alias(c) for c in kinds]))
    solved = cut(polynomials.select("part", "n", scaled_shapley(F.col("total"), k).alias("shapley"), *[corners(F.col(c), k).alias(c) for c in kinds]))
    orders = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "i", "before"), x)) for x in steps_of(filters)])), "array<struct<filter_order:string,step:int,i:int,before:int>>")
    rows = solved.select("*", F.explode(orders).alias("s"))
    before = F.col("s.before")
    after = before.bitwiseOR(F.expr("shiftleft(1, s.i)"))

    def removed(c: str) -> Column:
        return F.get(F.col(c), after) - F.get(F.col(c), before)

    alone = F.get("total", F.expr("shiftleft(1, s.i)"))
    others = F.lit(full).bitwiseXOR(F.expr("shiftleft(1, s.i)"))
    return rows.select(
        "part",
        "s.filter_order",
        "s.step",
        (F.col("n") - F.get("total", after)).alias("kept"),
        removed("total").alias("removed"),
        (alone - removed("total")).alias("redundant"),
        (F.get("total", F.lit(full)) - F.get("total", others)).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("s.i")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order and step.

    A text fails A with under 100 words, B if under 80 % of its words are distinct, C
    with more than 10 % of the characters in A-Z, D with any of # $ % & * |, and E if a
    row of smaller doc_id has the identical text, anywhere in the table.  Null texts are
    empty ones; a row without id fails E never and makes nobody fail it; rows of one id
    and text don't fail it by each other.  A null part is the empty one.  A row is
    good or toxic if any label of its id says so; labels without id, and other ids'
    labels, count nowhere.  An empty table has no part, so no rows.  Long texts are read
    in pieces; other columns are not read, so their names can't clash.
    """
    return audit(mask_counts(docs, labels, part))
