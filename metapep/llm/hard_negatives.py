"""Hard-negative mining by ball trees.

Rows lie in parts of bounded size; each part has a ball tree, whose nodes bound the inner
product with an anchor from above and below by the centre's product and the radius.
Anchors come in blocks of bounded size.  A node is left out if its bounds lie outside the
score window, or if its upper bound is strictly beneath the anchor's current k-th best;
a task carries the best of one tree on to the next.  Leaves are scored exactly, so the
search is exact.  First the positives of a block are found (same label, no window), then
their negatives (other label, window of each positive).  Rows are never shuffled by label
or id, so a label or vector that a third of all rows share is no skew.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import cut, stored

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of its positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Rows of a tree and of a leaf; most anchors of a block, and most bytes of their vectors.
PART, LEAF = 8192, 64
BLOCK, BLOCK_BYTES = 2048, 16 << 20
#: Numbers up to this size are exact in double precision.
EXACT = 1 << 53
MOST = (1 << 63) - 1


def usable(vectors: DataFrame, column: str = "embedding", every: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, v) of rows with an id, a label and a vector without null or non-finite components; where vec_id is divisible by `every` the label is the next one."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(column).cast("array<double>").alias("v"))
    rows = rows.filter("vec_id is not null and label is not null and v is not null").filter(fine)
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in double precision where that holds them, else in Python's integers, up to 64 bits."""
    bound = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if bound < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(x).T, -MOST, MOST).astype(np.int64)


class BallTree:
    """Nodes of at most LEAF rows below, halved along the line between two far rows; rows stand in the order of the leaves."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.x = x
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.below: list[tuple[int, int] | None] = []
        if len(x):
            self._grow(0, len(x))

    def _grow(self, a: int, b: int) -> int:
        own = self.x[self.order[a:b]]
        centre = own.mean(0)
        away = own - centre
        far = np.sqrt((away * away).sum(1))
        me = len(self.radius)
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.range.append((a, b))
        self.below.append(None)
        if b - a > LEAF:
            one = own[far.argmax()]
            gap = own - one
            other = own[(gap * gap).sum(1).argmax()]
            along = own @ (other - one)
            half = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(along, half)]
            self.below[me] = (self._grow(a, a + half), self._grow(a + half, b))
        return me

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, node): least and largest inner product that a row of the node can have, with room for rounding; infinite where numbers are too large to tell."""
        with np.errstate(over="ignore", invalid="ignore"):
            c, r = np.array(self.centre), np.array(self.radius)
            at = q @ c.T
            length = np.sqrt((q * q).sum(1))[:, None]
            wide = length * r[None]
            room = 1e-9 * (length * np.sqrt((c * c).sum(1))[None] + wide) + 1.0
            low, high = at - wide - room, at + wide + room
        return np.nan_to_num(low, nan=-np.inf, neginf=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf)


class Best:
    """The first k rows of each search by (larger score, smaller id), with a k-th score that only rises."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -MOST - 1, np.int64)
        self.id = np.full((n, k), MOST, np.int64)
        self.full = np.zeros((n, k), bool)

    def least(self, at: np.ndarray) -> np.ndarray:
        """The current k-th score, or minus infinity while there are fewer."""
        return np.where(self.full[at, -1], self.score[at, -1].astype(float), -np.inf)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """Candidates of the searches at: scores (search, row), ids by row, and which count."""
        ok = ok & (~self.full[at, -1][:, None] | (score >= self.score[at, -1][:, None]))
        some = ok.any(1)
        if not some.any():
            return
        at, score, ok = at[some], score[some], ok[some]
        s = np.concatenate([self.score[at], np.where(ok, score, -MOST - 1)], 1)
        i = np.concatenate([self.id[at], np.where(ok, ids[None], MOST)], 1)
        f = np.concatenate([self.full[at], ok], 1)
        # what is no candidate comes last; ~s turns the order of scores round without overflow
        order = np.lexsort((i, ~s, ~f), axis=1)[:, : self.k]
        self.score[at], self.id[at], self.full[at] = (np.take_along_axis(x, order, 1) for x in (s, i, f))


def search(tree: BallTree, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, own_id: np.ndarray, own_label: np.ndarray, asks: np.ndarray, low: np.ndarray, high: np.ndarray, best: Best, same: bool) -> None:
    """Takes the tree's rows into best: search j asks for anchor asks[j], for scores from low[j] to high[j], of its own label or of others."""
    if not len(ids) or not len(asks):
        return
    least, most = tree.bounds(q)
    least, most = least[asks], most[asks]
    open_ = [(0, np.arange(len(asks)))]
    while open_:
        node, at = open_.pop()
        # outside the window, or strictly beneath the current k-th
        at = at[(most[at, node] >= low[at]) & (least[at, node] <= high[at]) & (most[at, node] >= best.least(at))]
        if not len(at):
            continue
        if tree.below[node] is not None:
            # the half that promises more is looked at first
            open_ += [(x, at) for x in sorted(tree.below[node], key=lambda x: most[at, x].mean())]
            continue
        a, b = tree.range[node]
        rows = tree.order[a:b]
        anchors, place = np.unique(asks[at], return_inverse=True)
        score = products(q[anchors], tree.x[rows])[place]
        agree = own_label[asks[at]][:, None] == labels[rows][None]
        ok = agree & (own_id[asks[at]][:, None] != ids[rows][None]) if same else ~agree
        ok &= (score >= low[at][:, None]) & (score <= high[at][:, None])
        best.add(at, score, ids[rows], ok)


def _mined(batches: Iterator[pa.RecordBatch], d: int, q: np.ndarray, own_id: np.ndarray, own_label: np.ndarray, asks: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """(ask, id, score): the best of a task's rows for each search; trees of PART rows one after another."""
    best = Best(len(asks), k)

    def take(held: list[pa.RecordBatch]) -> None:
        t = pa.Table.from_batches(held)
        search(BallTree(_matrix(t["v"], d)), t["vec_id"].to_numpy(), t["label"].to_numpy(), q, own_id, own_label, asks, low, high, best, same)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for a in range(0, batch.num_rows, PART):
            held.append(batch.slice(a, PART))
            if sum(x.num_rows for x in held) >= PART:
                take(held)
                held = []
    if held:
        take(held)
    ask, place = np.nonzero(best.full)
    yield pa.RecordBatch.from_arrays([pa.array(ask.astype(np.int32)), pa.array(best.id[ask, place]), pa.array(best.score[ask, place])], ["ask", "id", "score"])


def _first(found: DataFrame, k: int) -> DataFrame:
    """(ask, rank, id, score): the first k of each search over all tasks."""
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("ask", "rank", "id", "score")


def mine(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, column: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by anchor_every.  Positives are the
    first rows of the anchor's label and another id, negatives of a positive the first
    rows of other labels whose score is from low to high per cent of the positive's;
    first are higher scores, then smaller ids.  A pair without negatives has no row.

    Rows with a null id, label, vector or component, a non-finite component, or another
    dimension than most rows (the smaller one of two equally frequent) take no part; zero
    vectors do.  A row that repeats another is a candidate of its own; anchors that
    agree in id, label and vector are one.  Scores are exact; beyond 64 bits they are
    the largest or least number.  No rows, or no anchors, give no rows; extra columns
    are not read.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(vectors, column)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    d, n = sizes.d, sizes.n
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(n / PART))
    rows = cut(rows.filter(F.size("v") == d).repartition(parts))
    block = max(1, min(block, BLOCK_BYTES // (8 * max(1, d))))
    anchors = number_rows(rows.filter(F.col("vec_id") % anchor_every == 0).distinct(), ["vec_id", "label", "v"], "a", 0)
    anchors = cut(anchors)
    n_anchors = anchors.count()
    out = None
    for a in range(0, n_anchors, block):
        own = anchors.filter((F.col("a") >= a) & (F.col("a") < a + block)).orderBy("a").toArrow()  # of bounded size
        made = stored(_mined_block(rows, own, d, positives, negatives, low, high), "negatives")
        out = made if out is None else out.union(made)
    return out if out is not None else spark.createDataFrame([], schema)


def _mined_block(rows: DataFrame, own: pa.Table, d: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """mine() for the anchors of a block; what comes to the driver is bounded by its size."""
    q, own_id, own_label = _matrix(own["v"], d), own["vec_id"].to_numpy(), own["label"].to_numpy()
    kinds = "ask int, id long, score long"
    every = np.arange(len(own_id))
    none = np.full(len(own_id), -np.inf)
    found = rows.mapInArrow(lambda it: _mined(it, d, q, own_id, own_label, every, none, -none, positives, True), kinds)
    t = _first(found, positives).orderBy("ask", "rank").toArrow()
    asks, positive, score = t["ask"].to_numpy(), t["id"].to_numpy(), t["score"].to_numpy()
    whole = [int(s) for s in score]
    least = np.array([ceil_div(low * s, 100) for s in whole], np.int64)
    most = np.array([high * s // 100 for s in whole], np.int64)
    found = rows.mapInArrow(lambda it: _mined(it, d, q, own_id, own_label, asks, least, most, negatives, False), kinds)
    pairs = pa.table({"ask": pa.array(np.arange(len(asks), dtype=np.int32)), "anchor_id": pa.array(own_id[asks]), "positive_id": pa.array(positive), "positive_score": pa.array(score)})
    pairs = rows.sparkSession.createDataFrame(pairs)
    return _first(found, negatives).join(F.broadcast(pairs), "ask").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)
