"""Approximate nearest neighbours by adaptive dimension scan.

Vectors of length one are turned by a random rotation, so that any leading columns of
a difference estimate its whole length.  Rows are listed by their nearest centre (half the
square root of all rows as centres, from a bounded sample); a query probes its nearest
lists, as many as brute force within the sample shows to be needed.  Rows of a list come
in turn, some hundred at once, and their columns in blocks: after every block a
hypothesis test drops the candidates whose partial distance is too large for the
present k-th best, allowing for the error of the estimate; what remains is scored
exactly, in double precision, on the original vectors, and lowers the k-th best for
the rows that follow.  Queries that found fewer than k in their lists search them all.

A row is sent to its list once for every some thousand queries that probe it, and a
query to each list it probes once for every 262,144 rows there: a task holds the queries
and streams the rows.  Of equal vectors in a batch only those go on that can be among the
k nearest, which are those of the smallest ids, so a vector that a third of all rows
share is a few rows a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, partitions

K = 5
QUERY_EVERY = 50
#: Part of the true neighbours, within the sample, that the probed lists must hold.
COVERAGE = 0.97
#: Most rows that centres are fitted on.
SAMPLE_ROWS = 20_000
#: Rows of a part of a list, and bytes of the queries that a task holds.
PART, ASK_BYTES = 1 << 18, 8 << 20
COLUMNS = 16
#: Width of the test in standard deviations of the estimate, about.
WIDTH = 2.1
#: Rows that are looked at in turn; the first ones are scored without a test.
SEEDS, TURN = 48, 512


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with an id and a vector that is not null, empty, zero or holding null or non-finite components."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null").filter(fine)


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither over- nor underflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Of spherical k-means, from k rows of the sample."""
    x = _unit(sample).astype(np.float32)
    c = x[np.random.default_rng(3).permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.concatenate([(x[a : a + 4096] @ c.T).argmax(1) for a in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-9), c)
    return c


def probes_for(sample: np.ndarray, c: np.ndarray, k: int, coverage: float, tests: int = 256) -> int:
    """The fewest lists to probe so that they hold `coverage` of the k nearest of some sample rows, found by brute force in the sample."""
    x = _unit(sample).astype(np.float32)
    own = np.concatenate([(x[a : a + 4096] @ c.T).argmax(1) for a in range(0, len(x), 4096)])
    q = x[np.random.default_rng(9).permutation(len(x))[:tests]]
    near = np.argsort(-(q @ x.T), axis=1)[:, 1 : k + 1]  # the first is the row itself
    place = np.argsort(np.argsort(-(q @ c.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, ceil(coverage * len(needed)))]) + 1 if len(needed) else len(c)


def few_of_equal(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k nearest of any query: of equal vectors k rows of each of the k + 1 smallest ids, of which one can be the query's own."""
    bits = (x + 0.0).view(np.uint64)  # no negative zero
    key = (bits * np.random.default_rng(5).integers(1, 1 << 63, x.shape[1], np.uint64)).sum(1, dtype=np.uint64)
    if len(np.unique(key)) == len(x):
        return np.arange(len(x))
    kind = np.unique(np.ascontiguousarray(bits).view(np.dtype((np.void, 8 * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((ids, kind))
    place = np.arange(len(x))
    new = np.r_[True, np.diff(kind[order]) != 0]
    new_id = new | np.r_[True, np.diff(ids[order]) != 0]
    ids_before = np.cumsum(new_id)
    rank = ids_before - ids_before[np.maximum.accumulate(np.where(new, place, 0))]
    copy = place - np.maximum.accumulate(np.where(new_id, place, 0))
    return np.sort(order[(rank <= k) & (copy < k)])


def _near(x: np.ndarray, c: np.ndarray, probes: int) -> np.ndarray:
    x = _unit(x).astype(np.float32)
    return np.argpartition(-(x @ c.T), probes - 1, axis=1)[:, :probes] if probes < len(c) else np.tile(np.arange(len(c)), (len(x), 1))


def _counted(batches: Iterator[pa.RecordBatch], c: np.ndarray, probes: int, k: int) -> Iterator[pa.RecordBatch]:
    """(list, n): how often the lists are named, by batch; rows of equal vectors as few_of_equal() leaves them if one list is named a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch["v"])
        if probes == 1:
            x = x[few_of_equal(x, batch["vec_id"].to_numpy(), k)]
        lists, n = np.unique(_near(x, c, probes), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), pa.array(n.astype(np.int64))], ["list", "n"])


def _scattered(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(7)) % parts.astype(np.uint64)


def _sent(batches: Iterator[pa.RecordBatch], c: np.ndarray, probes: int, own_parts: np.ndarray, other_parts: np.ndarray, asks: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Rows of each list they name, or queries of each they probe: in one of own_parts, once for every one of other_parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if not asks:
            batch = batch.take(pa.array(few_of_equal(_matrix(batch["v"]), batch["vec_id"].to_numpy(), k)))
        lists = _near(_matrix(batch["v"]), c, probes)
        row, lists = np.repeat(np.arange(len(lists)), lists.shape[1]), lists.ravel()
        copies = np.where(own_parts[lists] > 0, other_parts[lists], 0)
        own = _scattered(batch["vec_id"].to_numpy()[row], np.maximum(own_parts[lists], 1))
        at = np.repeat(np.arange(len(row)), copies)
        other = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
        for a in range(0, len(at), 4096):
            here, there = at[a : a + 4096], other[a : a + 4096]
            part, ask = (there, own[here]) if asks else (own[here], there)
            cells = [pa.array(v.astype(np.int32)) for v in (lists[here], part, ask, np.full(len(here), not asks))]
            rows = pa.array(row[here])
            yield pa.RecordBatch.from_arrays([*cells, batch["vec_id"].take(rows), batch["v"].take(rows)], ["list", "part", "ask", "kind", "vec_id", "v"])


class Search:
    """The k nearest of some queries among rows that come in turn, with early abandonment."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int):
        self.queries, self.ids, self.turn, self.k = queries, ids, turn, k
        self.turned, self.length = _unit(queries) @ turn, np.sqrt((queries * queries).sum(1))
        self.best = [(ids[:0], self.length[:0])] * len(ids)

    def look(self, rows: np.ndarray, ids: np.ndarray) -> None:
        d, k = rows.shape[1], self.k
        x, length = _unit(rows) @ self.turn, np.sqrt((rows * rows).sum(1))
        for j, q in enumerate(self.turned):
            other = np.flatnonzero(ids != self.ids[j])
            known, score = self.best[j]
            at = 0
            while at < len(other):
                far = 2 - 2 * score[-1] if len(known) == k else np.inf
                rest = other[at : at + (TURN if len(known) == k else SEEDS)]
                at += len(rest)
                partial = np.zeros(len(rest))
                for a in range(0, d, COLUMNS):
                    b = min(d, a + COLUMNS)
                    partial += ((x[rest, a:b] - q[a:b]) ** 2).sum(1)
                    if far < np.inf:
                        stay = partial * (d / b) <= far * (1 + WIDTH / sqrt(b)) ** 2 + 1e-12 if b < d else partial <= far + 1e-9
                        rest, partial = rest[stay], partial[stay]
                        if not len(rest):
                            break
                if len(rest):
                    known = np.r_[known, ids[rest]]
                    score = np.r_[score, (rows[rest] * self.queries[j]).sum(1) / (length[rest] * self.length[j])]
                    first = np.lexsort((known, -score))[:k]
                    known, score = known[first], score[first]
            self.best[j] = known, score

    def found(self) -> pa.RecordBatch:
        n = [len(known) for known, _ in self.best]
        cells = [np.repeat(self.ids, n), *(np.concatenate([b[i] for b in self.best]) for i in range(2))]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in cells], ["query_id", "vec_id", "score"])


def _searched(batches: Iterator[pa.RecordBatch], turn: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Of sorted batches, queries of a part before its rows: what was found for each query in the part."""
    key, queries, search = None, [], None
    for batch in batches:
        cells = np.stack([batch[name].to_numpy() for name in ("list", "part", "ask", "kind")], 1)
        ends = np.flatnonzero(np.r_[np.any(cells[1:] != cells[:-1], axis=1), True]) + 1 if len(cells) else []
        for begin, end in zip([0, *ends], ends):
            own, ids, v = tuple(cells[begin, :3]), batch["vec_id"].to_numpy()[begin:end], _matrix(batch["v"].slice(begin, end - begin))
            if own != key:
                if search:
                    yield search.found()
                key, queries, search = own, [], None
            if not cells[begin, 3]:
                queries.append((v, ids))
            elif queries:
                search = search or Search(*(np.concatenate(x) for x in zip(*queries)), turn, k)
                for a in range(0, len(ids), 2048):
                    search.look(v[a : a + 2048], ids[a : a + 2048])
    if search:
        yield search.found()


def nearest(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, coverage: float = COVERAGE, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, by cosine, of every row whose vec_id is divisible by query_every.

    Ties go to the smaller vec_id.  Rows with a null id, or a vector that is null,
    empty, zero, of another dimension than most, or holding null or non-finite
    components, take no part.  A row is never its own neighbour; rows that repeat an id
    are candidates each, and none for a query of that id, which asks with the least of its
    vectors.  Fewer candidates give fewer
    ranks; an empty table gives no rows.  Extra columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(vectors)
    rows = usable(vectors, column)
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    d, n = dims.d, dims.n
    rows = rows.filter(F.size("v") == d)
    rate = min(1.0, SAMPLE_ROWS / n)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < max(1, int(rate * (1 << 20)))).toArrow() if n > 1 else rows.toArrow()
    sample = sample.slice(0, 2 * SAMPLE_ROWS)
    sample = sample if len(sample) else rows.limit(1).toArrow()
    k_lists = max(1, min(round(sqrt(n) / 2), len(sample)))  # the sample bounds them
    known = _matrix(sample["v"])
    c = centres(known, k_lists)
    turn = rotation(d)
    probes = probes_for(known, c, k, coverage)
    asking = rows.filter(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_tasks = partitions(vectors)

    def parts(named: DataFrame, lists: int, size: int) -> np.ndarray:
        """Parts of each list, of about so many rows; a number a list comes to the driver."""
        own = np.zeros(k_lists, np.int64)
        for r in named.mapInArrow(lambda it: _counted(it, c, lists, k), "list int, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
            own[r.list] = -(-r.n // size)
        return own

    row_parts = parts(rows, 1, PART)

    def searched(queries: DataFrame, lists: int) -> DataFrame:
        """(query_id, best) of so many lists for each query."""
        ask_parts = parts(queries, lists, max(256, ASK_BYTES // (8 * d)))
        kinds = "list int, part int, ask int, kind int, vec_id long, v array<double>"
        asked = queries.mapInArrow(lambda it: _sent(it, c, lists, ask_parts, row_parts, True, k), kinds)
        there = rows.mapInArrow(lambda it: _sent(it, c, 1, row_parts, ask_parts, False, k), kinds)
        keys = ("list", "part", "ask")
        together = asked.union(there).repartition(n_tasks, *keys).sortWithinPartitions(*keys, "kind")
        near = together.mapInArrow(lambda it: _searched(it, turn, k), "query_id long, vec_id long, score double")
        best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k)
        return near.groupBy("query_id").agg(best.alias("best"))

    top = cut(searched(asking, probes))
    if probes < k_lists:
        full = top.filter(F.size("best") == k).select(F.col("query_id").alias("vec_id"))
        short = cut(asking.join(full, "vec_id", "left_anti"))
        if not short.isEmpty():
            again = searched(short, k_lists)
            top = top.filter(F.size("best") == k).union(again)
    return top.select("query_id", F.posexplode("best").alias("r", "b")).select("query_id", (F.col("r") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
