"""Substring dedup by difference-cover anchors.

A window is 13 consecutive words.  Places modulo 7 in the difference cover {1, 2, 4}
carry anchors, hashes of 7 words; of any two equal windows some anchor lies at the
same distance from both starts, since every difference modulo 7 is one of two cover
elements and 7 + 7 - 1 words hold each of them.  So three of seven places are shuffled.

1. Anchors that two documents share mark both.
2. Documents extend their marked anchors to every window around them; windows are
   compared by 90 bits or more of two independent hashes of their words.
3. A window that a document with a smaller id has too removes its words.

In steps 1 and 2 every task first merges its own entries: of documents that share an
anchor or a window only the one with the least id stands for all in the shuffle,
the others are settled on the spot.  A passage in a third of all documents thus
costs a row a task, not a row a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .blobs import grouped, prime_from, wide
from .common import bounded_batches, partitions

WINDOW = 13
PERIOD = 7
COVER = (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
#: Entries that a task gathers before it merges them: the more, the less is shuffled of what documents share.
FLUSH = 2_000_000
_U16, _U32, _U64 = np.uint16, np.uint32, np.uint64


class _Text:
    """Word hashes of a run of rows, and the rows and places of its words."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.starts, self.ends, self.first = W.spans(raw, off, "space")
        self.raw = raw
        self.h = W.hashes(raw, self.starts, self.ends, False)
        self.row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.place = np.arange(len(self.h)) - self.first[self.row]

    def fits(self, at: np.ndarray, n: int) -> np.ndarray:
        """Whether n words from each place are of one row."""
        return at + n <= self.first[self.row[at] + 1]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors of rows that hold a window, and their hashes."""
        long = (np.diff(self.first) >= WINDOW)[self.row] if len(self.row) else np.zeros(0, bool)
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & long)
        at = at[self.fits(at, ANCHOR)] if len(at) else at
        g = W.grams(self.h, ANCHOR, seed=101)
        return at, g[at]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the windows at the places."""
        second = W.hashes(self.raw, self.starts, self.ends, False, seed=77)
        return W.grams(self.h, WINDOW, seed=211)[at], W.grams(second, WINDOW, seed=307)[at]


def _bits(g: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 40-bit key of an anchor, from different bits of its hash."""
    return (g >> _U64(64 - bits)).astype(np.int64), g & _U64((1 << 40) - 1)


def _first_of(key: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and doc; the least doc of each entry's key; whether the key has more docs than that. All in that order."""
    order = np.lexsort((doc, *reversed(key)))
    change = np.zeros(len(order), bool)
    for k in key:
        k = k[order]
        change[1:] |= k[1:] != k[:-1]
    change[:1] = True
    d = doc[order]
    group = np.cumsum(change) - 1
    least = d[change][group]
    return order, least, np.bincount(group, d != least)[group] > 0


def _send_anchors(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        g, doc = (np.concatenate([x[i] for x in held]) for i in range(2))
        held.clear()
        order, least, shared = _first_of([g], doc)
        g, doc = g[order], doc[order]
        later = doc != least
        for kind, own in ((0, ~later & ~shared), (1, ~later & shared), (2, later)):
            bucket, key = _bits(g[own], bits)
            if kind == 2:  # settled: these need not meet, so they spread
                bucket = doc[own] % (1 << bits)
            yield from grouped(bucket, {"low": key.astype(_U32), "high": (key >> _U64(32)).astype(np.uint8), "doc": doc[own]}, {"kind": kind})

    for batch in batches:
        ids = batch["doc_id"].to_numpy()
        for a, _, raw, off in W.runs(batch["text"]):
            t = _Text(raw, off)
            at, g = t.anchors()
            held.append((g, ids[a + t.row[at]] if len(at) else np.zeros(0, np.int64)))
        if sum(len(x[0]) for x in held) > FLUSH:
            yield from flush()
    yield from flush()


def _mark_anchors(batches: Iterator[pa.RecordBatch], homes: int) -> Iterator[pa.RecordBatch]:
    """Entries of anchors that several documents have, for the homes of the documents."""
    alone: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        for bucket, n, kind, low, high, doc in zip(*(batch[c].to_pylist() for c in ("bucket", "n", "kind", "low", "high", "doc"))):
            low, doc = np.frombuffer(low, _U32), wide(doc, n)
            if kind == 2:
                yield from grouped(doc % homes, {"doc": doc, "key": low})
            else:
                key = low.astype(_U64) | np.frombuffer(high, np.uint8).astype(_U64) << _U64(32) | _U64(bucket) << _U64(40)
                alone.append((key, doc, np.full(n, kind == 1)))
    if not alone:
        return
    key, doc, shared = (np.concatenate([x[i] for x in alone]) for i in range(3))
    alone.clear()
    order, _, several = _first_of([key], doc)
    key, doc, shared = key[order], doc[order], shared[order]
    # an entry that was shared in its own task marks all of its key
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
    hot = several | (np.bincount(group, shared) > 0)[group]
    yield from grouped(doc[hot] % homes, {"doc": doc[hot], "key": key[hot].astype(_U32)})


def _marks(marked: pa.Table, key_type) -> tuple[np.ndarray, np.ndarray]:
    n = marked["n"].to_pylist()
    doc = [wide(x, k) for x, k in zip(marked["doc"].to_pylist(), n)]
    key = [np.frombuffer(x, key_type) for x in marked["key"].to_pylist()]
    return (np.concatenate(doc), np.concatenate(key)) if doc else (np.zeros(0, np.int64), np.zeros(0, key_type))


def _among(doc: np.ndarray, key: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each (doc, key) is one of the marks, whose docs are sorted with their keys."""
    have = W.splitmix(marks[0].astype(_U64)) ^ marks[1].astype(_U64)
    have.sort()
    want = W.splitmix(doc.astype(_U64)) ^ key.astype(_U64)
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return have[at] == want


def _extend(docs: pa.Table, marked: pa.Table) -> pa.Table:
    """The windows around marked anchors of one home: their hashes and documents."""
    names = ["first", "second", "doc"]
    none = pa.table([pa.array([], pa.binary())] * 3, names)
    if not len(docs) or not len(marked):
        return none
    marks = _marks(marked, _U32)
    ids = docs["doc_id"].to_numpy()
    live = np.isin(ids, marks[0])
    docs, ids = docs.filter(pa.array(live)), ids[live]
    out = []
    for a, _, raw, off in W.runs(docs["text"]):
        t = _Text(raw, off)
        at, g = t.anchors()
        if not len(at):
            continue
        at = at[_among(ids[a + t.row[at]], _bits(g, 10)[1].astype(_U32), marks)]
        around = (at[:, None] - np.arange(PERIOD)).ravel()
        around = around[around >= np.repeat(t.first[t.row[at]], PERIOD)]
        around = np.unique(around)
        around = around[t.fits(around, WINDOW)]
        if len(around):
            out.append((*t.windows(around), ids[a + t.row[around]]))
    if not out:
        return none
    w1, w2, doc = (np.concatenate([x[i] for x in out]) for i in range(3))
    return pa.table([pa.array([x.tobytes()], pa.binary()) for x in (w1, w2, doc)], names)


def _send_windows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        w1, w2, doc = (np.concatenate([x[i] for x in held]) for i in range(3))
        held.clear()
        w2 = w2 & _U64((1 << (bits + 16)) - 1)  # the upper of them are the bucket
        order, least, _ = _first_of([w1, w2], doc)
        w1, w2, doc = w1[order], w2[order], doc[order]
        again = np.r_[False, (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1]) & (doc[1:] == doc[:-1])]
        later = doc != least
        for kind, own in ((0, ~later & ~again), (2, later & ~again)):
            bucket = doc[own] % (1 << bits) if kind == 2 else (w2[own] >> _U64(16)).astype(np.int64)
            yield from grouped(bucket, {"first": w1[own], "second": (w2[own] & _U64(0xFFFF)).astype(_U16), "doc": doc[own]}, {"kind": kind})

    for batch in batches:
        for x in zip(*(batch[c].to_pylist() for c in ("first", "second", "doc"))):
            held.append((np.frombuffer(x[0], _U64), np.frombuffer(x[1], _U64), np.frombuffer(x[2], np.int64)))
        if sum(len(x[0]) for x in held) > FLUSH:
            yield from flush()
    yield from flush()


def _mark_windows(batches: Iterator[pa.RecordBatch], homes: int) -> Iterator[pa.RecordBatch]:
    """Windows that a document with a smaller id has, for the homes of the others."""
    alone: list[tuple] = []
    for batch in batches:
        for bucket, n, kind, first, second, doc in zip(*(batch[c].to_pylist() for c in ("bucket", "n", "kind", "first", "second", "doc"))):
            first, doc = np.frombuffer(first, _U64), wide(doc, n)
            if kind == 2:
                yield from grouped(doc % homes, {"doc": doc, "key": first})
            else:
                alone.append((np.full(n, bucket, _U32), first, np.frombuffer(second, _U16), doc))
    if not alone:
        return
    bucket, first, second, doc = (np.concatenate([x[i] for x in alone]) for i in range(4))
    alone.clear()
    order, least, _ = _first_of([bucket, first, second], doc)
    later = order[doc[order] != least]
    yield from grouped(doc[later] % homes, {"doc": doc[later], "key": first[later]})


def _strip(docs: pa.Table, marked: pa.Table, keep: list[str]) -> pa.Table:
    """Documents of one home without the words of marked windows."""
    marks = _marks(marked, _U64) if len(marked) else None
    ids = docs["doc_id"].to_numpy(zero_copy_only=False) if len(docs) else np.zeros(0)
    hit = np.isin(ids, marks[0]) if marks else np.zeros(len(docs), bool)
    n_words, n_removed, kept = [], [], []
    for a, b, raw, off in W.runs(docs["text"]) if len(docs) else ():
        starts, ends, first = W.spans(raw, off, "space")
        gone = np.zeros(len(starts) + WINDOW, bool)
        if hit[a:b].any():
            t = _Text(raw, off)
            at = np.flatnonzero(hit[a:b][t.row])
            at = at[t.fits(at, WINDOW)]
            if len(at):
                w1, _ = t.windows(at)
                at = at[_among(ids[a + t.row[at]].astype(np.int64), w1, marks)]
                for k in range(WINDOW):
                    gone[at + k] = True
        n_words += np.diff(first).tolist()
        data = raw.tobytes()
        for r in range(b - a):
            i, j = int(first[r]), int(first[r + 1])
            out = gone[i:j]
            n_removed.append(int(out.sum()))
            if not n_removed[-1]:
                kept.append(b" ".join(data[off[r] : off[r + 1]].split()).decode())
            else:
                left = np.flatnonzero(~out) + i
                kept.append(b" ".join([data[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist())]).decode())
    return pa.table([*(docs[c] for c in keep), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], [*keep, "n_words", "n_removed", "kept"])


def dedup_substrings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), homes: int | None = None, digest: bool = False) -> DataFrame:
    """For each row of docs: its `keep` columns, n_words, n_removed and kept (the words that stay, joined by a blank; with `digest` their sha256 in hex).

    Removed is every word covered by a window that also starts in a document with a
    smaller doc_id; windows are judged on the input.  Null and empty texts have no
    words; texts under 13 words lose none; a very long text is read whole.  Rows without doc_id have no order: they are
    kept whole and remove nothing.  Rows that repeat an id do not remove each other's
    words.  No rows give no rows.  Other columns are left out, so their names can't
    clash.
    """
    if clash := {"n_words", "n_removed", "kept", "home"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(docs)
    parts = partitions(docs)
    homes = homes or prime_from(max(1021, 8 * parts))
    bits = min(24, max(10, (4 * parts).bit_length()))
    names = [*dict.fromkeys(["doc_id", *keep])]
    home = F.coalesce(F.pmod(docs["doc_id"].cast("long"), F.lit(homes)), F.pmod(F.hash("text"), F.lit(homes)).cast("long")).cast("int")
    homed = docs.select(*[docs[c] for c in names if c != "doc_id"], docs["doc_id"].cast("long").alias("doc_id"), *([] if "text" in names else ["text"]), home.alias("home"))
    anchors = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    anchors = anchors.mapInArrow(lambda it: _send_anchors(it, bits), "bucket int, n int, kind int, low binary, high binary, doc binary")
    marked = anchors.repartition(parts, "bucket").mapInArrow(lambda it: _mark_anchors(it, homes), "bucket int, n int, doc binary, key binary")
    windows = homed.groupBy("home").cogroup(marked.groupBy("bucket")).applyInArrow(lambda d, m: _extend(d, m), "first binary, second binary, doc binary")
    windows = windows.mapInArrow(lambda it: _send_windows(it, bits), "bucket int, n int, kind int, first binary, second binary, doc binary")
    gone = windows.repartition(parts, "bucket").mapInArrow(lambda it: _mark_windows(it, homes), "bucket int, n int, doc binary, key binary")
    own = list(keep)

    def strip(d: pa.Table, m: pa.Table) -> pa.Table:
        out = _strip(d, m, own)
        if digest:
            sha = [hashlib.sha256(x.as_py().encode()).hexdigest() for x in out["kept"]]
            out = out.set_column(out.num_columns - 1, "kept", pa.array(sha, pa.string()))
        return out

    schema = ", ".join(f"`{c}` {homed.schema[c].dataType.simpleString()}" for c in keep) + ", n_words long, n_removed long, kept string"
    return homed.groupBy("home").cogroup(gone.groupBy("bucket")).applyInArrow(strip, schema)
