"""Benchmark decontamination: prefix-filtered join of documents with benchmark windows.

A window is a run of `window` consecutive item words (a shorter item is one window).
It is the set of its word shingles with their places.  Containment is 1, so by the
prefix principle one shingle of a window suffices to find it: the rarest, counted
over all documents.  Documents are joined on that shingle; its place must leave room
for the whole window inside the document (positional and length bounds); then the
words themselves are compared.

A benchmark of at most `block` (window, item) pairs goes to the executors, and no
document is shuffled.  A larger one stays a table: its shingles are counted in one scan
of the documents, and in another the occurrences of each window's rarest shingle, with
the words around them, are shuffled to the windows that it stands for.  What is sent
then is a Bloom filter of bounded size, which only saves shuffling; the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import join_checked, stored
from . import words as W
from .common import bounded_batches

WINDOW = 10
SHINGLE = 3
#: Most (window, item) pairs that are sent to the executors, and most bytes of them; about 50 MB as an index.
BLOCK = 200_000
BLOCK_BYTES = 32 << 20
#: Most bits of a filter, 32 MB.
FILTER_BITS = 1 << 28
_FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>"


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item, words): the windows of each item, their words joined by a blank."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    found = F.regexp_extract_all(F.translate("text", upper, lower), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    items = benchmark.filter("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), found.alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return items.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("words")).distinct()


def _shingles(words: list[bytes], n: int) -> np.ndarray:
    raw = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = W.spans(raw, np.array([0, len(raw)]), "alnum")
    return W.grams(W.hashes(raw, starts, ends, True), min(n, len(words)))


class _Index:
    """Windows of one block; by shingle length the rarest shingles, sorted, and which windows they stand for at which offset."""

    def __init__(self, pairs: list[tuple[str, str]], shingle: int):
        self.texts = sorted({w for _, w in pairs})
        number = {w: k for k, w in enumerate(self.texts)}
        self.items: list[list[str]] = [[] for _ in self.texts]
        for item, w in pairs:
            self.items[number[w]].append(item)
        self.windows = [w.encode().split(b" ") for w in self.texts]
        self.grams = [_shingles(w, shingle) for w in self.windows]
        self.length = np.array([min(shingle, len(w)) for w in self.windows], np.int64)

    def all_shingles(self) -> dict[int, np.ndarray]:
        return {int(n): np.unique(np.concatenate([g for g, k in zip(self.grams, self.length) if k == n])) for n in np.unique(self.length)}

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep of each window the shingle with the least count (then the least hash)."""
        rare: dict[int, list[tuple[int, int, int]]] = {}
        for k, (g, n) in enumerate(zip(self.grams, self.length)):
            at = min(range(len(g)), key=lambda i: (counts.get((int(n), int(g[i])), 0), int(g[i])))
            rare.setdefault(int(n), []).append((int(g[at]), k, at))
        del self.grams, self.texts
        self.rare = {}
        for n, found in rare.items():
            found.sort()
            h = np.array([x[0] for x in found], np.uint64)
            keys, first = np.unique(h, return_index=True)
            self.rare[n] = (keys, np.r_[first, len(h)], np.array([x[1] for x in found]), np.array([x[2] for x in found]), W.Sieve(keys))


def _find(batches: Iterator[pa.RecordBatch], index: _Index, keep: list[str]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    for batch in batches:
        n_words, n_hit, items, hits = [], [], [], []
        for a, b, raw, off in W.runs(batch["text"]):
            starts, ends, first = W.spans(raw, off, "alnum")
            h = W.hashes(raw, starts, ends, True)
            found: dict[int, list[tuple[int, int]]] = {}
            for n, (_, begin, window, offset, sieve) in index.rare.items():
                for at, k in zip(*sieve.find(W.grams(h, n))):
                    row = int(np.searchsorted(first, at, "right")) - 1
                    for j in range(begin[k], begin[k + 1]):
                        w = index.windows[window[j]]
                        s = int(at - offset[j])
                        if first[row] <= s and s + len(w) <= first[row + 1] and all(W.fold_bytes(raw[starts[s + i] : ends[s + i]]).tobytes() == x for i, x in enumerate(w)):
                            found.setdefault(row, []).append((s - int(first[row]), int(window[j])))
            for row in range(b - a):
                n_words.append(int(first[row + 1] - first[row]))
                if row not in found:
                    n_hit.append(0)
                    items.append([])
                    hits.append([])
                    continue
                hit = np.zeros(n_words[-1] + 2, np.int8)
                for s, w in found[row]:
                    hit[s + 1 : s + 1 + len(index.windows[w])] = 1
                n_hit.append(int(hit.sum()))
                items.append(sorted({i for w in {w for _, w in found[row]} for i in index.items[w]}))
                edge = np.diff(hit)
                hits.append([{"first": int(p), "last": int(q) - 1} for p, q in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(hits, pa.list_(kind))], [*keep, "n_words", "n_hit", "items", "spans"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """For each row of docs: its `keep` columns, n_words, n_hit, items (ids, sorted as strings) and spans (runs of hit words, places from 0).

    A word is hit if it lies in an occurrence of a window.  Null and empty texts and
    items have no words: such documents have no hit, such items no window.  A null
    item id is the string null.  Repeated rows each have their result; repeated items
    count once by id.  A very long text is searched whole.  Without items nothing is
    hit; without documents there is no row.  Other columns of docs are left out, so
    their names can't clash.  Above `block` windows intermediate tables are written to
    the shared folder, which the result still reads.
    """
    if clash := {"n_words", "n_hit", "items", "spans", "_digest", "_h", "_maybe"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(docs)
    windows = item_windows(benchmark, window)
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words") + F.octet_length("item")), F.lit(0))).first()
    if n <= block and size <= BLOCK_BYTES:
        return _with_block(docs, windows.collect(), keep, shingle)
    return _by_shuffle(docs, stored(windows, "windows"), keep, window, shingle)


def _with_block(docs: DataFrame, pairs: list, keep: tuple[str, ...], shingle: int) -> DataFrame:
    index = _Index([tuple(p) for p in pairs], shingle)
    wanted = index.all_shingles()
    counts = docs.select("text").mapInArrow(lambda it: W.count_grams(it, wanted), "n int, h long, c long").groupBy("n", "h").agg(F.sum("c").alias("c"))
    index.order({(r.n, r.h & 0xFFFFFFFFFFFFFFFF): r.c for r in counts.collect()} if pairs else {})
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", " + _FOUND
    names = list(keep)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lambda it: _find(it, sent.value, names), schema)


class _Filter:
    """A Bloom filter of 64-bit hashes: three bits a hash, from its low, middle and high part."""

    SHIFTS = (0, 17, 34)

    def __init__(self, hashes: DataFrame, column: str):
        self.bits = 1 << max(15, min(FILTER_BITS.bit_length() - 1, (32 * hashes.count()).bit_length()))
        places = F.array(*[F.shiftrightunsigned(column, k).bitwiseAND(F.lit(self.bits - 1)) + 1 for k in self.SHIFTS])
        pages = hashes.select(F.explode(places).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        self.data = np.zeros(self.bits >> 3, np.uint8)
        for r in pages.toLocalIterator():
            self.data[(r.page - 1) * len(r.bits) : r.page * len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of h that may be members; all that are."""
        at = np.arange(len(h))
        for k in self.SHIFTS:
            p = (h[at] >> np.uint64(k)) & np.uint64(self.bits - 1)
            at = at[(self.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return at


def _window_shingles(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The shingles of each window: words, len, n, h, offset."""
    for batch in batches:
        for a, b, raw, off in W.runs(batch["words"]):
            starts, ends, first = W.spans(raw, off, "alnum")
            h = W.hashes(raw, starts, ends, True)
            length = np.diff(first)
            for n in np.unique(np.minimum(length, shingle)):
                rows = np.flatnonzero(np.minimum(length, shingle) == n)
                many = length[rows] - n + 1
                row = np.repeat(rows, many)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                g = W.grams(h, int(n))[first[row] + offset]
                columns = [batch["words"].slice(a, b - a).take(pa.array(row)), pa.array(length[row].astype(np.int32)), pa.array(np.full(len(row), n, np.int32)), pa.array(g.view(np.int64)), pa.array(offset.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["words", "len", "n", "h", "offset"])


def _count_members(batches: Iterator[pa.RecordBatch], members: _Filter, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """Counts of the shingles that pass the filter, merged by runs of texts: n, h, c."""
    for batch in batches:
        for _, _, raw, off in W.runs(batch["text"]):
            starts, ends, first = W.spans(raw, off, "alnum")
            words = W.hashes(raw, starts, ends, True)
            for n in lengths:
                g = W.grams(words, n)
                at = members.find(g)
                h, c = np.unique(g[at[at + n <= first[np.searchsorted(first, at, "right")]]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), n, np.int32)), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["n", "h", "c"])


def _occurrences(batches: Iterator[pa.RecordBatch], members: _Filter, lengths: list[int], window: int, chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Places of the shingles that pass the filter, with the words that a window around them can hold: digest, n, h, place, at (in these words), near."""
    for batch in batches:
        for a, _, raw, off in W.runs(batch["text"]):
            starts, ends, first = W.spans(raw, off, "alnum")
            words, low = W.hashes(raw, starts, ends, True), W.fold_bytes(raw)
            for n in lengths:
                g = W.grams(words, n)
                found = members.find(g)
                rows = np.searchsorted(first, found, "right") - 1
                whole = found + n <= first[rows + 1]
                found, rows = found[whole], rows[whole]
                for i in range(0, len(found), chunk):
                    at, row = found[i : i + chunk], rows[i : i + chunk]
                    begin, end = np.maximum(first[row], at - window + n), np.minimum(first[row + 1], at + window)
                    near = [b" ".join(low[starts[k] : ends[k]].tobytes() for k in range(p, q)).decode() for p, q in zip(begin, end)]
                    columns = [batch["_digest"].take(pa.array(a + row)), pa.array(np.full(len(at), n, np.int32)), pa.array(g[at].view(np.int64))]
                    columns += [pa.array((at - first[row]).astype(np.int32)), pa.array((at - begin).astype(np.int32)), pa.array(near, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["digest", "n", "h", "place", "at", "near"])


def _count_words(batches: Iterator[pa.RecordBatch], members: _Filter, keep: list[str]) -> Iterator[pa.RecordBatch]:
    """The kept columns, the digest, n_words, and whether the filter of digests lets the text pass."""
    for batch in batches:
        n_words = [np.diff(W.spans(raw, off, "alnum")[2]) for _, _, raw, off in W.runs(batch["text"])]
        maybe = np.zeros(batch.num_rows, bool)
        maybe[members.find(batch["_h"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))] = True
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), batch["_digest"], pa.array(np.concatenate(n_words or [np.zeros(0, np.int64)]), pa.int64()), pa.array(maybe)], [*keep, "_digest", "n_words", "_maybe"])


def _by_shuffle(docs: DataFrame, windows: DataFrame, keep: tuple[str, ...], window: int, shingle: int) -> DataFrame:
    """decontaminate() of a benchmark of any size; windows is a table.

    A text is known by its SHA-256, so copies are one text from the shuffle on.  Only
    texts that may have a hit are joined with what was found; the others are passed on.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    grams = stored(windows.select("words").distinct().mapInArrow(lambda it: _window_shingles(it, shingle), "words string, len int, n int, h long, offset int"), "shingles")
    lengths = sorted(r.n for r in grams.select("n").distinct().collect())
    every = send(_Filter(grams.select("h").distinct(), "h"))
    counts = docs.select("text").mapInArrow(lambda it: _count_members(it, every.value, lengths), "n int, h long, c long").groupBy("n", "h").agg(F.sum("c").alias("c"))
    order = F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "offset", "n", "len")
    rare = stored(grams.join(counts, ["n", "h"], "left").groupBy("words").agg(F.min(order).alias("r")).select("words", "r.n", "r.h", "r.offset", "r.len"), "rare")
    some = send(_Filter(rare.select("h").distinct(), "h"))
    digest = F.unhex(F.sha2("text", 256)).alias("_digest")
    seen = docs.filter("text is not null").select("text", digest).mapInArrow(lambda it: _occurrences(it, some.value, lengths, window), "digest binary, n int, h long, place int, at int, near string").distinct()
    start = F.col("at") - F.col("offset")
    near = F.split("near", " ")
    fits = (start >= 0) & (start + F.col("len") <= F.size(near))
    same = F.array_join(F.slice(near, F.greatest(start, F.lit(0)) + 1, F.col("len")), " ") == F.col("words")
    hits = stored(seen.join(rare, ["n", "h"]).filter(fits & same).select("digest", (F.col("place") - F.col("offset")).alias("first"), (F.col("place") - F.col("offset") + F.col("len") - 1).alias("last"), "words"), "hits")
    # runs of hit words: a run begins where no window before reaches
    by = Window.partitionBy("digest").orderBy("first", "last")
    fresh = F.coalesce(F.col("first") > F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1)) + 1, F.lit(True))
    runs = hits.select("digest", "first", "last").distinct().withColumn("_new", fresh.cast("int")).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("digest", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    spans = runs.groupBy("digest").agg(F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))
    items = hits.select("digest", "words").distinct().join(windows, "words").groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = stored(spans.join(items, "digest"), "found").withColumnRenamed("digest", "_digest")
    members = send(_Filter(found.select(F.xxhash64("_digest").alias("h")), "h"))
    names = list(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", _digest binary, n_words long, _maybe boolean"
    own = docs.select(*keep, *([] if "text" in keep else ["text"]), digest).withColumn("_h", F.xxhash64("_digest"))
    own = own.mapInArrow(lambda it: _count_words(it, members.value, names), schema)
    nothing = [F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<first:int,last:int>>").alias("spans")]
    touched = join_checked(own.filter("_maybe"), found, "_digest", "left")
    kept = [F.col(f"`{c}`") for c in keep]
    hit = touched.select(*kept, "n_words", *[F.coalesce(c, x).alias(c) for c, x in zip(("n_hit", "items", "spans"), nothing)])
    return own.filter("not _maybe").select(*kept, "n_words", *nothing).unionByName(hit)
