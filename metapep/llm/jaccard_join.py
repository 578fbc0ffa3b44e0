"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles.  Two of them can only reach the threshold if they
share one of the first tokens of either in one common order (prefix principle); the
order is by hash, with tokens that many documents have last.

1. Equal sets are one class; only its least document goes on.
2. Prefix tokens are shuffled; those that two classes share make the matrix
   (token, document).  Of a pair the smaller set (either, if they are alike) has the
   first common token in a still shorter prefix; a token that is in nobody's short
   prefix is left out, which are the frequent ones of texts made from a template.
3. Documents are partitioned into groups by the token of theirs that most others share.
   A group is opened in parts of bounded size: all overlaps inside a part are counted
   exactly, and a few documents of the group are in each of its parts and tie them
   together.  What is linked is a group of similar documents from then on.
4. The matrix is folded to the parts of groups: per token the parts that hold it, with
   the range of their members' sizes and token places.  A document asks the parts of
   larger groups than its own that share a token with it, short prefix with either,
   long prefix with short only, where sizes and places allow the threshold, then where an upper bound of the overlap from the parities of hashed
   tokens does.  Only those parts are opened: exact overlaps again.
5. Links join groups to components.

Nothing is capped: every pair that the bounds allow and that is not yet known to be in
one component is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .blobs import FLUSH, grouped, wide
from .common import bounded_batches, cut, join_checked, partitions, stored
from .components import components

SHINGLE = 5
THRESHOLD = 75  # percent
#: Documents of a part, and those that are in every part of their group.
PART = 256
PIVOTS = 4
#: Tokens in so many documents come last in the order; at most HEAVY of them, the most frequent. Only speed depends on it.
FREQUENT = 50
HEAVY = 1_000_000
#: Most bytes of ids that are sent to every executor where the other side is texts.
SENT_IDS = 16 << 20
#: Tokens of more documents are joined by classes of size too.
COMMON = 64
_COLUMNS = 1 << 13


def _sets(text: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for a, b, raw, off in W.runs(text):
        starts, ends, first = W.spans(raw, off, "space")
        h = W.hashes(raw, starts, ends, True)
        g = W.grams(h, n)
        for r in range(b - a):
            i, j = int(first[r]), int(first[r + 1])
            if j - i >= n:
                yield np.unique(g[i : j - n + 1])
            elif j > i:
                yield W.grams(h[i:j], j - i, seed=1000 + j - i)
            else:
                yield np.zeros(0, np.uint64)


def _needed(n, threshold: int):
    """Least overlap of a set of n with any that reaches the threshold."""
    return (threshold * n + 99) // 100


def _is_short(place, n, threshold: int):
    """Whether a token at the place can be the first that a set of n shares with one as large or larger; for numbers, arrays and columns."""
    return (100 + threshold) * (n - place) >= 2 * threshold * n


def _parity(tokens: np.ndarray) -> bytes:
    """Parities of the tokens by hashed place, two places a token or more, a power of two in all."""
    size = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    at = (W.splitmix(tokens ^ np.uint64(0xA5A5A5A5)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size) % 2 == 1).tobytes()


def _least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference; the places of the longer one fold onto the shorter one's."""
    x, y = np.unpackbits(np.frombuffer(a, np.uint8)), np.unpackbits(np.frombuffer(b, np.uint8))
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int((x != y).sum())


def _sign(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, one, two, bits = [], [], [], []
        for s in _sets(batch["text"], n):
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            size.append(len(s))
            one.append((d >> 64) - (1 << 63))
            two.append((d & ((1 << 64) - 1)) - (1 << 63))
            bits.append(_parity(s) if len(s) else b"")
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["own"], pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bits, pa.binary())], ["doc_id", "own", "n", "d1", "d2", "bits"])


def _frequent(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Tokens that a task has more than once, by counts."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        held.clear()
        more = counts > 1
        return pa.RecordBatch.from_arrays([pa.array(keys[more].view(np.int64)), pa.array(counts[more])], ["token", "n"])

    total = 0
    for batch in batches:
        for s in _sets(batch["text"], n):
            held.append(s)
            total += len(s)
            if total > 2 * FLUSH:
                yield flush()
                total = 0
    yield flush()


def _send_prefix(batches: Iterator[pa.RecordBatch], n: int, threshold: int, heavy: tuple[np.ndarray, np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    keys, rank = heavy
    sieve = W.Sieve(keys)

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            t, doc, place = (np.concatenate([x[i] for x in held]) for i in range(3))
            held.clear()
            yield from grouped((t >> np.uint64(64 - bits)).astype(np.int64), {"low": t.astype(np.uint32), "high": (t >> np.uint64(32)).astype(np.uint8), "doc": doc, "place": place})

    total = 0
    for batch in batches:
        for doc, s in zip(batch["doc"].to_pylist(), _sets(batch["text"], n)):
            if not len(s):
                continue
            first = len(s) - _needed(len(s), threshold) + 1
            at, k = sieve.find(s)
            if len(at):
                late = np.zeros(len(s), np.int64)
                late[at] = rank[k]
                s = s[np.argsort(late, kind="stable")]
            at = np.arange(first)
            held.append((s[:first], np.full(first, doc, np.int64), (np.minimum(at, 0x7FFF) | _is_short(at, len(s), threshold) << 15).astype(np.uint16)))
            total += first
        if total > FLUSH:
            yield from flush()
            total = 0
    yield from flush()


def _matrix(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (token, doc, place, short, docs) of the tokens that several documents have, at least one in its short prefix; docs of them."""
    held: list[tuple] = []
    for batch in batches:
        for bucket, n, low, high, doc, place in zip(*(batch[c].to_pylist() for c in ("bucket", "n", "low", "high", "doc", "place"))):
            key = np.frombuffer(low, np.uint32).astype(np.uint64) | np.frombuffer(high, np.uint8).astype(np.uint64) << np.uint64(32) | np.uint64(bucket) << np.uint64(40)
            held.append((key, wide(doc, n), np.frombuffer(place, np.uint16)))
    if not held:
        return
    key, doc, place = (np.concatenate([x[i] for x in held]) for i in range(3))
    held.clear()
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]  # rows that occur again count once
    key, doc, place = key[new], doc[new], place[order][new]
    group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
    docs = np.bincount(group)[group]
    short = place >> 15 > 0
    hot = np.flatnonzero((docs > 1) & (np.bincount(group, short)[group] > 0))
    for a in range(0, len(hot), 1 << 16):
        i = hot[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(key[i].view(np.int64)), pa.array(doc[i]), pa.array((place[i] & 0x7FFF).astype(np.int32)), pa.array(short[i]), pa.array(docs[i].astype(np.int32))], ["token", "doc", "place", "short", "docs"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, from the incidence of the tokens that several sets have, in blocks of columns."""
    token = np.concatenate([np.zeros(0, np.uint64), *sets])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(token, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    live = shared[column]
    row, column = row[live], number[column[live]]
    out = np.diag([float(len(s)) for s in sets])
    np.fill_diagonal(out, 0)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(shared.sum()), _COLUMNS):
        i, j = np.searchsorted(column, [a, a + _COLUMNS])
        m = np.zeros((len(sets), min(_COLUMNS, int(shared.sum()) - a)), np.float32)
        m[row[i:j], column[i:j] - a] = 1
        out += m @ m.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _open(part: pa.Table, n: int, threshold: int) -> pa.Table:
    """Links of a part, a star for each set of documents that hang together."""
    by: dict[int, np.ndarray] = {}
    for doc, s in zip(part["doc"].to_pylist(), _sets(part["text"], n)):
        by.setdefault(doc, s)
    docs = sorted(by)
    both = overlaps([by[d] for d in docs])
    size = np.diag(both)
    linked = (100 * both >= threshold * (size[:, None] + size[None, :] - both)) & (size > 0)
    label = np.arange(len(docs))
    while len(docs):
        new = np.where(linked, label[None, :], len(docs)).min(1)
        new = np.minimum(new, label)
        if (new == label).all():
            break
        label = new
    ids = np.array(docs, np.int64)
    own = label != np.arange(len(docs))
    return pa.table([pa.array(ids[own]), pa.array(ids[label[own]] if len(ids) else ids)], ["a", "b"])


def _by_cell(t: pa.Table, *columns: str) -> dict[tuple[int, int], list[tuple]]:
    out: dict[tuple[int, int], list[tuple]] = {}
    for cell, chunk, *rest in zip(*(t[c].to_pylist() for c in ("cell", "chunk", *columns))):
        out.setdefault((cell, chunk), []).append(tuple(rest))
    return out


def _bound(queries: pa.Table, members: pa.Table, threshold: int) -> pa.Table:
    """The queries whose parities allow the threshold with a member of the cell that is in another group."""
    stay = []
    held = _by_cell(members, "n", "g", "bits")
    for key, asked in _by_cell(queries, "doc", "n", "g", "bits").items():
        for doc, n, g, bits in asked:
            for m, other, own in held.get(key, ()):
                if other != g and 100 * min(m, n) >= threshold * max(m, n):
                    most = (m + n - _least_difference(bits, own)) // 2
                    if 100 * most >= threshold * (m + n - most):
                        stay.append((*key, doc, g, n))
                        break
    return pa.table([pa.array([x[i] for x in stay], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["cell", "chunk", "doc", "g", "n"])


def _settle(queries: pa.Table, members: pa.Table, n: int, threshold: int) -> pa.Table:
    """A link for each query and group of the cell that it reaches."""
    links = []
    sets = [list(_sets(t["text"], n)) for t in (queries, members)]
    held = _by_cell(members.append_column("at", pa.array(range(len(members)))), "doc", "g", "at")
    for key, asked in _by_cell(queries.append_column("at", pa.array(range(len(queries)))), "doc", "g", "at").items():
        own = held.get(key, [])
        both = overlaps([sets[0][k] for *_, k in asked] + [sets[1][k] for *_, k in own])
        size = np.diag(both)
        for i, (doc, g, _) in enumerate(asked):
            met: set[int] = set()
            for j, (other, h, _) in enumerate(own, len(asked)):
                if h != g and h not in met and both[i, j] > 0 and 100 * both[i, j] >= threshold * (size[i] + size[j] - both[i, j]):
                    met.add(h)
                    links.append((doc, other))
    return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in range(2)], ["a", "b"])


def _cogroups(queries: DataFrame, members: DataFrame, both: DataFrame, shingles: int, scan, schema: str) -> DataFrame:
    """scan(queries, members) of many cells at a time, about 2048 rows and so many shingles; both holds the rows of either side and their n."""
    rows, total = both.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = max(16, -(-rows // 2048), -(-total // shingles))

    def key(df: DataFrame) -> DataFrame:
        """New names for the columns, as both sides can come from one table."""
        return df.select(*[F.col(c).alias(c) for c in df.columns], F.pmod(F.xxhash64("cell", "chunk"), F.lit(n)).cast("int").alias("_b"))

    return key(queries).groupBy("_b").cogroup(key(members).groupBy("_b")).applyInArrow(scan, schema)


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted with the text of its doc."""
    return join_checked(rows.select("doc", "text"), wanted, "doc", "inner", SENT_IDS)


def ask_pairs(entries: DataFrame, cells: DataFrame) -> DataFrame:
    """Each entry (token, doc) with the cells of its token that it may have to ask, before sizes and places are compared.

    Two long prefixes never meet.  Tokens of many documents are joined by classes of
    size as well: partners are in the same class or one next to it.
    """
    near = F.when(F.col("docs") > COMMON, F.array(*[F.col("class") + d for d in (-1, 0, 1)])).otherwise(F.array("class"))
    kinds = F.when(F.col("short"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    asks = entries.withColumn("class", F.explode(near)).withColumn("short", F.explode(kinds)).drop("docs")
    return asks.join(cells, ["token", "class", "short"])


def _links(rows: DataFrame, reps: DataFrame, n: int, threshold: int) -> DataFrame:
    """Edges (a, b) of docs whose components are those of all pairs of classes that reach the threshold.

    rows: (doc, text) of one document a class; reps: (doc, n, bits), stored.
    """
    spark = rows.sparkSession
    parts = partitions(rows)
    bits = min(24, max(10, (4 * parts).bit_length()))
    heavy = rows.select("text").mapInArrow(lambda it: _frequent(it, n), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    heavy = heavy.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(HEAVY).toArrow()
    keys, rank = heavy["token"].to_numpy().view(np.uint64), heavy["n"].to_numpy()
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast((keys[order], rank[order]))
    prefix = rows.mapInArrow(lambda it: _send_prefix(it, n, threshold, sent.value, bits), "bucket int, n int, low binary, high binary, doc binary, place binary")
    matrix = stored(prefix.repartition(parts, "bucket").mapInArrow(lambda it: _matrix(it, bits), "token long, doc long, place int, short boolean, docs int"), "matrix")
    # groups: the token most shared
    group = cut(matrix.groupBy("doc").agg(F.max(F.struct("docs", "token")).alias("g")).select("doc", F.col("g.token").alias("group")))
    least = [F.min(F.when(F.pmod(F.xxhash64("doc"), F.lit(PIVOTS)) == k, F.col("doc"))) for k in range(PIVOTS)]
    size = group.groupBy("group").agg(F.count("*").alias("m"), F.array_compact(F.array(*least)).alias("pivots")).filter("m > 1")
    size = cut(size.select("group", F.ceil(F.col("m") / PART).cast("int").alias("parts"), "pivots"))
    seats = join_checked(group, size.drop("pivots"), "group", "inner").select("doc", "group", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("parts")).cast("int").alias("part"))
    ties = size.filter("parts > 1").select("group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pivots").select(F.explode("pivots").alias("doc"), "group", "part")
    seats = cut(seats)
    near = cut(_texts(rows, cut(seats.union(ties.select(*seats.columns)))).groupBy("group", "part").applyInArrow(lambda t: _open(t, n, threshold), "a long, b long"))
    grown = cut(components(near).withColumnRenamed("node", "doc"))
    # the matrix folded to cells: the part of a document's group, or the document alone
    cell = F.when(F.col("part").isNotNull(), F.xxhash64("group", "part")).otherwise(F.xxhash64("doc", F.lit(3)))
    members = join_checked(join_checked(group.select("doc"), seats, "doc", "left"), grown, "doc", "left")
    members = cut(members.select("doc", cell.alias("cell"), F.coalesce("component", "doc").alias("g")))
    weight = cut(members.groupBy("g").agg(F.count("*").alias("size")).filter("size > 1"))
    members = join_checked(members, weight, "g", "left").select("doc", "cell", "g", F.coalesce("size", F.lit(1)).alias("size"))
    members = cut(members.join(reps.select("doc", "n"), "doc"))
    ratio = F.lit(100.0 / threshold * 1.0001)  # sizes of a pair are in one class or in two that are next to each other
    of_size = F.when(F.col("docs") > COMMON, F.floor(F.log(F.col("n").cast("double")) / F.log(ratio))).otherwise(0).cast("int")
    entries = cut(join_checked(matrix, members, "doc", "inner").withColumn("class", of_size))
    cells = entries.groupBy("token", "class", "short", "cell", F.col("g").alias("c_g"), F.col("size").alias("c_size")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("place")).alias("room"))
    cells = cut(cells)
    several = cut(cells.groupBy("token").agg(F.min("c_g").alias("lo"), F.max("c_g").alias("hi")).filter("lo <> hi").select("token"))
    asks = join_checked(entries, several, "token", "left_semi").select("token", "doc", "n", "place", "g", "size", "short", "class", "docs", F.col("cell").alias("own"))
    cells = join_checked(cells, several, "token", "left_semi")
    smaller = F.struct(F.col("size"), F.col("g")) < F.struct(F.col("c_size"), F.col("c_g"))  # the smaller group asks the larger one
    left = F.least(F.col("n") - F.col("place"), F.col("room"))  # at most so many common tokens if this is the first
    # what sits in one cell has been compared
    allowed = smaller & (F.col("own") != F.col("cell")) & (100 * F.col("hi") >= threshold * F.col("n")) & (100 * F.col("n") >= threshold * F.col("lo")) & ((100 + threshold) * left >= threshold * (F.col("n") + F.col("lo")))
    asked = cut(ask_pairs(asks, cells).filter(allowed).select("doc", "cell").distinct())
    chunks = cut(asked.groupBy("cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("chunks")))
    # what else of the members of these cells and of those who ask is needed
    queries = join_checked(asked, chunks, "cell", "inner").select("doc", "cell", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int").alias("chunk"))
    held = join_checked(members.select("doc", "cell"), chunks, "cell", "inner").select("doc", "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    both = queries.withColumn("asks", F.lit(True)).union(held.withColumn("asks", F.lit(False)))
    both = cut(both.join(members.select("doc", "g"), "doc").join(reps, "doc"))
    queries, held = (both.filter(F.col("asks") == x).drop("asks") for x in (True, False))
    queries = cut(_cogroups(queries, held, both, 1 << 24, lambda q, m: _bound(q, m, threshold), "cell long, chunk int, doc long, g long, n long"))
    held = join_checked(held.drop("bits"), cut(queries.select("cell", "chunk").distinct()), ["cell", "chunk"], "left_semi")
    both = cut(queries.select("cell", "chunk", "doc", "g", "n", F.lit(True).alias("asks")).union(held.select("cell", "chunk", "doc", "g", "n", F.lit(False))))
    texts = _texts(rows, both)
    queries, held = (texts.filter(F.col("asks") == x).drop("asks", "n") for x in (True, False))
    return near.union(_cogroups(queries, held, both, 1 << 19, lambda q, m: _settle(q, m, n, threshold), "a long, b long"))


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """For each row of docs: doc_id, n_shingles and component_id, the least doc_id it is linked with, directly or not.

    Two documents link when the Jaccard similarity of their sets of shingles reaches the
    threshold (percent).  A text under `shingle` words is one shingle; null and empty
    texts have none and link with nothing.  A very long text is one set like any other.
    Rows without doc_id link with nothing and have no component.  Rows that repeat an
    id, with one text or several, are one document with the links of each.  No rows
    give no rows; other columns are not read, so their names can't clash.
    """
    bounded_batches(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("own", F.xxhash64("doc_id", "text"))  # tells the rows of one id apart
    sign = stored(rows.mapInArrow(lambda it: _sign(it, shingle), "doc_id long, own long, n long, d1 long, d2 long, bits binary"), "signatures")
    live = sign.filter("doc_id is not null and n > 0")
    classes = cut(live.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "own")).alias("r")).select("d1", "d2", F.col("r.doc_id").alias("class"), F.col("r.own").alias("rep")))
    signed = stored(join_checked(live, classes, ["d1", "d2"], "inner"), "classes")
    # of a class one row goes on; where an id has rows of several classes, each has a key of its own
    mixed = signed.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y"), F.min("class").alias("a"), F.max("class").alias("b")).filter("x <> y")
    mixed = cut(mixed.select("doc_id", "a", "b", F.lit(True).alias("several")))
    none = mixed.isEmpty()
    again = cut(signed.filter("doc_id <> class or own <> rep").select("doc_id", "own").distinct())
    reps = signed.filter("doc_id = class and own = rep").select("doc_id", "own", "n", "bits")
    one = join_checked(rows.filter("doc_id is not null and text is not null"), again, ["doc_id", "own"], "left_anti", SENT_IDS)

    def keyed(df: DataFrame) -> DataFrame:
        if none:
            return df.withColumn("doc", F.col("doc_id"))
        return join_checked(df, mixed.select("doc_id", "several"), "doc_id", "left").withColumn("doc", F.when(F.col("several"), F.col("own")).otherwise(F.col("doc_id")))

    edges = _links(keyed(one).select("doc", "text"), cut(keyed(reps).select("doc", "n", "bits").dropDuplicates(["doc"])), shingle, threshold)
    if not none:
        names = cut(keyed(reps.join(mixed.select("doc_id"), "doc_id", "left_semi")).select(F.col("doc").alias("k"), F.col("doc_id").alias("name")).distinct())
        for c in ("a", "b"):
            edges = join_checked(edges.withColumnRenamed(c, "k"), names, "k", "left").withColumn(c, F.coalesce("name", "k")).drop("k", "name")
    found = cut(components(edges.select("a", "b").union(mixed.select("a", "b")).union(mixed.select("doc_id", "a"))))
    classes = cut(join_checked(classes, found.withColumnRenamed("node", "class"), "class", "left").select("d1", "d2", F.coalesce("component", "class").alias("component")))
    out = join_checked(sign, classes, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"))
