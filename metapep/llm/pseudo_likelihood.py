"""LM scoring by masked pseudo-likelihood.

Tokens are words, as ids of a vocabulary counted over all documents: the most frequent
words by rank, all others in hashed slots behind them; a word of a slot has an equal
share of the slot's probability.  A small network predicts each token from the two on
either side, never from itself: embeddings, scaled by side and distance, are summed and
squashed, and a softmax of three levels gives the token's class, its group in the
class, and its place in the group.  It starts from the words' own frequencies.

Every partition trains a copy in numpy over all its tokens.  The copies are averaged row
by row, each weighted by how often the partition met the row's word or class, so a rare
word's row is not thinned out by partitions that never met it.  How documents lie in
partitions changes the copies: scores then differ a little (tests hold the mean
difference a token under 0.1).  A document's score is the sum of its tokens'
conditional log-probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches, cut, partitions

#: Branches of each of the three levels, and hidden units: all parameters are rows of this width.
WIDTH = 24
SIZE = WIDTH**3
#: Words that have an id of their own; all others share the other ids.
TOP = 12_288
PAD = SIZE
SIDES = (-2, -1, 1, 2)
#: Tokens of a step of training, and of a call of scoring.
BATCH, SCORED = 2048, 2048
RATE = 0.1
PASSES = 1
_SCALE = 1 << 16
_CHUNK = 256
#: Rows of the model: embeddings, scales, bias, and the weights, shifts and biases of the levels.
_PARTS = {"table": SIZE + 1, "scale": len(SIDES), "bias": 1, "w1": WIDTH, "b1": 1, "s2": WIDTH, "w2": WIDTH, "b2": WIDTH, "s3": WIDTH**2, "w3": WIDTH, "b3": WIDTH**2}
_AT = dict(zip(_PARTS, np.cumsum([0, *_PARTS.values()]).tolist()))
ROWS = sum(_PARTS.values())


def part(model: np.ndarray, name: str) -> np.ndarray:
    return model[_AT[name] : _AT[name] + _PARTS[name]]


def initial(counts: np.ndarray | None = None) -> np.ndarray:
    """A model that gives each id its share of the counts in every context."""
    rng = np.random.default_rng(5)
    model = (rng.standard_normal((ROWS, WIDTH)) * 0.1).astype(np.float32)
    c = (np.ones(SIZE) if counts is None else counts + 0.1).reshape(WIDTH, WIDTH, WIDTH)
    part(model, "scale")[:] = 1
    part(model, "bias")[:] = 0
    for name in ("s2", "s3"):
        part(model, name)[:] = 0
    for name, n, by in (("b1", c.sum((1, 2)), ()), ("b2", c.sum(2), (1,)), ("b3", c, (2,))):
        n = n.reshape(-1, WIDTH)
        part(model, name)[:] = np.log(n / n.sum(1, keepdims=True))
    return model


def _softmax(x: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of the places and all probabilities; takes x over."""
    np.clip(x, -60, 60, out=x)  # exp() can't overflow then
    own = x[row, place]
    e = np.exp(x, out=x)
    total = e @ np.ones((e.shape[1], 1), e.dtype)
    own -= np.log(total[:, 0])
    e /= total
    return own, e


def _forward(model: np.ndarray, around: np.ndarray, ids: np.ndarray):
    """around: ids by side (sides x tokens); log-probabilities of the tokens and what the gradient needs."""
    table, scale = part(model, "table"), part(model, "scale")
    x = np.repeat(part(model, "bias"), len(ids), 0)
    near = [table[a] for a in around]
    for e, c in zip(near, scale):
        x += e * c
    h = np.tanh(x, out=x)
    top, mid = ids // WIDTH**2, ids // WIDTH
    places = (top, mid % WIDTH, ids % WIDTH)
    ins = (h, h + part(model, "s2")[top], h + part(model, "s3")[mid])
    outs = (part(model, "b1"), part(model, "b2")[top], part(model, "b3")[mid])
    row = np.arange(len(ids))
    own, chances = zip(*[_softmax(g @ part(model, f"w{k}") + b, row, p) for k, (g, b, p) in enumerate(zip(ins, outs, places), 1)])
    return own[0] + own[1] + own[2], (near, ins, chances, places, top, mid, row)


def _by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their rows of values."""
    order = np.argsort(keys.astype(np.uint16 if keys.max(initial=0) < 1 << 16 else keys.dtype), kind="stable")  # a radix sort
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def gradient(model: np.ndarray, around: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean log-probability: the rows that it touches, and its values there."""
    _, (near, ins, chances, places, top, mid, row) = _forward(model, around, ids)
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    dh = None
    for k, (g, d, p, of) in enumerate(zip(ins, chances, places, (None, top, mid)), 1):
        np.negative(d, out=d)
        d[row, p] += 1
        d /= len(ids)
        found[f"w{k}"] = np.arange(WIDTH), g.T @ d
        dg = d @ part(model, f"w{k}").T
        dh = dg if dh is None else dh + dg
        found[f"b{k}"] = (np.zeros(1, np.int64), d.sum(0, keepdims=True)) if of is None else _by_key(of, d)
        if of is not None:
            found[f"s{k}"] = _by_key(of, dg)
    h = ins[0]
    dx = dh * (1 - h * h)
    scale = part(model, "scale")
    found["bias"] = np.zeros(1, np.int64), dx.sum(0, keepdims=True)
    found["scale"] = np.arange(len(SIDES)), np.stack([np.einsum("ij,ij->j", e, dx) for e in near])
    found["table"] = _by_key(around.ravel(), (scale[:, None] * dx).reshape(-1, WIDTH))
    return np.concatenate([found[n][0] + _AT[n] for n in found]), np.concatenate([found[n][1] for n in found])


class Vocabulary:
    def __init__(self, top: np.ndarray, distinct: np.ndarray | None = None):
        """top: hashes of the most frequent words, in order of rank; distinct: how many words each further id stands for."""
        self.keys = np.sort(top)
        self.rank = np.argsort(top, kind="stable")
        self.sieve = W.Sieve(self.keys)
        self.share = np.zeros(SIZE)
        self.share[TOP:] = -np.log(np.maximum(1, np.zeros(SIZE - TOP) if distinct is None else distinct))

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = (TOP + h % np.uint64(SIZE - TOP)).astype(np.int64)
        at, k = self.sieve.find(h)
        out[at] = self.rank[k]
        return out


def _tokens(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(rows, first word of each row, word hashes) for runs of rows."""
    for a, b, raw, off in W.runs(text):
        starts, ends, first = W.spans(raw, off, "alnum")
        yield b - a, first, W.hashes(raw, starts, ends, True)


def _around(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ids on each side of every token; PAD beyond its text."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((len(SIDES), len(ids)), PAD, np.int64)
    for k, d in enumerate(SIDES):
        if d < 0 and len(ids) > -d:
            out[k, -d:] = np.where(row[-d:] == row[:d], ids[:d], PAD)
        elif d > 0 and len(ids) > d:
            out[k, :-d] = np.where(row[:-d] == row[d:], ids[d:], PAD)
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts, new = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    for batch in batches:
        for _, _, h in _tokens(batch["text"]):
            new.append(np.unique(h, return_counts=True))
            if sum(len(x) for x, _ in new) > 1 << 20:
                keys, counts = _merged([(keys, counts), *new])
                new = []
    keys, counts = _merged([(keys, counts), *new])
    for a in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)].view(np.int64)), pa.array(counts[a : a + (1 << 16)])], ["h", "c"])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    keys, inverse = np.unique(h, return_inverse=True)
    return keys, np.bincount(inverse, c, len(keys)).astype(np.int64)


def _train(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, start: np.ndarray, passes: int) -> Iterator[pa.RecordBatch]:
    """Rows of a partition's model with their weights, in chunks."""
    model = start.copy()
    squares = np.full((ROWS, 1), 1e-6, np.float32) * np.ones((1, WIDTH), np.float32)
    for name in ("b1", "b2", "b3"):
        part(squares, name)[:] = 1e-3  # they start right
    met = np.zeros(SIZE + 1, np.int64)
    for batch in batches:
        for _, first, h in _tokens(batch["text"]):
            ids = vocabulary.ids(h)
            around = _around(ids, first)
            for _ in range(passes):
                for a in range(0, len(ids), BATCH):
                    rows, g = gradient(model, around[:, a : a + BATCH], ids[a : a + BATCH])
                    s = squares[rows] + g * g
                    squares[rows] = s
                    model[rows] += RATE * g / np.sqrt(s)
            met[: SIZE] += np.bincount(ids, minlength=SIZE)
            met[PAD] += len(first) - 1
    tokens = int(met[:SIZE].sum())
    if not tokens:
        return
    weight = np.full(ROWS, tokens, np.int64)
    weight[: SIZE + 1] = met
    for name, by in (("2", met[:SIZE].reshape(WIDTH, -1).sum(1)), ("3", met[:SIZE].reshape(WIDTH**2, -1).sum(1))):
        for letter in "sb":
            part(weight, letter + name)[:] = by
    for a in range(0, ROWS, _CHUNK):
        rows = a + np.flatnonzero(weight[a : a + _CHUNK])
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array([a // _CHUNK], pa.int32()), pa.array([rows.astype(np.int32).tobytes()]), pa.array([weight[rows].tobytes()]), pa.array([model[rows].tobytes()])], ["chunk", "row", "weight", "value"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of the rows of all chunks of a partition; copies are added up as they come, in whole numbers, so that their order doesn't matter."""
    total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for chunk, row, weight, value in zip(*(batch[c].to_pylist() for c in ("chunk", "row", "weight", "value"))):
            sums, weights = total.setdefault(chunk, (np.zeros((_CHUNK, WIDTH), np.int64), np.zeros(_CHUNK, np.int64)))
            at, w = np.frombuffer(row, np.int32) - chunk * _CHUNK, np.frombuffer(weight, np.int64)
            v = np.rint(np.frombuffer(value, np.float32).reshape(-1, WIDTH).astype(np.float64) * _SCALE).astype(np.int64)
            sums[at] += v * w[:, None]  # 10^13 tokens stay below 2^63
            weights[at] += w
    for chunk, (sums, weights) in total.items():
        at = np.flatnonzero(weights != 0)
        mean = sums[at] / weights[at][:, None] / _SCALE
        yield pa.RecordBatch.from_arrays([pa.array([(chunk * _CHUNK + at).astype(np.int32).tobytes()]), pa.array([mean.astype(np.float32).tobytes()])], ["row", "value"])


def fit(docs: DataFrame, passes: int = PASSES) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and model over all texts of docs; without any word, an untrained model."""
    bounded_batches(docs)
    text = docs.select("text")
    counts = cut(text.mapInArrow(_word_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    top = counts.orderBy(F.desc("c"), "h").limit(TOP).toArrow()
    known = top["h"].to_numpy()
    size = np.zeros(SIZE)
    size[: len(known)] = top["c"].to_numpy()
    # all other words by id: h as an unsigned number modulo the number of ids
    others = SIZE - TOP
    rest = counts.join(F.broadcast(docs.sparkSession.createDataFrame(pa.table({"h": known}))), "h", "left_anti")
    rest = rest.groupBy(F.pmod(F.pmod("h", F.lit(others)) + F.when(F.col("h") < 0, F.lit((1 << 64) % others)).otherwise(0), F.lit(others)).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n"))
    distinct = np.zeros(others)
    for r in rest.collect():  # a row an id
        size[TOP + r.k], distinct[r.k] = r.c, r.n
    vocabulary = Vocabulary(known.view(np.uint64), distinct)
    start = initial(size)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, start))
    copies = text.mapInArrow(lambda it: _train(it, *sent.value, passes), "chunk int, row binary, weight binary, value binary")
    means = copies.repartition(min(partitions(docs), -(-ROWS // _CHUNK)), "chunk").mapInArrow(_average, "row binary, value binary")
    model = start.copy()
    for r in means.collect():  # the rows of one model
        model[np.frombuffer(r.row, np.int32)] = np.frombuffer(r.value, np.float32).reshape(-1, WIDTH)
    return vocabulary, model


def token_scores(vocabulary: Vocabulary, model: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    around = _around(ids, first)
    parts = [_forward(model, around[:, a : a + SCORED], ids[a : a + SCORED])[0].astype(np.float64) for a in range(0, len(ids), SCORED)]
    return np.concatenate([np.zeros(0), *parts]) + vocabulary.share[ids]


def _score(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, model: np.ndarray, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, total = [], []
        for _, first, h in _tokens(batch["text"]):
            sums = np.r_[0.0, np.cumsum(token_scores(vocabulary, model, vocabulary.ids(h), first))]
            n.append(np.diff(first))
            total.append(sums[first[1:]] - sums[first[:-1]])
        n_tokens = np.concatenate([np.zeros(0, np.int64), *n])
        score = np.concatenate([np.zeros(0), *total])
        mean = np.divide(score, n_tokens, out=np.zeros(len(score)), where=n_tokens > 0)
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(n_tokens), pa.array(score), pa.array(mean, mask=n_tokens == 0)], [*keep, "n_tokens", "log_likelihood", "mean_log_likelihood"])


def score(docs: DataFrame, fitted: tuple[Vocabulary, np.ndarray], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row of docs: its `keep` columns, n_tokens, log_likelihood (sum over tokens) and mean_log_likelihood.

    Null and empty texts have no tokens: sum 0, mean null.  A very long text is scored whole.  Repeated rows each have
    their result; no rows give no rows.  Other columns are left out, so their names
    can't clash.
    """
    if clash := {"n_tokens", "log_likelihood", "mean_log_likelihood"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(docs)
    names = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", n_tokens long, log_likelihood double, mean_log_likelihood double"
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lambda it: _score(it, *sent.value, names), schema)
