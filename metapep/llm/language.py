"""Language identification by hierarchical discrimination.

Texts are folded to lower-case letters with single blanks; their features are relative
frequencies of hashed byte n-grams.  One-versus-one linear support vector machines
choose a language family first; within it, one-versus-one machines separate the
related languages.  Machines are trained in numpy on a bounded sample of labelled
rows; prediction is one pass over whole texts, with a row's margin the mean weight
of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches

#: Language families; a language of none of them is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
SIZES = (2, 3, 4)
DIM = 4096
#: Bytes of a text, and rows, that are counted at once.
PIECE, ROWS = 1 << 20, 256
#: Most labelled rows that training takes, over all languages.
SAMPLE_ROWS = 1200
UNDETERMINED = "und"

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def _folded(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (A-Z and Latin-1) and single blanks, and the rows' new offsets."""
    x = _LETTERS[raw]
    upper = (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97) & (x[:-1] == 0xC3)
    x[1:][upper] += 0x20
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0x20) | (x[:-1] != 0x20)
    return x[keep], np.r_[0, np.cumsum(keep)][off]


def _features(x: np.ndarray, off: np.ndarray, sizes: tuple[int, ...] = SIZES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the feature at each place and whether the n-gram lies in one row."""
    edge = np.zeros(len(x) + 1, np.int64)
    edge[off] = 1
    for k in sizes:
        m = len(x) - k + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        crosses = np.zeros(m, bool)
        for i in range(k):
            code = (code << np.uint32(8)) | x[i : i + m]
            if i:
                crosses |= edge[i : i + m] > 0
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * k)
        yield ((code >> np.uint32(20)) % np.uint32(DIM)).astype(np.int32), ~crosses


def _counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(row, feature): how often each row has each feature."""
    n = len(off) - 1
    out = np.zeros(n * DIM)
    if len(raw):
        x, off = _folded(raw, off)
        for f, ok in _features(x, off):
            row = np.searchsorted(off, np.arange(len(f)), "right") - 1
            out += np.bincount(row[ok] * DIM + f[ok], minlength=n * DIM)
    return out.reshape(n, DIM)


def _long_counts(raw: np.ndarray) -> np.ndarray:
    """_counts() of one text, PIECE bytes at a time; pieces end before an ASCII byte, and n-grams that begin in one and end in the next count too."""
    out = np.zeros(DIM)
    a, before = 0, np.zeros(0, np.uint8)
    while a < len(raw):
        b = min(a + PIECE, len(raw))
        while b < len(raw) and raw[b] >= 0x80:
            b += 1
        x, _ = _folded(raw[a:b], np.array([0, b - a]))
        if len(before) and before[-1] == 0x20 and x[0] == 0x20:
            x = x[1:]
        for k in SIZES:
            z = np.r_[before[len(before) - min(k - 1, len(before)) :], x]
            for f, ok in _features(z, np.array([0, len(z)]), (k,)):
                out += np.bincount(f[ok], minlength=DIM)
        before = np.r_[before, x][-max(SIZES) :]
        a = b
    return out


def _counted(text: pa.Array) -> Iterator[np.ndarray]:
    """_counts() of all rows of a column in turn, some rows at a time, so that memory follows neither the rows of a batch nor a text's length."""
    for a, b, raw, off in W.runs(text):
        if len(raw) > PIECE:  # such a row is alone
            yield _long_counts(raw)[None]
            continue
        for i in range(0, b - a, ROWS):
            o = off[i : min(b - a, i + ROWS) + 1]
            yield _counts(raw[o[0] : o[-1]], o - o[0])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for count in _counted(batch["text"]):
            out += [v.astype(np.float16).tobytes() for v in 1000 * count / np.maximum(1, count.sum(1, keepdims=True))]
        yield pa.RecordBatch.from_arrays([batch["lang"], batch["order"], pa.array(out, pa.binary())], ["lang", "order", "v"])


def _svm(x: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss on standardised features by accelerated gradient descent; classes weigh alike."""
    z = x.astype(np.float32) / 1000
    mean, std = z.mean(0), z.std(0) + 1e-5
    z -= mean
    z /= std
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, c = w.copy(), b
    step = 0.5 / max(1.0, float(np.einsum("ij,ij->", z, z)) / len(z) / 4)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ v + c)) * weight
        nw, nb = v - step * (penalty * v - 2 * (z.T @ (slack * y))), c + step * 2 * float((slack * y).sum())
        m = k / (k + 3)
        v, c, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return (w / std).astype(np.float32), float(b - (w / std) @ mean)


class Model:
    """Families, their languages, and a machine for each pair at either level."""

    def __init__(self, x: np.ndarray, lang: np.ndarray):
        """x: n-gram frequencies in thousandths, as float16; lang: languages of the rows."""
        family_of = {v: k for k, names in FAMILIES.items() for v in names}
        family = np.array([family_of.get(v, v) for v in lang])
        self.families = sorted(set(family.tolist()))
        self.languages = {f: sorted(set(lang[family == f].tolist())) for f in self.families}
        self.pairs: list[tuple[str, str, str]] = []  # (family, or blank for the upper level; one; other)
        weights, biases = [], []
        for level, label, rows in [("", family, np.ones(len(lang), bool)), *((f, lang, family == f) for f in self.families)]:
            for p, q in combinations(sorted(set(label[rows].tolist())), 2):
                own = rows & ((label == p) | (label == q))
                w, b = _svm(x[own], np.where(label[own] == p, 1, -1).astype(np.float32))
                self.pairs.append((level, p, q))
                weights.append(w)
                biases.append(b)
        self.weights = np.stack(weights, 1) if weights else np.zeros((DIM, 0), np.float32)
        self.biases = np.array(biases)

    def _choose(self, level: str, names: list[str], margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the name with most pairs won (then the largest sum of margins), and its mean confidence in its pairs."""
        n = len(margin)
        won, total, sure = (np.zeros((n, len(names))) for _ in range(3))
        for k, (own, p, q) in enumerate(self.pairs):
            if own == level:
                i, j = names.index(p), names.index(q)
                m = np.clip(margin[:, k], -30, 30)
                s = 1 / (1 + np.exp(-2 * m))
                for at, sign, c in ((i, 1, s), (j, -1, 1 - s)):
                    won[:, at] += sign * m > 0
                    total[:, at] += np.tanh(sign * m)
                    sure[:, at] += c
        best = np.argmax(won + total / (2 * len(names) + 2), 1)
        return best, sure[np.arange(n), best] / (len(names) - 1) if len(names) > 1 else np.ones(n)

    def predict(self, margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNDETERMINED] * len(margin), np.zeros(len(margin))
        best, score = self._choose("", self.families, margin)
        lang = [""] * len(margin)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            which, sure = self._choose(f, self.languages[f], margin[rows])
            score[rows] *= sure
            for r, w in zip(rows, which):
                lang[r] = self.languages[f][w]
        return lang, score


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from rows (text, lang, order): at most `sample_rows`, evenly by language and least `order` hash first; rows without text or lang teach nothing."""
    bounded_batches(labelled)
    rows = labelled.filter("text is not null and lang is not null").withColumn("order", F.pmod(F.xxhash64("order"), F.lit(1 << 30)))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = max(8, sample_rows // max(1, len(counts)))
    limit = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1 << 30, int((1 << 30) * 1.3 * each / n) + 1))]) if counts else None
    got = rows.filter(F.col("order") < limit[F.col("lang")]).select("text", "lang", "order").mapInArrow(_vectors, "lang string, order long, v binary").collect() if counts else []
    by: dict[str, list] = {}
    for r in sorted(got, key=lambda r: (r.order, r.v)):
        if len(own := by.setdefault(r.lang, [])) < each:
            own.append(r.v)
    lang = np.array([k for k in sorted(by) for _ in by[k]])
    del got
    x = np.stack([np.frombuffer(v, np.float16) for k in sorted(by) for v in by[k]]) if by else np.zeros((0, DIM), np.float16)
    return Model(x, lang)


def _apply(batches: Iterator[pa.RecordBatch], model: Model, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, score = [], []
        for count in _counted(batch["text"]):
            total = count @ model.weights.astype(np.float64)
            names, sure = model.predict(total / np.maximum(1, count.sum(1))[:, None] + model.biases)
            lang += names
            score += sure.tolist()
        letter = batch["has_letter"].to_pylist()
        lang = [v if ok else UNDETERMINED for v, ok in zip(lang, letter)]
        score = [v if ok else 0.0 for v, ok in zip(score, letter)]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*keep, "lang_pred", "score"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row of docs: its `keep` columns, lang_pred and score (0 to 1: confidence in the family times that within it).

    A null text, and one without any letter, is `und` with score 0; so is every text
    if the model knows no language.  A very long text is read whole,
    a megabyte at a time, so a worker holds a few times its bytes whatever the number of
    languages.  Repeated rows each have their result; no rows give
    no rows.  Columns outside `keep` but text are left out, so their names can't clash.
    """
    if clash := {"lang_pred", "score", "has_letter"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(docs)
    names = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", lang_pred string, score double"
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]), F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    return rows.mapInArrow(lambda it: _apply(it, sent.value, names), schema)


def labelled(docs: DataFrame) -> DataFrame:
    """The rows that may teach: those not held out, by id."""
    return docs.filter("doc_id is not null").filter(~held_out(docs["doc_id"])).select("text", "lang", F.col("doc_id").alias("order"))
