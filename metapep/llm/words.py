"""Vectorised word kernels shared by the operators of this subpackage.

All functions work on the UTF-8 buffer of an Arrow string column, so that no
Python string is made per word.  Words are maximal runs of non-separator bytes
inside one text; bytes of 0x80 and above are never separators.  A word's hash is
64 bits of a polynomial over keyed byte values: used to find candidates, to
count, and as set members; where a result depends on equality beyond 64 bits the
operator compares the words themselves or a second, independent hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEP_ALNUM = np.ones(256, bool)
_SEP_ALNUM[0x80:] = False
_SEP_ALNUM[ord("0") : ord("9") + 1] = False
_SEP_ALNUM[ord("a") : ord("z") + 1] = False
_SEP_ALNUM[ord("A") : ord("Z") + 1] = False
_SEP_SPACE = np.zeros(256, bool)
_SEP_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Separator classes: ``alnum`` splits on every ASCII character that is no digit or letter, ``space`` on white space.
SEPARATORS = {"alnum": _SEP_ALNUM, "space": _SEP_SPACE}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

#: Texts are handled in runs of about so many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 18

U64 = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _keyed(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return splitmix(np.arange(1, n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_MULT = 0x5851F42D4C957F2B  # odd, 3 mod 8
_POW: dict[int, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT**i and its inverse**i modulo 2**64, for i < n at least."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, RUN_BYTES + (RUN_BYTES >> 2))
        for k, m in ((0, _MULT), (1, pow(_MULT, -1, 1 << 64))):
            a = np.full(size, m, np.uint64)
            a[0] = 1
            with np.errstate(over="ignore"):
                _POW[k] = np.multiply.accumulate(a)
    return _POW[0], _POW[1]


def runs(text: pa.Array, run_bytes: int = RUN_BYTES):
    """(first row, last row + 1, bytes, row offsets within them) for runs of rows; a null row is empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    n = len(text)
    if n == 0:
        return
    _, off, data = text.buffers()
    off = np.frombuffer(off, np.int64, n + 1, text.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if text.null_count:  # the bytes under a null are undefined
        live = np.asarray(text.is_valid())
        if (np.diff(off)[~live] > 0).any():
            text = text.fill_null("")
            yield from runs(text, run_bytes)
            return
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + run_bytes, "right")) - 1)
        b = min(b, n)
        yield a, b, buf[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def spans(raw: np.ndarray, offsets: np.ndarray, sep: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and the number of the first word of each row (one more at the end)."""
    live = ~SEPARATORS[sep][raw]
    if not len(raw):
        return (z := np.zeros(0, np.int64)), z, np.zeros(len(offsets), np.int64)
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    start = live.copy()
    start[1:] &= ~live[:-1] | cut[1:-1]
    end = live.copy()
    end[:-1] &= ~live[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool, seed: int = 1) -> np.ndarray:
    """64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    table = _keyed(seed, 256)
    if fold:
        table = table[_FOLD]
    power, inverse = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(raw) + 1, np.uint64)
        total[0] = 0
        np.cumsum(table[raw] * power[: len(raw)], out=total[1:])
        h = (total[ends] - total[starts]) * inverse[starts]
        return splitmix(h + (ends - starts).astype(np.uint64))


def grams(h: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """64-bit hashes of the n consecutive words that start at each place (len(h) - n + 1 of them, over row borders too)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    keys = _keyed(seed, n) | U64(1)
    with np.errstate(over="ignore"):
        out = h[:m] * keys[0]
        for k in range(1, n):
            out += h[k : k + m] * keys[k]
    return splitmix(out)


def fold_bytes(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _FOLD[raw]


class Sieve:
    """A small table that most absent hashes fail at once."""

    def __init__(self, keys: np.ndarray):
        self.mask = np.uint64((1 << max(16, min(24, int(len(keys) * 32).bit_length()))) - 1)
        self.table = np.zeros(int(self.mask) + 1, bool)
        self.table[keys & self.mask] = True
        self.keys = keys

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of h that hold a key, and the number of the key."""
        at = np.flatnonzero(self.table[h & self.mask])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[k] == h[at]
        return at[same], k[same]


def count_grams(batches: Iterator[pa.RecordBatch], wanted: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts over all texts of the given word n-grams (by n, sorted hashes of words without case): rows n, h, c."""
    sieves = {n: Sieve(keys) for n, keys in wanted.items()}
    counts = {n: np.zeros(len(keys), np.int64) for n, keys in wanted.items()}
    for batch in batches:
        for _, _, raw, off in runs(batch["text"]):
            starts, ends, first = spans(raw, off, "alnum")
            h = hashes(raw, starts, ends, True)
            for n, sieve in sieves.items():
                at, k = sieve.find(grams(h, n))
                whole = np.searchsorted(first, at, "right") == np.searchsorted(first, at + n - 1, "right")
                counts[n] += np.bincount(k[whole], minlength=len(sieve.keys))
    for n, c in counts.items():
        live = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(live), n, np.int32)), pa.array(wanted[n][live].view(np.int64)), pa.array(c[live])], ["n", "h", "c"])
