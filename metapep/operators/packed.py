"""K-mers as numbers: five bits a residue, twelve residues a long, so that they hash, compare and sort as integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Residues of a word, and windows that a task makes at once.
WORD, CHUNK = 12, 1 << 17


def word_names(k: int) -> list[str]:
    return [f"_w{i}" for i in range(-(-k // WORD))]


def _packed(batches: Iterator[pa.RecordBatch], k: int, column: str) -> Iterator[pa.RecordBatch]:
    names = word_names(k)
    for batch in batches:
        text = batch[column].cast(pa.large_string()).fill_null("")
        _, off, data = text.buffers()
        off = np.frombuffer(off, np.int64, len(text) + 1, text.offset * 8)
        codes = (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)) & 31
        ends = np.cumsum(np.maximum(0, np.diff(off) - k + 1))
        rest = batch.drop_columns([column])
        for a in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
            window = np.arange(a, min(a + CHUNK, int(ends[-1])))
            row = np.searchsorted(ends, window, "right")
            at = off[row] + window - np.where(row > 0, ends[row - 1], 0)
            words = []
            for w in range(len(names)):
                value = np.zeros(len(at), np.int64)
                for j in range(w * WORD, min(k, (w + 1) * WORD)):
                    value = (value << 5) | codes[at + j]
                words.append(pa.array(value))
            kept = rest.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*words, *kept.columns], [*names, *kept.schema.names])


def packed_kmers(rows: DataFrame, k: int, column: str = "sequence") -> DataFrame:
    """The k-mers of each row's sequence (letters A to Z) as words of up to twelve residues, beside the row's other columns; none of a null or shorter sequence.

    Windows are made some at a time, so a long sequence is no more to hold than its text.
    """
    rest = [f"`{n}` {t}" for n, t in rows.dtypes if n != column]
    return rows.mapInArrow(lambda it: _packed(it, k, column), ", ".join([*[f"{n} long" for n in word_names(k)], *rest]))


def unpacked(k: int) -> Column:
    """The text of a packed k-mer."""
    letters = []
    for w, name in enumerate(word_names(k)):
        n = min(k - w * WORD, WORD)
        letters += [F.char(F.shiftright(F.col(name), 5 * (n - 1 - j)).bitwiseAND(F.lit(31)) + 64) for j in range(n)]
    return F.concat(*letters)


def packed_key(text: str) -> list[int]:
    """The words of a k-mer, to look it up."""
    out = []
    for a in range(0, len(text), WORD):
        value = 0
        for x in text[a : a + WORD].encode():
            value = value << 5 | x & 31
        out.append(value)
    return out
