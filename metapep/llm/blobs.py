"""Arrays of many entries as few rows, so that a shuffle moves bytes and not rows.

A task groups its entries by bucket; each bucket's entries are one row of binary
columns.  Buckets are shuffled by Spark; their number follows the input, so that what
one task holds stays alike at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Entries that a task gathers before it sorts, merges and sends them.
FLUSH = 1_000_000


def grouped(bucket: np.ndarray, columns: dict[str, np.ndarray], extra: dict[str, int] | None = None) -> Iterator[pa.RecordBatch]:
    """One row a bucket: bucket, n, the extra constants, and the columns' bytes, in the given order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    last = np.r_[first[1:], len(b)]
    out = [pa.array(b[first].astype(np.int32)), pa.array((last - first).astype(np.int32))]
    out += [pa.array(np.full(len(first), v, np.int32)) for v in (extra or {}).values()]
    for x in columns.values():
        x = x[order]
        out.append(pa.array([narrow(x[i:j]) if x.dtype == np.int64 else x[i:j].tobytes() for i, j in zip(first, last)], pa.binary()))
    yield pa.RecordBatch.from_arrays(out, ["bucket", "n", *(extra or {}), *columns])


def narrow(x: np.ndarray) -> bytes:
    """int64 numbers as their least and 32-bit distances to it, or whole where they are too far apart."""
    low = x.min()
    far = int(x.max()) - int(low)
    return np.int64(low).tobytes() + ((x - low).astype(np.uint32) if far < 1 << 32 else x).tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    low = np.frombuffer(data, np.int64, 1)[0]
    return np.frombuffer(data, np.uint32, n, 8).astype(np.int64) + low if len(data) == 8 + 4 * n else np.frombuffer(data, np.int64, n, 8)


def prime_from(n: int) -> int:
    """The least prime of at least n."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n
