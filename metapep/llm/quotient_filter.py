"""Counting quotient filters in numpy: a multiset of fingerprints as a compact byte string.

A fingerprint of `bits` bits is a quotient (its leading bits) and a remainder.  Slots
hold the remainders of a quotient as a sorted run, at the quotient's own slot or behind
the runs before it; a remainder that occurs more than once is followed by slots with the
digits of its further occurrences.  Three bit vectors tell which quotients have a run,
where runs end, and which slots are digits.  Nothing is lost: entries() gives back every
fingerprint with its count, so filters of different sizes merge exactly.
"""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
_HEAD = struct.Struct("<BBQ")


def _shape(bits: int, q: int) -> tuple[int, int]:
    """Bits of a remainder and bytes of a slot."""
    return bits - q, (bits - q + 7) // 8


def build(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The filter of distinct sorted keys below 2**bits (bits: 2 to 56) with counts of 1 or more."""
    n = len(keys)
    q = min(bits - 1, max(1, n.bit_length()))
    r, width = _shape(bits, q)
    if not n:
        return _HEAD.pack(bits, q, 0) + bytes(((1 << q) + 7) // 8)
    keys = keys.astype(U64)
    quotient, base = (keys >> U64(r)).astype(np.int64), U64(8 * width)
    digits, more = np.zeros(n, np.int64), counts.astype(U64) - U64(1)
    while (live := more > 0).any():
        digits += live
        more = more >> base
    first = np.r_[True, quotient[1:] != quotient[:-1]]
    run = np.cumsum(first) - 1
    length = 1 + digits
    ends = np.cumsum(length)
    before = (ends - length)[first]
    start = np.maximum.accumulate(quotient[first] - before) + before
    at = start[run] + (ends - length) - before[run]
    run_length = np.diff(np.r_[before, ends[-1]])
    slots = max(1 << q, int(start[-1] + run_length[-1]))
    value, digit, run_end = np.zeros(slots, U64), np.zeros(slots, bool), np.zeros(slots, bool)
    value[at] = keys & U64((1 << r) - 1)
    run_end[start + run_length - 1] = True
    more, k = counts.astype(U64) - U64(1), 1
    while (live := more > 0).any():
        value[at[live] + k] = more[live] & U64((1 << 8 * width) - 1)
        digit[at[live] + k] = True
        more, k = more >> base, k + 1
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    rest = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return _HEAD.pack(bits, q, slots) + b"".join(np.packbits(x).tobytes() for x in (occupied, run_end, digit)) + rest.tobytes()


def entries(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of a filter."""
    bits, q, slots = _HEAD.unpack_from(data)
    r, width = _shape(bits, q)
    raw, at = np.frombuffer(data, np.uint8), _HEAD.size

    def vector(n: int) -> np.ndarray:
        nonlocal at
        size = (n + 7) // 8
        at += size
        return np.unpackbits(raw[at - size : at], count=n).view(bool)

    occupied = np.flatnonzero(vector(1 << q))
    if not slots:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    run_ends, digit = np.flatnonzero(vector(slots)), vector(slots)
    value = np.zeros((slots, 8), np.uint8)
    value[:, :width] = raw[at : at + slots * width].reshape(slots, width)
    value = value.view("<u8").ravel().astype(U64)
    # the k-th run belongs to the k-th quotient that has one
    start = np.maximum(occupied, np.r_[0, run_ends[:-1] + 1])
    slot = np.arange(slots)
    run = np.minimum(np.searchsorted(run_ends, slot), len(run_ends) - 1)
    used = (slot >= start[run]) & (slot <= run_ends[run])
    item = np.flatnonzero(used & ~digit)
    keys = (occupied[run[item]].astype(U64) << U64(r)) | value[item]
    more, step = np.zeros(len(item), U64), 0
    place = item + 1
    live = (place < slots) & digit[np.minimum(place, slots - 1)]
    while live.any():
        more[live] |= value[place[live]] << U64(step)
        step += 8 * width
        place = place + 1
        live &= (place < slots) & digit[np.minimum(place, slots - 1)]
    return keys, more.astype(np.int64) + 1


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys.astype(U64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums = np.diff(np.r_[first, len(keys)]) if counts is None else np.add.reduceat(counts[order], first)
    return keys[first], sums.astype(np.int64)


def merge(filters: list[bytes], bits: int) -> bytes:
    """One filter for all: sorted remainders of a quotient run together, equal ones add their counts."""
    parts = [entries(f) for f in filters]
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, U64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    return build(*summed(keys, counts), bits)
