"""Exact dedup by counting quotient filters.

Every text without white space has a fingerprint.  Each task counts the fingerprints of
its rows in quotient filters, one for each range of leading bits; the filters of a range
are merged, by sorted remainders, in one task of bounded size.  A fingerprint that
counts one is of a text without copies.  The rows of all others are grouped by their
bytes, so a fingerprint that two texts share joins nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quotient_filter as Q
from .common import bounded_batches, cut, join_checked, stored

#: Bits of a fingerprint: with 10**10 texts one in 28,000 is compared in vain.
BITS = 48
#: Fingerprints that a task counts before it sends its filters, and those of a range, about.
FLUSH = 1_000_000
#: The characters that don't count, and the bytes that begin no character.
SPACE = b" \t\n\v\f\r"
_INSIDE = bytes(range(0x80, 0xC0))


def _hashed(batches: Iterator[pa.RecordBatch], bits: int, texts: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, n_chars, digest and fingerprint of each row, and its text without white space if asked for."""
    for batch in batches:
        raws = [x or b"" for x in batch["text"].cast(pa.large_binary()).to_pylist()]
        bare = [x.translate(None, SPACE) for x in raws]
        digests = [sha256(x).digest() for x in bare]
        chars = [len(x.translate(None, _INSIDE)) for x in raws]
        marks = [int.from_bytes(d[:8], "big") >> (64 - bits) for d in digests]
        out = {"doc_id": batch["doc_id"], "n_chars": pa.array(chars, pa.int64()), "digest": pa.array(digests, pa.binary()), "mark": pa.array(marks, pa.int64())}
        if texts:
            out["bare"] = pa.array(bare, pa.binary())
        yield pa.RecordBatch.from_pydict(out)


_ROW = "doc_id long, n_chars long, digest binary, mark long"


def _filters(batches: Iterator[pa.RecordBatch], bits: int, lead: int) -> Iterator[pa.RecordBatch]:
    """(bucket, filter): the fingerprints of a task by their leading bits."""

    def sent(marks: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = Q.summed(np.concatenate(marks).astype(Q.U64))
        bucket = (keys >> Q.U64(bits - lead)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, int)
        rest = keys & Q.U64((1 << (bits - lead)) - 1)
        made = [Q.build(rest[a:b], counts[a:b], bits - lead) for a, b in zip(first, np.r_[first[1:], len(keys)])]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(made, pa.binary())], ["bucket", "filter"])

    held, n = [], 0
    for batch in batches:
        held.append(batch["mark"].to_numpy(zero_copy_only=False))
        n += batch.num_rows
        if n >= FLUSH:
            yield sent(held)
            held, n = [], 0
    if n:
        yield sent(held)


def repeated_marks(marks: DataFrame, rows: int, bits: int) -> DataFrame:
    """(mark): the fingerprints that more than one row has, from the merged filters of all tasks."""
    least = max(int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // FLUSH))
    lead = min(bits - 2, (least - 1).bit_length())

    def merged(key: tuple, found: pa.Table) -> pa.Table:
        keys, counts = Q.entries(Q.merge(found["filter"].to_pylist(), bits - lead))
        high = Q.U64(key[0].as_py() << (bits - lead))
        return pa.table({"mark": pa.array((keys[counts > 1] | high).astype(np.int64))})

    made = marks.select("mark").mapInArrow(lambda it: _filters(it, bits, lead), "bucket long, filter binary")
    return made.groupBy("bucket").applyInArrow(merged, "mark long")


def dedup_exact(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.

    Texts are equal if they are identical without blanks, tabs and line ends (space and
    0x09 to 0x0D).  Of equal ones the row with the most code points stays, then the one
    with the smallest doc_id (no id comes last); of rows that repeat text and id one
    stays.  Null counts as empty, and empty texts are equal.  keep_id is the id of the
    row that stays, group_size the number of equal rows, itself included.  An empty
    table gives no rows; other columns are not read, so their names can't clash.  A text
    is read whole, and a worker holds a few times its bytes.

    What a task holds does not depend on a group's size: copies are counted in the
    tasks that read them, before any shuffle.
    """
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    bounded_batches(own)
    rows = own.mapInArrow(lambda it: _hashed(it, bits, False), _ROW)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    again = cut(repeated_marks(rows, rows.count(), bits))
    # compared by bytes; identical texts of a task are one row before they are sent
    texts = own.mapInArrow(lambda it: _hashed(it, bits, True), f"{_ROW}, bare binary")
    same = join_checked(texts, again, "mark", "left_semi").groupBy("mark", "digest", "bare")
    least = F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("not_id"))
    groups = same.agg(F.count("*").alias("n"), F.max(least).alias("best"))
    groups = cut(groups.filter("n > 1").select("digest", "n", "best"))
    inside = join_checked(rows, groups.select(F.col("digest")), "digest", "left_semi")
    first = F.max(F.struct(least.alias("best"), F.bitwise_not("row").alias("not_row")))
    stays = cut(inside.groupBy("digest").agg(first.alias("f")).select("digest", F.bitwise_not("f.not_row").alias("stay")))
    groups = groups.join(stays, "digest").select("digest", "n", F.bitwise_not("best.not_id").alias("keep"), "stay")
    out = join_checked(rows, cut(groups), "digest", "left")
    alone = F.col("n").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("stay"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
