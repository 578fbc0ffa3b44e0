"""Lines of files in the LZ4 frame format, read by runs of blocks and written in independent blocks.

Spark's text source knows another LZ4 format only.  Blocks of a frame say how long they
are and, unless the frame links them, unpack alone: a first pass reads those lengths and
cuts files into runs of blocks, a second one unpacks every run in a task of its own.  A
line belongs to the run in which the byte before it lies, so a run skips to its first
line and reads on until its last one ends.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..storage import exists, remove

#: Compressed bytes of a run, but for longer blocks and frames of linked ones.
RUN_BYTES = 16 << 20
#: Fixed values of the format: marks of frames, bits of the flags, kinds of block sizes.
FRAME, SKIPPED = 0x184D2204, range(0x184D2A50, 0x184D2A60)
INDEPENDENT, BLOCK_SUM, SIZE, FRAME_SUM, DICTIONARY = 0x20, 0x10, 0x08, 0x04, 0x01
STORED = 1 << 31
KINDS = {4: 64 << 10, 5: 256 << 10, 6: 1 << 20, 7: 4 << 20}
_ONES = (1 << 32) - 1
_RUN = pa.schema([("path", pa.string()), ("at", pa.int64()), ("to", pa.int64()), ("flags", pa.int32()), ("size", pa.int32())])


def _descriptor_byte(descriptor: bytes) -> int:
    """Second byte of the 32-bit xxHash of a short descriptor, which ends the head of a frame."""
    p1, p2, p3, p5 = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x165667B1  # fixed values of the hash
    h = (p5 + len(descriptor)) & _ONES
    for b in descriptor:
        h = (h + b * p5) & _ONES
        h = ((h << 11 | h >> 21) & _ONES) * p1 & _ONES
    for shift, by in ((15, p2), (13, p3)):
        h = (h ^ h >> shift) * by & _ONES
    return (h ^ h >> 16) >> 8 & 255


def _head(flags: int, size: int) -> bytes:
    own = bytes([flags, size])
    return FRAME.to_bytes(4, "little") + own + bytes([_descriptor_byte(own)])


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it of a path as Spark writes it, which is not escaped."""
    if path.startswith(("/", "file:")):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(quote(path, safe="/:@"))


def _open(path: str):
    """The file for random access."""
    fs, where = _place(path)
    return fs.open_input_file(where)


def _number(f, path: str, optional: bool = False) -> int | None:
    raw = f.read(4)
    if len(raw) < 4 and not (optional and not raw):
        raise ValueError(f"{path} ends within a frame")
    return int.from_bytes(raw, "little") if raw else None


@dataclass
class _Unit:
    """A block that unpacks alone, or a whole frame of linked ones."""

    at: int
    to: int
    flags: int
    size: int


def _units(f, path: str, at: int, flags: int, size: int) -> Iterator[_Unit]:
    """What follows the place `at`, which is a block of a frame with these flags, or a frame if they are 0."""
    total, linked = f.size(), None
    f.seek(at)
    while True:
        begin = f.tell()
        if not flags:
            mark = _number(f, path, optional=True)
            if mark is None:
                return
            if mark in SKIPPED:
                f.seek(_number(f, path) + f.tell())
                continue
            if mark != FRAME:
                raise ValueError(f"{path} has no frame at {begin}")
            flags, size = f.read(2).ljust(2, b"\0")
            if flags >> 6 != 1 or flags & DICTIONARY:
                raise ValueError(f"{path} has a frame of another version, or with a dictionary, at {begin}")
            f.seek(f.tell() + 1 + (8 if flags & SIZE else 0))
            linked = None if flags & INDEPENDENT else begin
            continue
        n = _number(f, path)
        if n == 0:
            end = f.tell() + (4 if flags & FRAME_SUM else 0)
            if linked is not None:
                yield _Unit(linked, end, 0, 0)
            flags, linked = 0, None
        else:
            end = f.tell() + (n & ~STORED) + (4 if flags & BLOCK_SUM else 0)
            if linked is None and end <= total:
                yield _Unit(begin, end, flags, size)
        if end > total:
            raise ValueError(f"{path} ends within a frame")
        f.seek(end)


class _Part(io.RawIOBase):
    """Some bytes of a file as a file."""

    def __init__(self, f, at: int, to: int):
        self.f, self.at, self.to = f, at, to

    def readable(self) -> bool:
        return True

    def readinto(self, b) -> int:
        self.f.seek(self.at)
        got = self.f.read(min(len(b), self.to - self.at))
        b[: len(got)] = got
        self.at += len(got)
        return len(got)


def _unpacked(f, u: _Unit) -> Iterator[bytes]:
    if u.flags:
        f.seek(u.at)
        alone = u.flags & (INDEPENDENT | BLOCK_SUM) | 0x40
        packed = _head(alone, u.size) + f.read(u.to - u.at) + bytes(4)
        with pa.CompressedInputStream(pa.BufferReader(packed), "lz4") as stream:
            yield stream.read()
    else:
        with pa.CompressedInputStream(pa.PythonFile(_Part(f, u.at, u.to), "r"), "lz4") as stream:
            while data := stream.read(4 << 20):
                yield data


def _runs(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of about so many bytes; of every file only the lengths of its blocks are read."""
    for batch in batches:
        for path in batch["path"].to_pylist():
            runs = [[path, 0, 0, 0, 0]]
            with _open(path) as f:
                for u in _units(f, path, 0, 0, 0):
                    if runs[-1][2] and u.to - runs[-1][1] > run_bytes:
                        runs.append([path, u.at, u.to, u.flags, u.size])
                    runs[-1][2] = u.to
            yield pa.RecordBatch.from_pylist([dict(zip(_RUN.names, r)) for r in runs], _RUN)


def _lines(data: Iterator[tuple[bytes, bool]], skip: bool) -> Iterator[list[bytes]]:
    """Whole lines of (bytes, whether they are behind the end of the run); skip: the run begins within a line of the one before."""
    rest: list[bytes] = []
    for piece, behind in data:
        if skip and behind:
            return  # no line begins here
        if skip:
            _, end, piece = piece.partition(b"\n")
            if not end:
                continue
            skip = False
        if behind:
            head, end, _ = piece.partition(b"\n")
            rest.append(head)
            if end:
                break
            continue
        *lines, last = piece.split(b"\n")
        if lines:
            lines[0] = b"".join([*rest, lines[0]])
            rest = []
            yield lines
        rest.append(last)
    else:
        if skip or not any(rest):
            return
    yield [b"".join(rest)]


def _texts(lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], ["value"])


def _run_data(f, path: str, at: int, to: int, flags: int, size: int) -> Iterator[tuple[bytes, bool]]:
    for u in _units(f, path, at, flags, size):
        for piece in _unpacked(f, u):
            yield piece, u.at >= to


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in batch.to_pylist():
            with _open(run["path"]) as f:
                yield from map(_texts, _lines(_run_data(f, **run), run["at"] > 0))


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch["content"]:
            with pa.CompressedInputStream(pa.BufferReader(content.as_buffer()), "lz4") as stream:
                yield from map(_texts, _lines(((d, False) for d in iter(lambda: stream.read(4 << 20), b"")), False))


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the workers' file systems know the store; Spark reads from more."""
    for batch in batches:
        for path in batch["path"].to_pylist():
            try:
                _open(path).close()
                known = True
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                known = False
            yield pa.RecordBatch.from_pylist([{"known": known}])


def read_lines(spark: SparkSession, path: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(value): lines of a file, folder or glob in the LZ4 frame format, in runs of about run_bytes compressed bytes.

    Frames that follow each other, empty files and stored blocks are read; a frame of
    linked blocks is one run, unpacked as a stream.  A file that ends within a frame,
    other versions and frames with a dictionary are errors.  Blocks with a checksum are
    verified; that of a whole frame only where its blocks are linked.  In a store that
    only Spark reads, a file is one task and at most 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    length = F.col("length")
    first, n = files.agg(F.min("path"), F.sum(F.floor(length / run_bytes) + 1)).first()
    if first is not None and not spark.createDataFrame([(first,)], "path string").mapInArrow(_reached, "known boolean").first().known:
        return files.select("content").mapInArrow(_read_whole, "value string")
    runs = files.select("path").mapInArrow(lambda it: _runs(it, run_bytes), "path string, at long, to long, flags int, size int")
    return runs.repartition(int(n or 1)).mapInArrow(_read, "value string")


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, still beside the table."""

    name: str
    lines: int


class Lz4Writer(DataSourceWriter):
    """A file a task, of independent blocks; files come to their place when all tasks are done."""

    def __init__(self, path: str, kind: int):
        self.path, self.kind, self.held = path.rstrip("/"), kind, f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.lz4"
        fs, top = _place(f"{self.path}/{self.held}")
        fs.create_dir(top)
        codec, size, held, lines = pa.Codec("lz4_raw"), KINDS[self.kind], bytearray(), 0
        with fs.open_output_stream(f"{top}/{name}", compression=None) as out:

            def block(data: bytes) -> None:
                packed = codec.compress(data, asbytes=True)
                n, packed = (len(packed), packed) if len(packed) < len(data) else (len(data) | STORED, data)
                out.write(n.to_bytes(4, "little") + packed)

            out.write(_head(INDEPENDENT | 0x40, self.kind << 4))
            for row in iterator:
                held += ("" if row.value is None else row.value).encode() + b"\n"
                lines += 1
                at = 0
                while len(held) - at >= size:
                    block(bytes(held[at : at + size]))
                    at += size
                if at:
                    del held[:at]
            if held:
                block(bytes(held))
            out.write(bytes(4))
        return Written(name, lines)

    def commit(self, messages: list[Written | None]) -> None:
        fs, top = _place(self.path)
        fs.create_dir(top)
        for m in messages:
            if m and m.lines:
                fs.move(f"{top}/{self.held}/{m.name}", f"{top}/{m.name}")
        self._clear()
        fs.open_output_stream(f"{top}/_SUCCESS").close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, held = _place(f"{self.path}/{self.held}")
        if fs.get_file_info(held).type != pafs.FileType.NotFound:
            fs.delete_dir(held)


def write_lines(df: DataFrame, path: str, kind: int = 7, mode: str = "errorifexists") -> None:
    """Rows of (value) as lines of .lz4 files under path, in independent blocks of KINDS[kind] bytes before packing, so that read_lines() splits them.

    A task that fails or runs twice leaves no file of its own; an empty table leaves an
    empty folder with the mark of success.  mode is errorifexists or overwrite.  The
    workers' file systems must reach path.
    """
    if mode not in ("errorifexists", "overwrite") or kind not in KINDS:
        raise ValueError(f"unknown mode {mode} or kind {kind}")
    spark = df.sparkSession
    if exists(spark, path):
        if mode == "errorifexists":
            raise FileExistsError(path)
        remove(spark, path)
    own = Lz4Writer(path, kind)

    class Lz4Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lz4_lines"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return own

    spark.dataSource.register(Lz4Lines)
    df.select("value").write.format("lz4_lines").mode("append").save()
