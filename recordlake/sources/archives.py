"""Members of zip archives as rows of lines, read by ranges: no archive is held in a cell, and members are dealt over tasks."""

from __future__ import annotations

import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Extensions of archive members that hold records.
MEMBERS = (".txt", ".dat", ".csv")
#: Lines, and bytes of lines, that leave a reading task at a time.
BATCH_LINES, BATCH_BYTES = 50_000, 16 << 20
#: Packed bytes of members that a task reads; a larger member is a task of its own.
TASK_BYTES = 32 << 20
CHUNK = 1 << 20
#: Archives whose lists of members are read at a time.
LISTERS = 16
SCHEMA = "path string, member string, member_no int, line_no long, line binary, error string"
#: What a broken archive or member raises.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, struct.error, OSError, pa.ArrowInvalid)


@dataclass(frozen=True)
class Member:
    """Where a member's packed bytes are, and what they must come to; or why its archive has none."""

    path: str
    name: str | None = None
    no: int = 0
    offset: int = 0
    packed: int = 0
    size: int = 0
    crc: int = 0
    method: int = 0
    encrypted: bool = False
    error: str | None = None


def members(path: str, file: BinaryIO) -> list[Member]:
    """The text members of an archive, from its directory at the end; an archive that has none or is broken is one with an error."""
    try:
        found = [i for i in zipfile.ZipFile(file).infolist() if i.filename.lower().endswith(MEMBERS)]
    except BROKEN as e:
        return [Member(path, error=f"{type(e).__name__}: {e}")]
    out = [Member(path, i.filename, k, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, bool(i.flag_bits & 1)) for k, i in enumerate(found)]
    return out or [Member(path, error="no text member")]


def unpacked(file: BinaryIO, m: Member) -> Iterator[bytes]:
    """Bytes of a member, a chunk at a time; raises at the end if they are not those that the directory promises."""
    if m.encrypted:
        raise RuntimeError(f"{m.name} is encrypted")
    if m.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise NotImplementedError(f"compression {m.method} of {m.name}")
    file.seek(m.offset)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile(f"no header of {m.name}")
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(m.offset + 30 + name + extra)
    inflate = zlib.decompressobj(-15) if m.method == zipfile.ZIP_DEFLATED else None
    left, crc, size = m.packed, 0, 0
    while left:
        raw = file.read(min(CHUNK, left))
        if not raw:
            raise EOFError(f"{m.name} breaks off")
        left -= len(raw)
        while raw:
            data = inflate.decompress(raw, 4 * CHUNK) if inflate else raw
            raw = inflate.unconsumed_tail if inflate else b""
            crc, size = zlib.crc32(data, crc), size + len(data)
            yield data
    data = inflate.flush() if inflate else b""
    if data:
        crc, size = zlib.crc32(data, crc), size + len(data)
        yield data
    if size != m.size or crc != m.crc:
        raise zipfile.BadZipFile(f"Bad CRC-32 for file {m.name!r}")


def lines_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Lines that end with LF, without CR and LF at their ends."""
    rest: list[bytes] = []
    for data in chunks:
        first, *more = data.split(b"\n")
        rest.append(first)
        for line in more:
            yield b"".join(rest).rstrip(b"\r\n")
            rest = [line]
    last = b"".join(rest)
    if last:
        yield last.rstrip(b"\r\n")


def read_member(file: BinaryIO | None, m: Member, sure: bool) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA of a member; what is broken is a row with an error.

    sure: a member is read twice, and lines leave only if it is whole. Else those before the break have left already.
    """
    if m.error or file is None:
        yield _batch(m, 0, [None], m.error or "cannot be opened")
        return
    try:
        if sure:
            for _ in unpacked(file, m):
                pass
        first, held, n = 1, [], 0
        for line in lines_of(unpacked(file, m)):
            held.append(line)
            n += len(line)
            if len(held) == BATCH_LINES or n >= BATCH_BYTES:
                yield _batch(m, first, held)
                first, held, n = first + len(held), [], 0
        if held:
            yield _batch(m, first, held)
    except BROKEN as e:
        yield _batch(m, 0, [None], f"{type(e).__name__}: {e}")


def _batch(m: Member, first: int, lines: list[bytes | None], error: str | None = None) -> pa.RecordBatch:
    n = len(lines)
    return pa.record_batch(
        {
            "path": pa.array([m.path] * n), "member": pa.array([m.name] * n, pa.string()), "member_no": pa.array([m.no] * n, pa.int32()), "line_no": pa.array(range(first, first + n), pa.int64()),
            "line": pa.array(lines, pa.binary()), "error": pa.array([error] * n, pa.string()),
        }
    )


def opened(path: str) -> BinaryIO:
    """A file that can be read at any place, by whatever pyarrow knows of the path's scheme."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, at = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    return system.open_input_file(at)


def can_open(path: str) -> bool:
    try:
        opened(path).close()
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


class _Task(InputPartition):
    def __init__(self, own: list[Member]):
        super().__init__(None)
        self.own = own


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], sure: bool, task_bytes: int):
        self.paths, self.sure, self.task_bytes = paths, sure, task_bytes

    def partitions(self) -> list[InputPartition]:
        """Directories are read by some threads of the driver, a few ranges of each archive; members are dealt in their order."""

        def listed(path: str) -> list[Member]:
            try:
                with opened(path) as file:
                    return members(path, file)
            except OSError as e:
                return [Member(path, error=f"{type(e).__name__}: {e}")]

        with ThreadPoolExecutor(LISTERS) as pool:
            every = [m for own in pool.map(listed, self.paths) for m in own]
        tasks, held, n = [], [], 0
        for m in every:
            if held and n + m.packed > self.task_bytes:
                tasks.append(_Task(held))
                held, n = [], 0
            held.append(m)
            n += m.packed
        return [*tasks, _Task(held)] if held else [_Task([])]

    def read(self, partition: _Task) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for m in partition.own:
            if m.path != path and m.error is None:
                if file is not None:
                    file.close()
                path, file = m.path, opened(m.path)
            yield from read_member(file, m, self.sure)
        if file is not None:
            file.close()


class ZipLines(DataSource):
    """Format zip_lines. Options: paths (a JSON list), sure (whether broken members give no lines at all), taskbytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["paths"]), self.options.get("sure", "false") == "true", int(self.options.get("taskbytes", TASK_BYTES)))


def zip_lines(spark: SparkSession, paths: list[str], sure: bool = False, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows of SCHEMA of the text members of archives."""
    spark.dataSource.register(ZipLines)
    return spark.read.format("zip_lines").option("paths", json.dumps(sorted(paths))).option("sure", str(sure).lower()).option("taskbytes", task_bytes).load()
