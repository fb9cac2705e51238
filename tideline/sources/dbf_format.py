"""The dBASE table layout, as a Spark data source of raw records.

A task gets a range of records, reads those bytes and hands them to Spark as one
binary column.  Writing is the mirror image: each task writes complete table
files, which get their final names when the whole job has succeeded.
"""

from __future__ import annotations

import struct
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from tideline.sources import fixed_width, union
from tideline.sources.fixed_width import Field

# Header and field descriptor layout.
HEADER, DESCRIPTOR = "<BBBBIHH20x", "<11sc4xBB14x"
HEADER_SIZE = DESCRIPTOR_SIZE = 32
TABLE_VERSION, HEADER_END, FILE_END = 0x03, b"\r", b"\x1a"
BATCH_BYTES = 4 << 20
# A table's record count stands before its records, so a task holds the encoded
# records of one table; it starts the next table at this size.
TABLE_BYTES = 64 << 20


@dataclass(frozen=True)
class Header:
    records: int
    data_start: int
    record_length: int
    fields: tuple[Field, ...]


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_tables(path: str) -> list[str]:
    """Table files under a path (itself, if it is a file), in name order."""
    system, local = _open_fs(path)
    info = system.get_file_info(local)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    prefix = path[: len(path) - len(local)] if path.endswith(local) else ""
    found = system.get_file_info(fs.FileSelector(local))
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and f.base_name.lower().endswith(".dbf"))


def read_header(path: str) -> Header:
    system, local = _open_fs(path)
    with system.open_input_file(local) as f:
        _, _, _, _, records, data_start, record_length = struct.unpack(HEADER, f.read(HEADER_SIZE))
        described = f.read(data_start - HEADER_SIZE)
    fields = []
    for at in range(0, len(described) - DESCRIPTOR_SIZE + 1, DESCRIPTOR_SIZE):
        if described[at : at + 1] == HEADER_END:
            break
        name, kind, length, decimals = struct.unpack_from(DESCRIPTOR, described, at)
        fields.append(Field(name.split(b"\0")[0].decode("ascii", "replace"), kind.decode("ascii"), length, decimals))
    return Header(records, data_start, record_length, tuple(fields))


def header_bytes(fields: list[Field], records: int) -> bytes:
    # The date of last update is fixed so that equal data gives equal files.
    size = HEADER_SIZE + DESCRIPTOR_SIZE * len(fields) + 1
    length = 1 + sum(f.length for f in fields)
    head = struct.pack(HEADER, TABLE_VERSION, 0, 1, 1, records, size, length)
    described = b"".join(
        struct.pack(DESCRIPTOR, f.name.encode("ascii", "replace")[:10], f.kind.encode("ascii"), f.length, f.decimals)
        for f in fields
    )
    return head + described + HEADER_END


@dataclass
class RecordRange(InputPartition):
    path: str
    offset: int
    length: int
    count: int


class RecordReader(DataSourceReader):
    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path, per_task

    def partitions(self) -> list[RecordRange]:
        ranges = []
        for path in (file for part in self.path.split("\n") for file in list_tables(part)):
            head = read_header(path)
            for start in range(0, head.records, self.per_task):
                count = min(self.per_task, head.records - start)
                offset = head.data_start + start * head.record_length
                ranges.append(RecordRange(path, offset, head.record_length, count))
        return ranges or [RecordRange("", 0, 1, 0)]

    def read(self, part: RecordRange) -> Iterator[pa.RecordBatch]:
        if not part.count:
            return
        system, local = _open_fs(part.path)
        kind = pa.binary(part.length)
        per_batch = max(1, BATCH_BYTES // part.length)
        with system.open_input_file(local) as f:
            f.seek(part.offset)
            left = part.count
            while left > 0:
                data = f.read_buffer(min(per_batch, left) * part.length)
                whole = data.size // part.length
                if whole == 0:
                    break
                fixed = pa.Array.from_buffers(kind, whole, [None, data])
                files = pa.repeat(pa.scalar(part.path), whole)
                yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary()), files], names=["record", "file"])
                left -= whole


@dataclass
class Written(WriterCommitMessage):
    moves: list[tuple[str, str]]


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, fields: list[Field], overwrite: bool):
        self.path, self.fields, self.overwrite = path.rstrip("/"), fields, overwrite
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, local = _open_fs(self.path)
        system.create_dir(local, recursive=True)
        stem = f"part-{context.partitionId():05d}-{self.job}"
        length = 1 + sum(f.length for f in self.fields)
        moves: list[tuple[str, str]] = []
        held: list[pa.Buffer] = []

        def flush() -> None:
            name = f"{stem}-{len(moves):04d}.dbf"
            temporary = f"{local}/_{name}.{context.taskAttemptId()}"
            with system.open_output_stream(temporary) as out:
                out.write(header_bytes(self.fields, sum(b.size for b in held) // length))
                for data in held:
                    out.write(data)
                out.write(FILE_END)
            moves.append((temporary, f"{local}/{name}"))
            held.clear()

        for batch in batches:
            # The cast refuses records of another length.
            fixed = batch.column(0).cast(pa.binary(length))
            held.append(fixed.buffers()[1].slice(fixed.offset * length, len(fixed) * length))
            if sum(b.size for b in held) >= TABLE_BYTES:
                flush()
        if any(b.size for b in held):
            flush()
        return Written(moves)

    def commit(self, messages: list[Written | None]) -> None:
        system, local = _open_fs(self.path)
        infos = system.get_file_info(fs.FileSelector(local, allow_not_found=True))
        there = [f.path for f in infos if f.base_name.lower().endswith(".dbf")]
        old = there if self.overwrite else []
        moves = [move for m in messages if m for move in m.moves]
        for temporary, final in moves:
            system.move(temporary, final)
        if not moves and old == there:
            # No rows: a table without records keeps the fields.
            system.create_dir(local, recursive=True)
            with system.open_output_stream(f"{local}/part-00000-{self.job}-0000.dbf") as out:
                out.write(header_bytes(self.fields, 0) + FILE_END)
        for path in old:
            system.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = _open_fs(self.path)
        for m in messages:
            for temporary, _ in m.moves if m else ():
                system.delete_file(temporary)


class DbfRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dbf_records"

    def schema(self) -> str:
        return "record binary, file string"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"], int(self.options.get("recordsPerTask", 500_000)))

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        fields = [Field(n, k, int(w), int(d)) for n, k, w, d in (s.split(":") for s in self.options["fields"].split(";"))]
        return RecordWriter(self.options["path"], fields, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session.

    The classes travel to the workers by value, so the library need not be
    installed there.
    """
    from pyspark import cloudpickle

    for module in (sys.modules[__name__], fixed_width, union):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(DbfRecords)
