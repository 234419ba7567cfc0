"""Landed message frames as a Spark source and sink: what a live feed's collector leaves behind.

A frame is a message behind its length, four bytes, most significant first. Files of frames lie in one folder;
their names ascend in the order in which they were begun, and only the last may still grow.

    frames.register(spark)
    spark.readStream.format("frames").load(folder)     # file, at (byte of the frame), value
    messages.write.format("frames").mode("append").save(folder)

A stream's offset is a file and a byte in it, always between two frames: a frame that is written in
part belongs to the next batch. So a restart goes on at the byte where the last batch ended.
"""

from __future__ import annotations

import struct
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "file string, at long, value binary"
SUFFIX = ".frames"
BATCH_BYTES = 4 << 20
_HEAD = struct.Struct(">I")
_COLUMNS = pa.schema([("file", pa.string()), ("at", pa.int64()), ("value", pa.binary())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[tuple[str, int]]:
    """Name and size of each file of frames, in order."""
    system, folder = _opened(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith(SUFFIX))


def _whole(path: str, name: str, begin: int, size: int) -> int:
    """Where the last frame that is there as a whole ends, from a byte between two frames; reads lengths alone."""
    system, folder = _opened(path)
    with system.open_input_file(f"{folder}/{name}") as f:
        while begin + _HEAD.size <= size:
            f.seek(begin)
            head = f.read(_HEAD.size)
            after = begin + _HEAD.size + _HEAD.unpack(head)[0] if len(head) == _HEAD.size else size + 1
            if after > size:
                break
            begin = after
    return begin


@dataclass
class Stretch(InputPartition):
    """Bytes [begin, until) of a file; until the last whole frame if `until` is None."""

    name: str
    begin: int
    until: int | None

    def __post_init__(self):
        super().__init__(self.name)


def _read(path: str, stretch: Stretch | None) -> Iterator[pa.RecordBatch]:
    """Frames in batches of a few megabytes; one frame may be longer. Where there is no file Spark asks for None."""
    if stretch is None:
        return
    system, folder = _opened(path)
    at, places, values, size = stretch.begin, [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([stretch.name] * len(places)), pa.array(places, pa.int64()), pa.array(values, pa.binary())], schema=_COLUMNS)

    with system.open_input_stream(f"{folder}/{stretch.name}") as f:
        f.read(at)
        while stretch.until is None or at < stretch.until:
            head = f.read(_HEAD.size)
            if len(head) < _HEAD.size:
                break
            value = f.read(_HEAD.unpack(head)[0])
            if len(value) < _HEAD.unpack(head)[0]:
                break
            places.append(at)
            values.append(value)
            at, size = at + len(head) + len(value), size + len(value)
            if size >= BATCH_BYTES:
                yield batch()
                places, values, size = [], [], 0
    if places:
        yield batch()


class FramesReader(DataSourceReader):
    """One task for each file."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Stretch]:
        return [Stretch(name, 0, None) for name, _ in _files(self.path)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class FramesStream(DataSourceStreamReader):
    """Offsets: {"file": name of the last file, "at": byte behind its last whole frame}."""

    def __init__(self, path: str):
        self.path, self.seen = path, ("", 0)

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def latestOffset(self) -> dict:
        files = _files(self.path)
        if files:
            name, size = files[-1]
            begin = self.seen[1] if self.seen[0] == name else 0
            self.seen = name, _whole(self.path, name, begin, size)
        return {"file": self.seen[0], "at": self.seen[1]}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for name, size in _files(self.path):
            if start["file"] <= name <= end["file"]:
                begin = start["at"] if name == start["file"] else 0
                until = end["at"] if name == end["file"] else size
                if begin < until:
                    out.append(Stretch(name, begin, until))
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


@dataclass
class Written(WriterCommitMessage):
    draft: str | None


class FramesWriter(DataSourceWriter):
    """Each task writes a draft; once all are done they get names behind those that are there."""

    def __init__(self, path: str, column: int):
        self.path, self.column = path, column

    def write(self, iterator: Iterator) -> Written:
        system, folder = _opened(self.path)
        system.create_dir(folder, recursive=True)
        draft, some = f"{folder}/_{uuid.uuid4().hex}.draft", False
        with system.open_output_stream(draft) as out:
            for row in iterator:
                value = row[self.column]
                if value is not None:
                    out.write(_HEAD.pack(len(value)) + bytes(value))
                    some = True
        if not some:
            system.delete_file(draft)
        return Written(draft if some else None)

    def commit(self, messages: list[Written]) -> None:
        system, folder = _opened(self.path)
        names = _files(self.path)
        after = max(time.time_ns(), int(names[-1][0].split("-")[0]) + 1 if names else 0)
        for k, m in enumerate(m for m in messages if m is not None and m.draft):
            system.move(m.draft, f"{folder}/{after:020d}-{k:06d}{SUFFIX}")

    def abort(self, messages: list[Written]) -> None:
        system, _ = _opened(self.path)
        for m in messages:
            if m is not None and m.draft:
                system.delete_file(m.draft)


class FramesSource(DataSource):
    """Options: the folder, as the path. Writes the binary column `value`; NULLs are no message."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FramesReader:
        return FramesReader(self.options["path"])

    def streamReader(self, schema) -> FramesStream:
        return FramesStream(self.options["path"])

    def writer(self, schema, overwrite: bool) -> FramesWriter:
        if overwrite:
            raise ValueError("frames are appended; take a new folder to begin anew")
        return FramesWriter(self.options["path"], schema.names.index("value"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session; again, if need be."""
    try:
        spark.dataSource.register(FramesSource)
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
