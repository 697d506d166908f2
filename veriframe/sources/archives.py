"""Uploaded archives as tables: ``spark.read.format("archive").option("paths", "a.zip\\nb.zip").load()``.

The driver reads each archive's central directory only, and makes partitions of consecutive members of ``partitionbytes`` (64 MB) at least,
so one large archive is read by many tasks, each of which seeks to its own members. Names that would leave the folder they are
unpacked to are refused: their contents are never read.

What can't be read is a row with a ``reason``: an archive that is broken ("corrupt zip: ...") or without files ("zip contained no
files") has one row without a member, an unsafe or broken member its own. Paths may be anything that pyarrow's file systems open (local
paths, URIs of object stores), and must be readable by the driver and the executors.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, size bigint, crc bigint, content binary, reason string"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def said(error: BaseException) -> str:
    return " ".join(f"{type(error).__name__}: {error}".split())[:300]


class Stream(io.RawIOBase):
    """A file of pyarrow as Python's own: a place outside it is an OSError."""

    def __init__(self, file: pa.NativeFile):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        return self.file.readinto(buffer)

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self.file.tell(), io.SEEK_END: self.file.size()}[whence]
        if start + offset < 0:
            raise OSError("a place before the file's beginning")
        return self.file.seek(min(start + offset, self.file.size()))


@contextmanager
def opened(path: str) -> Iterator[zipfile.ZipFile]:
    system, name = located(path)
    with system.open_input_file(name) as file, zipfile.ZipFile(io.BufferedReader(Stream(file), 1 << 20)) as archive:
        yield archive


def unsafe(name: str) -> str | None:
    """Why a member may not be unpacked, or None: both kinds of slashes separate, and a leading one doesn't count."""
    parts = name.replace("\\", "/").lstrip("/").split("/")
    if ":" in parts[0]:
        return f"unsafe path in upload: {name!r}"
    depth = 0
    for p in parts:
        depth += -1 if p == ".." else p not in ("", ".")
        if depth < 0:
            return f"path escapes upload dir: {name!r}"
    return None


@dataclass
class Members(InputPartition):
    path: str
    names: list[str]
    reason: str | None = None


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["paths"].split("\n") if p]
        self.bytes = int(options.get("partitionbytes", str(64 << 20)))

    def partitions(self) -> list[InputPartition]:
        return [part for path in self.paths for part in self.parts(path)]

    def parts(self, path: str) -> Iterator[Members]:
        try:
            with opened(path) as archive:
                files = [i for i in archive.infolist() if not i.filename.endswith("/")]
        except zipfile.BadZipFile as e:
            yield Members(path, [], f"corrupt zip: {e}")
            return
        except OSError as e:
            yield Members(path, [], said(e))
            return
        if not files:
            yield Members(path, [], "zip contained no files")
        names, size = [], 0
        for k, info in enumerate(files):
            names.append(info.filename)
            size += info.file_size
            if size >= self.bytes or k == len(files) - 1:
                yield Members(path, names)
                names, size = [], 0

    def read(self, partition: Members) -> Iterator[tuple]:
        if partition.reason:
            yield partition.path, None, None, None, None, partition.reason
            return
        with opened(partition.path) as archive:
            for name in partition.names:
                info = archive.getinfo(name)
                content, reason = None, unsafe(name)
                if reason is None:
                    try:
                        content = archive.read(info)
                    except Exception as e:  # noqa: BLE001  one broken member is a finding about it
                        reason = said(e)
                yield partition.path, name, info.file_size, info.CRC, content, reason
