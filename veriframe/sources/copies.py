"""Copies files to where a plan says: ``plan.write.format("copies").option("root", folder).mode("append").save()``.

plan has the columns ``path`` (the source) and ``target`` (relative to root), as `operators.filenames.organize_plan` makes them. A copy is
all or nothing: tasks copy into a staging folder of the job, the commit moves what is there to its targets, and an abort removes the
folder. What is at its target already is left alone, so a second run, or one after a broken commit, copies only what is missing, and
nothing if all is there. Attempts of one task write to names of their own, so that a lost or repeated attempt does no harm.

Paths and root may be anything that pyarrow's file systems open, and must be reachable from the driver and all executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from veriframe.sources.archives import located, unsafe

PIECE = 4 << 20


@dataclass
class Copied(WriterCommitMessage):
    #: (staged name, target) of what a task has copied, and how many targets were there already.
    moves: list[tuple[str, str]]
    skipped: int


class CopySink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "copies"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return CopyWriter(dict(self.options))


class CopyWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.root = options["root"].rstrip("/")
        self.staging = f".copies-{uuid.uuid4().hex}"

    def place(self) -> tuple[fs.FileSystem, str]:
        return located(self.root)

    def write(self, iterator: Iterator[Row]) -> Copied:
        system, root = self.place()
        moves, skipped = [], 0
        for row in iterator:
            if why := unsafe(row.target):
                raise ValueError(why)
            if exists(system, f"{root}/{row.target}"):
                skipped += 1
                continue
            staged = f"{root}/{self.staging}/{uuid.uuid4().hex}"
            system.create_dir(f"{root}/{self.staging}", recursive=True)
            source, name = located(row.path)
            with source.open_input_stream(name) as read, system.open_output_stream(staged) as out:
                while piece := read.read(PIECE):
                    out.write(piece)
            moves.append((staged, row.target))
        return Copied(moves, skipped)

    def commit(self, messages: list[Copied | None]) -> None:
        system, root = self.place()
        for message in messages:
            for staged, target in message.moves if message else []:
                to = f"{root}/{target}"
                if not exists(system, to):  # two rows may name one target: the first stays
                    system.create_dir(to.rsplit("/", 1)[0], recursive=True)
                    system.move(staged, to)
        self.remove(system, root)

    def abort(self, messages: list[Copied | None]) -> None:
        self.remove(*self.place())

    def remove(self, system: fs.FileSystem, root: str) -> None:
        if exists(system, f"{root}/{self.staging}"):
            system.delete_dir(f"{root}/{self.staging}")


def exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound
