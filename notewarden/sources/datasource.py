"""Folders of notes as a data source of Spark: ``spark.read.format("notes").load(root)`` and ``df.write.format("notes").mode(...).save(root)``.

Reading lists folder by folder and does not enter those that a scan leaves out; files are dealt to partitions by their bytes.  Writing puts each
note under its path below the root, with its source beside it, so notes of one base name in several folders stay apart.  A note is written under
another name and then moved, in the task that has its row: a reader sees all of it or nothing, and a task that is repeated puts the same files there.
Any file system that pyarrow opens by its address will do; notes() of sources.files reads what only Spark opens.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from notewarden.sources.files import SKIPPED

SCHEMA = "path string, file string, mtime timestamp, text string"
#: Bytes of a partition of files.
PARTITION_BYTES = 64 << 20
# --- fixed values: where the source of a note is kept ---
SOURCE_DIR = "源数据"
# --- end of fixed values ---


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there."""
    return fs.FileSystem.from_uri(root) if "://" in root else fs.FileSystem.from_uri(f"file://{posixpath.abspath(root)}")


def decoded(raw: bytes) -> str:
    """UTF-8 without a byte-order mark, with plain line ends."""
    return raw.decode("utf-8", "replace").removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n")


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        self.paths = paths


class NotesReader(DataSourceReader):
    def __init__(self, root: str, partition_bytes: int):
        self.root, self.partition_bytes = root, partition_bytes

    def _listed(self) -> Iterator[fs.FileInfo]:
        system, base = opened(self.root)
        folders = [base]
        while folders:
            for found in system.get_file_info(fs.FileSelector(folders.pop())):
                if found.type == fs.FileType.Directory:
                    if found.base_name not in SKIPPED:
                        folders.append(found.path)
                elif found.base_name.lower().endswith(".md"):
                    yield found

    def partitions(self) -> list[Files]:
        """Neighbouring files until a partition has its bytes; a larger file is one by itself."""
        out: list[list[str]] = []
        room = 0
        for found in sorted(self._listed(), key=lambda f: f.path):
            if not out or found.size > room:
                out.append([])
                room = self.partition_bytes
            out[-1].append(found.path)
            room -= found.size
        return [Files(paths) for paths in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, base = opened(self.root)
        for path in partition.paths:
            with system.open_input_stream(path) as f:
                text = decoded(f.read())
            rel = posixpath.relpath(path, base)
            yield rel, posixpath.basename(path), system.get_file_info(path).mtime, text


@dataclass
class Written(WriterCommitMessage):
    notes: int


class NotesWriter(DataSourceWriter):
    def __init__(self, root: str, names: list[str]):
        self.root, self.names = root, names

    def write(self, rows: Iterator) -> Written:
        system, base = opened(self.root)
        made, n = set(), 0
        for row in rows:
            values = dict(zip(self.names, row, strict=True))
            rel = posixpath.normpath(values["path"])
            if rel.startswith(("/", "../")) or rel in ("..", "."):
                raise ValueError(f"not a path below the folder: {values['path']}")
            parts = [(rel, values["text"])]
            if values.get("source"):
                folder, name = posixpath.split(rel)
                parts.append((posixpath.join(folder, SOURCE_DIR, name), values["source"]))
            for at, text in reversed(parts):  # the source first: a note that is there has its source
                target = posixpath.join(base, at)
                folder = posixpath.dirname(target)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                part = posixpath.join(folder, f".{uuid.uuid4().hex}")
                with system.open_output_stream(part) as f:
                    f.write((text or "").encode())
                system.move(part, target)
            n += 1
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        """Nothing is left to do: each note was put in its place by its task."""

    def abort(self, messages: list[Written | None]) -> None:
        """Notes that are complete stay, as in a rewrite that goes on later."""


class NotesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "notes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return NotesReader(self.options["path"], int(self.options.get("partitionbytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        names = [f.name for f in schema.fields]
        if not {"path", "text"} <= set(names):
            raise ValueError("notes have a path and a text")
        return NotesWriter(self.options["path"], names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NotesSource)
