"""Raw records and file trees as Spark data sources (``spark.read.format``), in partitions that tasks read on their own.

``archive_raw``: files of NUL-terminated records, cut into byte ranges.  A record
belongs to the range in which it begins; a range that begins inside one skips to the
next NUL, and reads on past its end until its last record is whole.  So a file of any size
is read by many tasks, each record once.

``archive_tree``: what an enumeration writes, straight from a mounted tree: device, inode
number and links of every entry, so that hard links are found.  Each of a bounded number
of folders is a partition, walked by its task.

Register them with ``register(spark)``.  Both yield Arrow batches of the seven fields of
``raw.FIELDS`` as strings, bytes of paths as Latin-1, as ``raw.read_raw`` does.
"""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarry.sources.raw import FIELDS, SEPARATOR
from quarry.sources.shared import ship

SPLIT, READ, ROWS = 1 << 27, 1 << 22, 10_000
_SCHEMA = ", ".join(f"{f} string" for f in FIELDS)
_SEPARATOR = SEPARATOR.encode("latin-1")


@dataclass
class Range(InputPartition):
    """The records of a file that begin from ``start`` on and before ``end``."""

    file: str
    start: int
    end: int


def records(source, start: int, end: int, read: int = READ) -> Iterator[list[bytes]]:
    """Lists of the records of a random-access file that begin in the range; a last one without its NUL counts."""
    at, held, first = max(0, start - 1), b"", start > 0
    # a record that begins at ``start`` follows a NUL just before it
    begin = start  # where the record at the head of ``held`` begins
    while True:
        data = source.read_at(read, at)
        at += len(data)
        if first:
            cut = data.find(b"\0")
            if cut < 0:
                if not data or at >= end:
                    return
                continue
            begin = at - len(data) + cut + 1
            data, first = data[cut + 1 :], False
        if not data and at >= source.size():
            if held and begin < end:
                yield [held]
            return
        held += data
        whole, nul, rest = held.rpartition(b"\0")
        if not nul:
            if begin >= end:
                return
            continue
        out = []
        for record in whole.split(b"\0"):
            if begin >= end:
                break
            out.append(record)
            begin += len(record) + 1
        if out:
            yield out
        if begin >= end:
            return
        held = rest


def batch(rows: list[list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i].decode("latin-1") for r in rows], pa.string()) for i in range(len(FIELDS))], names=list(FIELDS))


class RawReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))
        if self.split < 1:
            raise ValueError("splitBytes is 1 at least")

    def _store(self) -> tuple[files.FileSystem, str]:
        return files.FileSystem.from_uri(self.path if "://" in self.path else f"file://{os.path.abspath(self.path)}")

    def partitions(self) -> list[Range]:
        store, at = self._store()
        found = store.get_file_info(at)
        if found.type == files.FileType.NotFound:
            raise FileNotFoundError(self.path)
        own = [found] if found.type == files.FileType.File else store.get_file_info(files.FileSelector(at, recursive=True))
        visible = sorted((x for x in own if x.type == files.FileType.File and not os.path.basename(x.path).startswith(("_", "."))), key=lambda x: x.path)
        return [Range(x.path, k, min(x.size, k + self.split)) for x in visible for k in range(0, x.size, self.split)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file
            return
        store, _ = self._store()
        with store.open_input_file(partition.file) as source:
            for part in records(source, partition.start, partition.end):
                rows = [f for f in (r.split(_SEPARATOR, len(FIELDS) - 1) for r in part) if len(f) == len(FIELDS)]
                for k in range(0, len(rows), ROWS):
                    yield batch(rows[k : k + ROWS])


class RawSource(DataSource):
    """Options: path (a file or folder), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "archive_raw"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> RawReader:
        return RawReader(self.options)


@dataclass
class Folder(InputPartition):
    """A folder below the root; ``deep`` if all below it belongs to the partition, else its own entries only."""

    path: bytes
    deep: bool


_KINDS = ((stat.S_ISREG, "f"), (stat.S_ISDIR, "d"), (stat.S_ISLNK, "l"), (stat.S_ISBLK, "b"), (stat.S_ISCHR, "c"), (stat.S_ISFIFO, "p"), (stat.S_ISSOCK, "s"))


def _entry(path: bytes) -> list[bytes] | None:
    try:
        x = os.lstat(path)
    except OSError:  # gone meanwhile
        return None
    kind = next((k for test, k in _KINDS if test(x.st_mode)), "?")
    return [kind.encode(), *(str(n).encode() for n in (x.st_dev, x.st_ino, x.st_nlink, x.st_size, int(x.st_mtime))), path]


def _listed(path: bytes) -> tuple[list[bytes], list[bytes]]:
    """(folders, other entries) of a folder in order; an unreadable one has none."""
    try:
        with os.scandir(path) as found:
            entries = sorted((e.path, e.is_dir(follow_symlinks=False)) for e in found)
    except OSError:
        return [], []
    return [p for p, d in entries if d], [p for p, d in entries if not d]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.most = os.fsencode(options["path"].removeprefix("file://")).rstrip(b"/") or b"/", int(options.get("folders", 200))

    def partitions(self) -> list[Folder]:
        """Folders are opened level by level until there are ``folders`` of them: only the upper levels are seen by the driver."""
        if not os.path.isdir(self.root):
            raise FileNotFoundError(os.fsdecode(self.root))
        closed, level = [], [self.root]
        while level and len(closed) + len(level) < self.most:
            below = [f for path in level for f in _listed(path)[0]]
            if len(closed) + len(level) + len(below) > self.most:
                break
            closed += level
            level = below
        return [Folder(p, False) for p in closed] + [Folder(p, True) for p in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        rows, todo = [], [partition.path]
        while todo:
            path = todo.pop()
            folders, others = _listed(path)
            for p in [path, *others]:
                entry = _entry(p)
                if entry and p != self.root:
                    rows.append(entry)
                if len(rows) >= ROWS:
                    yield batch(rows)
                    rows = []
            if partition.deep:
                todo += folders[::-1]
        if rows:
            yield batch(rows)


class TreeSource(DataSource):
    """Options: path (a folder that all executors mount), folders (partitions at most, 200)."""

    @classmethod
    def name(cls) -> str:
        return "archive_tree"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    for source in (RawSource, TreeSource):
        spark.dataSource.register(source)
