"""The content store: one file a blob, under two levels of its id, written once and read by its first bytes.

Executors open files by ``pyarrow.fs`` from the folder's URI (local, HDFS, S3, GCS),
so that a type needs ``HEAD`` bytes of a file and not the file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import blake3
from quarry.functions import columns as c
from quarry.sources.shared import ship


def blob_path(blobid: str) -> str:
    """Where a blob is below the store's folder."""
    return f"{blobid[:2]}/{blobid[2:4]}/{blobid}"


def _opened(root: str) -> tuple[files.FileSystem, str]:
    store, base = files.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    return store, base.rstrip("/")


def _write(store: files.FileSystem, at: str, content: bytes) -> None:
    """Whole or not at all: written beside its place and moved there."""
    beside = f"{at}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(beside) as out:
        out.write(content)
    store.move(beside, at)


def store_blobs(contents: DataFrame, root: str) -> DataFrame:
    """Store ``contents`` (blobid, content); (blobid, size, stored) of each distinct blob, ``stored`` false where it was there already.

    The job runs when the result is used.  A repeated task finds what its first try has
    written, so that losing an executor leaves no blob twice or by half.  Null ids or contents are left out.
    """
    ship(contents.sparkSession)
    rows = contents.where("blobid is not null and content is not null").select("blobid", F.col("content").cast("binary").alias("content")).dropDuplicates(["blobid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        for b in batches:
            new, sizes = [], []
            for blobid, content in zip(b.column(0).to_pylist(), b.column(1)):
                at, data = f"{base}/{blob_path(blobid)}", content.as_py()
                found = store.get_file_info(at)
                new.append(found.type != files.FileType.File or found.size != len(data))
                sizes.append(len(data))
                if new[-1]:
                    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    _write(store, at, data)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(new, pa.bool_())], names=["blobid", "size", "stored"])

    return rows.mapInArrow(run, "blobid string, size bigint, stored boolean")


def heads(ids: DataFrame, root: str, n: int = c.HEAD) -> DataFrame:
    """(blobid, size, head, error) of each distinct id: the first ``n`` bytes of its file and no more.

    A missing file has neither size nor head; one that cannot be read has the error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        for b in batches:
            names = b.column(0).to_pylist()
            found = store.get_file_info([f"{base}/{blob_path(x)}" for x in names])
            sizes, read, errors = [], [], []
            for info in found:
                size = head = error = None
                if info.type == files.FileType.File:
                    size = info.size
                    try:
                        with store.open_input_stream(info.path, buffer_size=None) as source:
                            head = source.read(n)
                    except OSError as e:
                        error = f"{type(e).__name__}: {e}"[:200]
                sizes.append(size), read.append(head), errors.append(error)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(read, pa.binary()), pa.array(errors, pa.string())], names=["blobid", "size", "head", "error"])

    ship(ids.sparkSession)
    return ids.select("blobid").where("blobid is not null").distinct().mapInArrow(run, "blobid string, size bigint, head binary, error string")


def typed_blobs(inode: DataFrame, root: str) -> DataFrame:
    """(blobid, mime, outcome) of the distinct blobs of inodes without a type: 'detected', 'empty', 'missing' or 'unreadable'."""
    lacking = inode.where("blobid is not null and mime_type is null")
    read = heads(lacking, root)
    outcome = F.when(F.col("size").isNull(), "missing").when(F.col("error").isNotNull(), "unreadable").when(F.col("size") == 0, "empty").otherwise("detected")
    return read.select("blobid", c.sniff_mime(F.col("head")).alias("mime"), outcome.alias("outcome"))


def file_ids(paths: DataFrame, root: str, part_bytes: int = blake3.PART) -> DataFrame:
    """(file, size, blobid) of files below ``root``, each distinct ``path`` once; those that are missing have neither.

    Sizes are asked for first; every part of ``part_bytes`` is then a row of its own, which a task reads by
    its range alone, so that a file of any size is hashed by all tasks and held by none.
    """
    blake3.checked_part(part_bytes)
    ship(paths.sparkSession)
    names = paths.select(F.col("path").alias("file")).where("file is not null").distinct()

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        for b in batches:
            found = store.get_file_info([f"{base}/{x}" for x in b.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.size if x.type == files.FileType.File else None for x in found], pa.int64())], names=["file", "size"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        for b in batches:
            for i in range(b.num_rows):  # a part is large
                name, part = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                with store.open_input_file(f"{base}/{name}") as source:
                    content = source.read_at(part_bytes, part * part_bytes)
                row = [b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([blake3.part_value(content, part, part_bytes)], pa.binary()), pa.array([blake3.digest(content) if part == 0 else None], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, names=["file", "part", "value", "alone"])

    sizes = names.mapInArrow(sized, "file string, size bigint")
    last = F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / part_bytes).cast("long"))
    parts = sizes.where("size is not null").select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    # dealt anew, so that the parts of one file are not one task's
    values = parts.repartition("file", "part").mapInArrow(read, "file string, part bigint, value binary, alone binary")
    return sizes.join(blake3.merge_parts(values), "file", "left")
