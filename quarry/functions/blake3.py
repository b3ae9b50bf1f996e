"""BLAKE3 ids of contents, vectorised over the chunks of many contents, and of huge files by parts.

A content is cut into chunks of 1,024 bytes, whose chaining values are the leaves of a
binary tree; a left subtree always has a power of two of chunks.  All chunks of a batch are compressed
at once, block by block, and all pairs of a level of all trees are merged at once.
A part of a file that begins at a multiple of its size, a power of two of chunks, is a
subtree, so that parts are hashed in any task and only their values, 32 bytes each, are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.shared import ship

# Fixed values of the specification: the initial words, the order of the message words in each following round, the flags.
IV = (0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19)
PERMUTATION = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
CHUNK_START, CHUNK_END, PARENT, ROOT = 1, 2, 4, 8
BLOCK, CHUNK, ROUNDS = 64, 1024, 7

AT_ONCE = 2048  # chunks that are compressed together: what a core's cache holds
PART = 1 << 26
HELD = 1 << 22  # bytes of parts that are hashed together


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return x >> np.uint32(n) | x << np.uint32(32 - n)


def _mix(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """The quarter round on four columns (or diagonals) at once; each argument is (4, n)."""
    a = a + b + x
    d = _turn(d ^ a, 16)
    c = c + d
    b = _turn(b ^ c, 12)
    a = a + b + y
    d = _turn(d ^ a, 8)
    c = c + d
    return a, _turn(b ^ c, 7), c, d


def compress(value: np.ndarray, words: np.ndarray, counter: np.ndarray, length: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """The next chaining values (8, n) of values (8, n) and message blocks (16, n)."""
    n = value.shape[1]
    a, b = value[:4], value[4:]
    c = np.repeat(np.array(IV[:4], np.uint32)[:, None], n, 1)
    d = np.stack([counter.astype(np.uint32), (counter >> np.uint64(32)).astype(np.uint32), length.astype(np.uint32), flags.astype(np.uint32)])
    for round_ in range(ROUNDS):
        if round_:
            words = words[list(PERMUTATION)]
        a, b, c, d = _mix(a, b, c, d, words[0:8:2], words[1:8:2])
        b, c, d = b[[1, 2, 3, 0]], c[[2, 3, 0, 1]], d[[3, 0, 1, 2]]
        a, b, c, d = _mix(a, b, c, d, words[8:16:2], words[9:16:2])
        b, c, d = b[[3, 0, 1, 2]], c[[2, 3, 0, 1]], d[[1, 2, 3, 0]]
    return np.concatenate([a ^ c, b ^ d])


def _chunk_values(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, number: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Chaining values (8, n) of the chunks raw[begin : begin + size] with their numbers in their contents."""
    out = np.empty((8, len(begin)), np.uint32)
    for k in range(0, len(begin), AT_ONCE):
        own = slice(k, k + AT_ONCE)
        n, first, alone = size[own], begin[own], root[own]
        whole = np.zeros((len(n), CHUNK), np.uint8)
        inside = np.arange(CHUNK) < n[:, None]
        whole[inside] = raw[(first[:, None] + np.arange(CHUNK))[inside]]
        words = np.ascontiguousarray(whole.view("<u4").reshape(len(n), CHUNK // BLOCK, 16).transpose(1, 2, 0)).astype(np.uint32, copy=False)
        value = np.repeat(np.array(IV, np.uint32)[:, None], len(n), 1)
        last = np.maximum(0, (n - 1) // BLOCK)
        for block in range(int(last.max()) + 1):
            who = np.flatnonzero(last >= block)
            ends = last[who] == block
            flags = np.where(ends, CHUNK_END, 0) | (CHUNK_START if block == 0 else 0) | np.where(ends & alone[who], ROOT, 0)
            value[:, who] = compress(value[:, who], words[block][:, who], number[own][who].astype(np.uint64), np.minimum(BLOCK, n[who] - BLOCK * block), flags)
        out[:, own] = value
    return out


def merge(values: np.ndarray, trees: np.ndarray, root: bool = True) -> np.ndarray:
    """The values (8, n) of trees whose leaves (8, m) stand one tree after the other, ``trees`` leaves each.

    Neighbours are merged level by level, an odd last one moves up.  A tree of one leaf is that leaf.
    """
    while (trees > 1).any():
        first = np.cumsum(trees) - trees
        pairs = trees // 2
        at = np.repeat(first - 2 * (np.cumsum(pairs) - pairs), pairs) + 2 * np.arange(pairs.sum())
        left = np.repeat(trees == 2, pairs)
        zero = np.zeros(len(at), np.uint64)
        joined = compress(np.repeat(np.array(IV, np.uint32)[:, None], len(at), 1), np.concatenate([values[:, at], values[:, at + 1]]), zero, zero + np.uint64(BLOCK), PARENT | np.where(left & root, ROOT, 0))
        odd = trees % 2 == 1
        place = np.concatenate([np.repeat(np.arange(len(trees)), pairs), np.flatnonzero(odd)])
        values = np.concatenate([joined, values[:, (first + trees - 1)[odd]]], 1)[:, np.argsort(place, kind="stable")]
        trees = pairs + odd
    return values


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, size, number in its content) of all chunks and the chunks of each content."""
    size = np.diff(offsets)
    n = np.maximum(1, -(-size // CHUNK))
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(offsets[:-1], n) + number * CHUNK
    return begin, np.minimum(CHUNK, np.repeat(offsets[1:], n) - begin), number, n


def digests(raw: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The 32-byte ids of the contents raw[offsets[i] : offsets[i + 1]]."""
    if len(offsets) < 2:
        return []
    begin, size, number, n = _spans(offsets)
    values = _chunk_values(raw, begin, size, number, np.repeat(n == 1, n))
    whole = np.ascontiguousarray(merge(values, n).T.astype("<u4")).tobytes()
    return [whole[32 * i : 32 * i + 32] for i in range(len(n))]


def digest(content: bytes) -> bytes:
    return digests(np.frombuffer(content, np.uint8), np.array([0, len(content)]))[0]


def values_of_parts(raw: np.ndarray, offsets: np.ndarray, parts: np.ndarray, part_bytes: int) -> list[bytes]:
    """The values of parts raw[offsets[i] : offsets[i + 1]] of files of several parts, with their numbers in their files; every part but a file's last has ``part_bytes``, a power of two of chunks."""
    if len(parts) == 0:
        return []
    begin, size, number, n = _spans(offsets)
    values = _chunk_values(raw, begin, size, number + np.repeat(parts, n) * (part_bytes // CHUNK), np.zeros(len(begin), bool))
    whole = np.ascontiguousarray(merge(values, n, root=False).T.astype("<u4")).tobytes()
    return [whole[32 * i : 32 * i + 32] for i in range(len(n))]


def part_value(content: bytes, part: int, part_bytes: int) -> bytes:
    return values_of_parts(np.frombuffer(content, np.uint8), np.array([0, len(content)]), np.array([part]), part_bytes)[0]


def merged(values: list[bytes]) -> bytes:
    """The id of a file out of the values of its parts, two at least."""
    leaves = np.frombuffer(b"".join(values), "<u4").reshape(-1, 8).T.astype(np.uint32)
    return np.ascontiguousarray(merge(leaves, np.array([len(values)])).T.astype("<u4")).tobytes()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def hex_digests(column: pa.Array) -> pa.Array:
    """Hexadecimal ids of a binary column; a null has none."""
    known = column.drop_null()
    found = iter([x.hex() for x in digests(*_buffers(known))] if len(known) else [])
    return pa.array([next(found) if valid else None for valid in column.is_valid().to_pylist()], pa.string())


def content_id(content: Column) -> Column:
    """BLAKE3 of a binary or string column, in 64 hexadecimal digits; null of a null."""
    ship(SparkSession.active())

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return hex_digests(column)

    return run(content.cast("binary"))


def checked_part(part_bytes: int) -> int:
    if part_bytes < CHUNK or part_bytes & (part_bytes - 1):
        raise ValueError("a part is a power of two of bytes, 1,024 at least")
    return part_bytes


def part_values(parts: DataFrame, part_bytes: int = PART) -> DataFrame:
    """(file, part, value, alone) of (file, part, content); ``alone`` is the id if the file has no other part."""
    checked_part(part_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            start, size = 0, pa.compute.binary_length(whole.column(2).cast(pa.large_binary())).to_numpy().astype(np.int64)
            ends = np.cumsum(size)
            while start < whole.num_rows:  # some megabytes at a time, one part at least
                end = max(start + 1, int(np.searchsorted(ends, ends[start] - size[start] + HELD, "right")))
                b = whole.slice(start, end - start)
                raw, off = _buffers(b.column(2))
                number = b.column(1).to_numpy()
                first = np.flatnonzero(number == 0)
                alone = dict(zip(first.tolist(), digests(*_buffers(b.column(2).take(pa.array(first)))) if len(first) else []))
                values = values_of_parts(raw, off, number, part_bytes)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(values, pa.binary()), pa.array([alone.get(i) for i in range(len(number))], pa.binary())], names=["file", "part", "value", "alone"])
                start = end

    ship(parts.sparkSession)
    rows = parts.where("content is not null").select("file", F.col("part").cast("long").alias("part"), F.col("content").cast("binary").alias("content"))
    return rows.mapInArrow(run, f"file {rows.schema['file'].dataType.simpleString()}, part bigint, value binary, alone binary")


def merge_parts(values: DataFrame) -> DataFrame:
    """(file, blobid) out of ``part_values``: 32 bytes for each part of a file meet in one task."""

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        own = group.drop_duplicates("part").sort_values("part")
        found = own["alone"].iloc[0] if len(own) == 1 else merged([bytes(x) for x in own["value"]])
        return pd.DataFrame({"file": [own["file"].iloc[0]], "blobid": [bytes(found).hex()]})

    return values.groupBy("file").applyInPandas(whole, f"file {values.schema['file'].dataType.simpleString()}, blobid string")
