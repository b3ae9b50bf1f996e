"""The content store, typing by first bytes, and BLAKE3 against the specification written plainly."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from quarry import plans
from quarry.functions import blake3
from quarry.functions import columns as c
from quarry.operators import queue
from quarry.sources import blobs

# Official ids of the bytes 0, 1, ... 250, 0, 1, ... by their number.
VECTORS = {
    0: "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262",
    1: "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213",
    1024: "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7",
    1025: "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444",
    2048: "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a",
}


def pattern(n):
    return bytes(i % 251 for i in range(n))


def plain(data):
    """BLAKE3 by recursion over the tree, one block at a time."""
    mask = 0xFFFFFFFF

    def compress(value, block, counter, length, flags):
        m = list(struct.unpack("<16I", block.ljust(64, b"\0")))
        v = [*value, *blake3.IV[:4], counter & mask, counter >> 32, length, flags]

        def g(a, b, c_, d, x, y):
            turn = lambda w, n: (w >> n | w << (32 - n)) & mask
            v[a] = (v[a] + v[b] + x) & mask
            v[d] = turn(v[d] ^ v[a], 16)
            v[c_] = (v[c_] + v[d]) & mask
            v[b] = turn(v[b] ^ v[c_], 12)
            v[a] = (v[a] + v[b] + y) & mask
            v[d] = turn(v[d] ^ v[a], 8)
            v[c_] = (v[c_] + v[d]) & mask
            v[b] = turn(v[b] ^ v[c_], 7)

        for _ in range(7):
            for k, at in enumerate([(0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15), (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14)]):
                g(*at, m[2 * k], m[2 * k + 1])
            m = [m[p] for p in blake3.PERMUTATION]
        return [v[i] ^ v[i + 8] for i in range(8)]

    def tree(part, first, root):
        if len(part) <= 1024:
            value, blocks = list(blake3.IV), [part[i : i + 64] for i in range(0, len(part), 64)] or [b""]
            for k, block in enumerate(blocks):
                last = k == len(blocks) - 1
                value = compress(value, block, first, len(block), (k == 0) | 2 * last | 8 * (last and root))
            return value
        n = (len(part) - 1) // 1024
        left = 1024 << (n.bit_length() - 1)
        both = tree(part[:left], first, False) + tree(part[left:], first + left // 1024, False)
        return compress(list(blake3.IV), struct.pack("<16I", *both), 0, 64, 4 | 8 * root)

    return struct.pack("<8I", *tree(data, 0, True)).hex()


def test_blake3_vectors():
    assert {n: blake3.digest(pattern(n)).hex() for n in VECTORS} == VECTORS
    assert all(plain(pattern(n)) == h for n, h in VECTORS.items())
    assert blake3.digest(b"abc").hex() == "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85"


def test_blake3_parts_and_batches(spark):
    r = random.Random(4)
    contents = [r.randbytes(n) for n in (0, 1, 63, 64, 65, 1023, 1024, 1025, 2047, 2049, 3072, 4096, 4097, 5000, 8192, 8193, 20_480, 31_745)] + [b"\0" * 1024, b""]
    want = [plain(x) for x in contents]
    rows = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(contents)] + [(99, None)], "id int, content binary").repartition(3)
    assert {r.id: r.b for r in rows.select("id", blake3.content_id(F.col("content")).alias("b")).collect()} == {99: None, **dict(enumerate(want))}
    for size in (1024, 4096):
        parts = [(i, k, bytearray(x[k * size : (k + 1) * size])) for i, x in enumerate(contents) for k in range(max(1, -(-len(x) // size)))]
        r.shuffle(parts)
        parts += parts[:5]  # a repeated part
        found = blake3.merge_parts(blake3.part_values(spark.createDataFrame(parts, "file int, part int, content binary"), size)).collect()
        assert {x.file: x.blobid for x in found} == dict(enumerate(want))
    with pytest.raises(ValueError):
        blake3.part_values(rows.select(F.col("id").alias("file"), F.lit(0).alias("part"), "content"), 3000)


def test_blake3_query(spark, sf_dir):
    got = plans.QUERIES["blake3_ids"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert len(got) == len(texts) and all(r.blobid == r.by_parts and r.n_bytes == len(texts[r.doc_id]) for r in got)
    short = [r for r in got if r.n_bytes < 3000][:25]
    assert short and all(plain(texts[r.doc_id]) == r.blobid for r in short)


def test_files_by_parts(spark, tmp_path):
    r = random.Random(9)
    contents = {"a/empty": b"", "a/small": r.randbytes(700), "b/one": r.randbytes(4096), "b/two": r.randbytes(4097), "c/many": r.randbytes(70_001)}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    asked = spark.createDataFrame([(n,) for n in [*contents, "c/many", "c/gone", None]], "path string")
    got = {x.file: (x.size, x.blobid) for x in blobs.file_ids(asked, f"file://{tmp_path}", 4096).collect()}
    assert got == {"c/gone": (None, None), **{n: (len(x), plain(x)) for n, x in contents.items()}}


CONTENTS = {
    "image/png": bytes.fromhex("89504E470D0A1A0A") + b"x" * 5000, "application/x-tar": b"\0" * 257 + b"ustar" + b"\0" * 99, "audio/x-wav": b"RIFF\0\0\0\0WAVEfmt ", "video/mp4": b"\0\0\0 ftypisom",
    "text/html": b"  \r\n<!DocType HTML><p>", "text/xml": b"<?xml version='1'?>", "text/x-shellscript": b"#!/bin/sh\n", "text/plain": "ümlaut <html>".encode(), "application/octet-stream": b"\x01\0\x02",
    "application/x-empty": b"", "application/gzip": bytes.fromhex("1F8B08"), "image/webp": b"RIFF\0\0\0\0WEBP",
}


def test_store_and_types(spark, tmp_path):
    ids = {kind: plain(x) for kind, x in CONTENTS.items()}
    late = b"a" * 2048 + b"\0"  # what comes after the first bytes is not looked at
    rows = [(ids[k], bytearray(x)) for k, x in CONTENTS.items()] + [("f" * 64, bytearray(late)), ("f" * 64, bytearray(late)), (None, bytearray(b"x")), ("e" * 64, None)]
    contents, root = spark.createDataFrame(rows, "blobid string, content binary"), f"file://{tmp_path}"
    first = blobs.store_blobs(contents, root).collect()
    assert len(first) == len(CONTENTS) + 1 and all(r.stored for r in first)
    at = tmp_path / blobs.blob_path(ids["image/png"])
    assert at.read_bytes() == CONTENTS["image/png"] and not list(tmp_path.rglob("*.part"))
    # a second run writes what is missing or was left short, and nothing else
    at.write_bytes(b"short")
    written = os.stat(tmp_path / blobs.blob_path(ids["text/xml"])).st_mtime_ns
    assert [r.blobid for r in blobs.store_blobs(contents, root).collect() if r.stored] == [ids["image/png"]]
    assert os.stat(tmp_path / blobs.blob_path(ids["text/xml"])).st_mtime_ns == written

    inode = [(i, b, None) for i, b in enumerate([*ids.values(), *ids.values(), "f" * 64, "0" * 64, None])] + [(500, ids["text/xml"], "kept/type")]
    inode = spark.createDataFrame(inode, "id int, blobid string, mime_type string")
    found = blobs.typed_blobs(inode, root)
    kinds = {r.blobid: (r.mime, r.outcome) for r in found.collect()}
    assert kinds == {"f" * 64: ("text/plain", "detected"), "0" * 64: (None, "missing"), **{b: (k, "empty" if k == "application/x-empty" else "detected") for k, b in ids.items()}}
    done = queue.backfill_mime(inode, found)
    types = {r.id: r.mime_type for r in done.collect()}
    assert types[500] == "kept/type" and types[0] == types[len(ids)] == "image/png" and types[2 * len(ids) + 1] is None
    heads = blobs.heads(inode, root).collect()
    assert max(len(r.head or b"") for r in heads) == c.HEAD and max(r.size or 0 for r in heads) > c.HEAD
