"""The data sources: every record once whatever the cuts, hard links, odd names."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import ingest
from quarry.sources import raw, readers


class Memory:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]

    def size(self):
        return len(self.data)


@pytest.mark.parametrize("end", [b"", b"\0"])
def test_ranges(end):
    r = random.Random(3)
    want = [bytes(r.randrange(1, 256) for _ in range(r.choice([0, 0, 1, 3, 40]))) for _ in range(60)] + [b"last"]
    data = b"\0".join(want) + end
    for split in (1, 2, 3, 7, 64, 10_000):
        for read in (1, 5, 4096):
            found = [x for k in range(0, len(data), split) for part in readers.records(Memory(data), k, min(len(data), k + split), read) for x in part]
            assert found == want, (split, read)
    assert list(readers.records(Memory(b""), 0, 0)) == []


def test_raw_source(spark, tmp_path):
    r = random.Random(5)
    rows = [["f", "1", str(i // 2), "2", str(i), str(1_500_000_000 + i), "/a\x1cb/" + "".join(chr(r.randrange(1, 256)) for _ in range(r.randrange(0, 60)))] for i in range(3_000)]
    body = b"".join("\x1c".join(x).encode("latin-1") + b"\0" for x in rows)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.raw").write_bytes(body)
    (tmp_path / "in" / "b.raw").write_bytes(b"no record\0" + b"d\x1c1\x1c90000\x1c1\x1c0\x1c0\x1c/end")
    (tmp_path / "in" / "_skipped").write_bytes(body)
    (tmp_path / "in" / "c.raw").write_bytes(b"")
    readers.register(spark)
    read = spark.read.format("archive_raw").option("splitBytes", 10_000).load(str(tmp_path / "in"))
    assert read.rdd.getNumPartitions() > 10 and read.columns == list(raw.FIELDS)
    assert sorted(map(tuple, read.collect())) == sorted([*map(tuple, rows), ("d", "1", "90000", "1", "0", "0", "/end")])
    # the same as the text reader, and loadable
    one = spark.read.format("archive_raw").load(f"file://{tmp_path}/in/a.raw")
    same = one.where("not path like '%\x01%'")  # where the text reader ends a value
    assert same.exceptAll(raw.read_raw(spark, str(tmp_path / "in" / "a.raw"))).isEmpty() and one.count() == 3_000
    inode, path, _ = ingest.load(read, "m", [])
    assert inode.where("fs_type = 'f'").count() == 1_500 and path.count() == 3_001
    empty = spark.read.format("archive_raw").load(str(tmp_path / "in" / "c.raw"))
    assert empty.count() == 0
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("archive_raw").load(str(tmp_path / "nowhere")).count()


@pytest.mark.parametrize("folders", [1, 5, 200])
def test_tree_source(spark, tmp_path, folders):
    root = tmp_path / "tree"
    for name in ("a/b/c", "a/d", "e", "f/g"):
        (root / name).mkdir(parents=True)
    for k in range(30):
        (root / ["a/b/c", "a/d", "e", "f/g", "."][k % 5] / f"file{k}").write_bytes(b"x" * k)
    os.link(root / "a/b/c/file0", root / "e/linked")
    os.symlink("file4", root / "sym")
    open(os.path.join(os.fsencode(root), b"e/\xff\n\xe9"), "wb").close()
    os.mkfifo(root / "pipe")
    readers.register(spark)
    got = spark.read.format("archive_tree").option("folders", folders).load(str(root))
    rows = {r.path: r for r in got.collect()}
    want = {os.path.join(d, n) for d, ds, fs in os.walk(os.fsencode(root)) for n in ds + fs}
    assert {p.encode("latin-1") for p in rows} == want and got.count() == len(want)
    for p in want:
        s, own = os.lstat(p), rows[p.decode("latin-1")]
        assert (own.dev, own.ino, own.nlink, own.size, own.mtime) == tuple(str(int(x)) for x in (s.st_dev, s.st_ino, s.st_nlink, s.st_size, s.st_mtime))
    kinds = {p.rsplit("/", 1)[-1]: r.fs_type for p, r in rows.items()}
    assert (kinds["sym"], kinds["pipe"], kinds["a"], kinds["file3"]) == ("l", "p", "d", "f")
    # a hard link is one inode of two paths
    inode, path, _ = ingest.load(got, "m", [])
    linked = path.join(inode.where("nlink = 2 and fs_type = 'f'").select("ino"), "ino").groupBy("ino").agg(F.count("*").alias("n")).collect()
    assert [r.n for r in linked] == [2]
    assert got.rdd.getNumPartitions() <= max(1, folders)


def test_tree_without_a_folder(spark, tmp_path):
    readers.register(spark)
    with pytest.raises(Exception, match="gone"):
        spark.read.format("archive_tree").load(str(tmp_path / "gone")).count()
