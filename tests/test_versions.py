"""Versions of stored tables: changes in sequence, killed writes, two writers, counted loads."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.operators import queue
from quarry.sources import raw, store

INODE = "medium_hash string, id long, ino long, copied boolean, blobid string, mime_type string, status string, claimed_by string, errors array<string>, error_type string"


def inodes(spark, media, n=6):
    return spark.createDataFrame([(m, 100 * k + i, i, False, None, None, "pending", None, [], None) for k, m in enumerate(media) for i in range(n)], INODE)


@pytest.fixture
def kept(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    s.replace({"inode": inodes(spark, ["a", "b/c", "d=%"])})
    return s


def files(kept, medium):
    at = kept.version().tables["inode"]["media"][medium]["folder"]
    return {p.name: p.stat().st_mtime_ns for p in Path(kept.at.removeprefix("file://"), "data", at).glob("*.parquet")}


def test_claim_mark_and_upsert_in_sequence(spark, kept):
    assert kept.version().rows("inode") == {"a": 6, "b/c": 6, "d=%": 6}
    others = files(kept, "b/c"), files(kept, "d=%")
    kept.change(["a"], ("inode", lambda r: queue.claim(r, 2, "w")))
    batch = [r.id for r in kept.read("inode", ["a"]).where("claimed_by = 'w'").orderBy("id").collect()]
    assert batch == [0, 1]
    done = spark.createDataFrame([(0, "f" * 64, "text/plain")], "id long, blob string, mime string")
    failed = spark.createDataFrame([(1, "gone", "OSError")], "id long, message string, exception string")
    after = kept.change(["a"], ("inode", lambda r: queue.mark_failure(queue.mark_success(r, done), failed)))
    rows = {r.id: r for r in kept.read("inode").collect()}
    assert after.number == 3 and len(rows) == 18
    assert (rows[0].status, rows[0].blobid, rows[0].claimed_by) == ("success", "f" * 64, None) and rows[1].errors == ["OSError: gone"]
    # files of the media that were not touched are the same ones
    assert (files(kept, "b/c"), files(kept, "d=%")) == others
    # an earlier version is what it was
    assert kept.read("inode", version=kept.version(1)).where("status <> 'pending' or claimed_by is not null").isEmpty()

    stats = spark.createDataFrame([("a", 5, 6), ("b/c", 6, 6)], "medium_hash string, unclaimed_count long, total_count long")
    kept.upsert("queue_stats", stats, ["medium_hash"])
    kept.upsert("queue_stats", spark.createDataFrame([("b/c", -2, 6), ("x", 1, 1)], stats.schema), ["medium_hash"], add=("unclaimed_count",))
    assert sorted(map(tuple, kept.read("queue_stats").select("medium_hash", "unclaimed_count", "total_count").collect())) == [("a", 5, 6), ("b/c", 4, 6), ("x", 1, 1)]
    assert kept.version().rows("inode")["a"] == 6  # other tables came along


def test_a_write_that_dies_leaves_the_old_version(spark, kept):
    before = kept.version()

    def broken(rows):
        return rows.withColumn("id", F.when(F.col("ino") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))

    with pytest.raises(Exception, match="lost"):
        kept.change(["a", "b/c"], ("inode", broken))
    assert kept.version() == before and kept.read("inode").count() == 18
    # the writer is killed between its files and the manifest
    kept._publish = lambda *a: (_ for _ in ()).throw(KeyboardInterrupt())
    with pytest.raises(KeyboardInterrupt):
        kept.change(["a"], ("inode", lambda r: queue.claim(r, 1, "w")))
    del kept._publish
    assert kept.version() == before
    orphan = Path(kept.at.removeprefix("file://"), "data", "orphan")
    orphan.mkdir()
    assert kept.vacuum() == ["orphan"] and not orphan.exists() and kept.read("inode").count() == 18


def test_two_writers(spark, kept):
    other = store.Store(spark, kept.at)

    def meanwhile(media):
        def update(rows):
            if not done:
                done.append(other.change(media, ("inode", lambda r: queue.claim(r, 1, "other"))).number)
            return queue.claim(rows, 1, "own")

        done = []
        return update

    # another medium: both changes stand
    assert kept.change(["a"], ("inode", meanwhile(["b/c"]))).number == 3
    claimed = {(r.medium_hash, r.claimed_by) for r in kept.read("inode").where("claimed_by is not null").collect()}
    assert claimed == {("a", "own"), ("b/c", "other")}
    # the same medium: the change is made again on the newer rows, and takes the next row
    kept.change(["a"], ("inode", meanwhile(["a"])))
    assert sorted(r.claimed_by for r in kept.read("inode", ["a"]).where("claimed_by is not null").collect()) == ["other", "own", "own"]
    with pytest.raises(store.Conflict):
        kept.change(["a"], ("inode", meanwhile(["a"])), tries=1)


def test_emptied_dropped_and_absent_media(spark, kept):
    kept.change(["a"], ("inode", lambda r: r.where("false")))
    assert kept.version().rows("inode")["a"] == 0 and kept.read("inode", ["a"]).count() == 0 and kept.read("inode").count() == 12
    before = kept.version()
    assert kept.change(["nowhere"], ("inode", lambda r: r)) == before
    kept.drop(["b/c"])
    assert kept.version().media("inode") == ["a", "d=%"]
    assert len(kept.vacuum(keep=1)) == 1 or kept.read("inode").count() == 6
    assert kept.read("inode").count() == 6
    with pytest.raises(ValueError):
        kept.read("path")
    with pytest.raises(ValueError):
        kept.version(1)
    assert store.Store(spark, kept.at + "-none").version().number == 0
    with pytest.raises(ValueError, match="without a medium"):
        kept.replace({"inode": inodes(spark, ["q"]).withColumn("medium_hash", F.lit(None).cast("string"))})


def records(tmp_path, n):
    rows = [("d" if i % 10 == 0 else "f", 1, i // 2, 2, 10 * i, 1_500_000_000 + i, f"/x/{'node_modules' if i % 7 == 0 else 'y'}/file{i}") for i in range(n)]
    at = tmp_path / "m.raw"
    at.write_bytes(b"".join("\x1c".join(map(str, r)).encode() + b"\0" for r in rows))
    return str(at)


def test_load_is_held_against_the_log(spark, tmp_path):
    file, log = records(tmp_path, 500), tmp_path / "enum.jsonl"
    log.write_text("\n".join(json.dumps(x) for x in [{"stage": "enum_complete", "out": file, "rows": 3, "ts": "1"}, {"stage": "enum_complete", "out": file, "rows": 500, "ts": "2"}, {"stage": "enum_complete", "out": "z", "rows": 9, "ts": "3"}, {"stage": "enum_start", "out": file, "ts": "4"}]))
    events = raw.read_log(spark, str(log), "stage string, out string, rows long, ts string")
    assert store.announced_rows(events, file) == 500 and store.announced_rows(events, "unknown") is None
    kept = store.Store(spark, f"file://{tmp_path}/loaded")
    done = store.load_raw(kept, raw.read_raw(spark, file), "m", ["node_modules"], 500)
    assert done.rows("path") == {"m": 500} and done.rows("inode") == {"m": 250} and done.number == 1
    # a file that was cut short
    short = tmp_path / "short.raw"
    short.write_bytes(Path(file).read_bytes()[:5_000])
    with pytest.raises(store.CountMismatch, match="500 rows announced"):
        store.load_raw(kept, raw.read_raw(spark, str(short)), "m", ["node_modules"], 500)
    assert kept.version().number == 1 and kept.read("path").count() == 500 and len(list((tmp_path / "loaded" / "data").iterdir())) == 1
    # an unknown number is no test
    assert store.load_raw(kept, raw.read_raw(spark, str(short)), "n", [], None).media("path") == ["m", "n"]


def test_counts_come_from_the_write(spark, tmp_path):
    """Rows are computed once: the count of one medium's load reads nothing again."""
    kept, seen = store.Store(spark, f"file://{tmp_path}/once"), spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(1000).selectExpr("'m' as medium_hash", "id").mapInPandas(touch, "medium_hash string, id long")
    assert kept.replace({"t": rows}, 1000, "t").rows("t") == {"m": 1000}
    assert seen.value == 1000
