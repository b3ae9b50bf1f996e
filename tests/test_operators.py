"""Operators, sources and transitions on small frames."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import ingest, integrity, jsonb, queue
from quarry.sources import raw, sinks
from quarry.streaming import counters

STATE = "id long, medium_hash string, ino long, copied boolean, blobid string, errors array<string>, claimed_by string, status string, error_type string, mime_type string"


@pytest.fixture(scope="module")
def state(spark):
    row = lambda i, copied, blob, errors, status, kind: (i, "m", i, copied, blob, errors, None, status, kind, None)
    return spark.createDataFrame([
        row(1, True, "a", [], "success", None), row(2, True, "b", [], "success", None), row(3, False, None, [], "pending", None), row(4, False, None, None, "pending", None),
        *(row(i, True, None, ["No such file"], "failed_retryable", "path_error") for i in (5, 6, 7)),
        row(8, True, None, ["Permission denied"], "failed_retryable", "permission_error"), row(9, True, None, ["odd"], "failed_retryable", "unknown"), row(10, True, None, ["I/O error"], "failed_permanent", "io_error"),
    ], STATE)


def counts(df):
    return {r[0]: r[1] for r in df.groupBy("status").count().collect()}


@pytest.mark.parametrize("message,exception,errno,kind", [
    ("[Errno 2] No such file or directory: 'x'", None, None, "path_error"), ("File name too long", None, None, "path_error"), ("Permission denied", None, None, "permission_error"), ("Input/output error", None, None, "io_error"),
    ("read beyond EOF", None, None, "io_error"), ("BLAKE3 mismatch", None, None, "hash_error"), ("?", "PermissionError", None, "permission_error"), ("?", "OSError", 5, "io_error"), ("?", "OSError", 2, "path_error"), (None, None, None, "unknown"), ("?", "OSError", 99, "unknown"),
])
def test_classify_error(spark, message, exception, errno, kind):
    df = spark.createDataFrame([(message, exception, errno)], "m string, e string, n int")
    got = df.select(c.classify_error(F.col("m"), F.col("e"), F.col("n")).alias("k")).select("k", c.failure_status(F.col("k"))).first()
    assert tuple(got) == (kind, "failed_permanent" if kind == "io_error" else "failed_retryable")


def test_resets(state):
    assert counts(state) == {"success": 2, "pending": 2, "failed_retryable": 5, "failed_permanent": 1}
    assert state.where(queue.resettable("path_error")).count() == 3
    assert counts(queue.reset_failures(state, "path_error")) == {"success": 2, "pending": 5, "failed_retryable": 2, "failed_permanent": 1}
    assert counts(queue.reset_failures(state)) == {"success": 2, "pending": 7, "failed_permanent": 1}
    assert counts(queue.reset_failures(state, medium="other")) == counts(state)


def test_outcomes(spark, state):
    done = queue.mark_success(queue.claim(state, 1, "w"), spark.createDataFrame([(3, "blob", "text/plain")], "id long, blob string, mime string"))
    assert [tuple(r) for r in done.where("id = 3").select("blobid", "status", "copied", "claimed_by", "mime_type").collect()] == [("blob", "success", True, None, "text/plain")]
    failed = spark.createDataFrame([(4, "Input/output error", "OSError")], "id long, message string, exception string")
    bad = queue.mark_failure(state.withColumn("claimed_by", F.lit("w")), failed).where("id = 4").first()
    assert (bad.errors, bad.status, bad.error_type, bad.claimed_by, bad.copied) == (["OSError: Input/output error"], "pending", None, None, False)
    end = queue.mark_classified(state, failed).where("id = 4").first()
    assert (end.errors, end.status, end.error_type, end.copied) == (None, "failed_permanent", "io_error", True)
    assert [r.id for r in queue.failures(state, "m").where("error_type = 'unknown'").collect()] == [9] and queue.failures(state, "other").count() == 0
    assert queue.claim(state, 1, "w").where("claimed_by = 'w'").select("id").collect()[0][0] == 3


def test_repeated_errors(spark):
    kind = "id long, copied boolean, errors array<string>, claimed_by string, status string, error_type string"
    df = spark.createDataFrame([(1, False, ["a", "a", "a"], None, "pending", None), (2, False, ["a", "b", "a"], None, "pending", None), (3, False, ["x"] * 4 + ["I/O error"], None, "pending", None), (4, False, None, None, "pending", None), (5, False, ["I/O error"] * 4 + ["odd"], None, "pending", None), (6, False, ["I/O error"] * 9, "w", "pending", None)], kind)
    assert [r[0] for r in queue.exclude_repeated(df).where("claimed_by like 'EXCLUDED%'").select("id").collect()] == [1, 6]
    assert queue.exclude_repeated(df.withColumn("errors", F.array(*[F.lit("OSError: bad: x")] * 3))).select("copied", "claimed_by").distinct().collect() == [(True, "EXCLUDED: persistent_failure: bad: x")]
    stopped = queue.give_up(df).where("claimed_by = 'MAX_RETRIES_EXCEEDED'").select("id", "copied", "status", "error_type").collect()
    assert [tuple(r) for r in stopped] == [(3, True, "failed_permanent", "io_error"), (5, True, "failed_retryable", "unknown")]  # 6 is claimed


def test_raw_records_keep_every_byte(spark, tmp_path):
    paths = [b"/a\xff", b"/cr\rlf\n", b'/q"uo\\te', b"/sep\x1cinside", b"/node_modules/x#", b"/plain"]
    records = [b"\x1c".join([b"f", b"1", str(7 if i > 3 else i).encode(), b"1", b"10", b"99", p]) for i, p in enumerate(paths)]
    (tmp_path / "x.raw").write_bytes(b"\0".join(records) + b"\0")
    staged = ingest.typed(raw.read_raw(spark, str(tmp_path / "x.raw")), "m")
    assert {bytes(r.path) for r in staged.collect()} == set(paths)
    assert ingest.inodes(staged).count() == 5
    marked = ingest.mark_excluded(staged.withColumn("exclude_reason", F.lit(None).cast("string")), ["node_modules", "", "# comment"], "path_text")
    assert marked.where("exclude_reason is not null").count() == 1
    assert ingest.drop_excluded(staged, [], "path_text").count() == 6


def test_leaf_paths(spark):
    df = spark.createDataFrame([("m", 1, p) for p in ("/a", "/a.x", "/a/b", "/a/b/c", "/z")], "medium_hash string, ino long, path string")
    assert {r.path for r in ingest.leaf_paths(df).collect()} == {"/a.x", "/a/b/c", "/z"}


def test_rescue_map(spark):
    lines = spark.createDataFrame([("# Mapfile",), ("0x0  +  1",), ("0x0  0x3E7  +",), ("0x3E7 0x1 -",)], "value string")
    assert tuple(raw.rescue_summary(raw.mapfile_rows(lines)).first()) == (999, 1000, 99.9, "incomplete")
    empty = raw.rescue_summary(raw.mapfile_rows(lines.limit(0))).first()
    assert tuple(empty) == (0, 0, 0.0, "failed")


def test_columns(spark):
    one = spark.range(1)
    value = lambda x: one.select(x).first()[0]
    assert value(c.log2_bucket(F.lit((1 << 48) - 1))) == 1 << 47
    assert value(c.filename(F.lit("/a/b.txt"))) == "b.txt" and value(c.parent_name(F.lit("/a/b.txt"))) == "a" and value(c.parent_name(F.lit("/b"))) is None
    assert [value(c.size_pretty(F.lit(n).cast("long"))) for n in (10239, 10240, 20 << 20)] == ["10239 bytes", "10 kB", "20 MB"]
    assert value(c.escape_path(F.lit("a\\b\nc\x1c"))) == "a\\\\b\\nc\\034"
    assert value(c.normalised_path(F.lit("p1:/mnt/x/y"), "/mnt/x")) == "/y"
    assert abs(value(c.smoothed(F.array(*map(F.lit, (1.0, 2.0))))) - 1.3) < 1e-12
    assert value(c.skip_permanently(F.array(F.lit("detected_io_error")), F.array(F.lit("dmesg:io_error")))) is True


def test_json(spark):
    doc = F.lit('{"a": 1, "b": null}')
    one = spark.range(1).select(jsonb.merge(doc, F.lit('{"a": [2]}')), jsonb.remove_key(doc, "a"), jsonb.append_event(F.lit(None), "e", F.lit('{"x": 1}')), jsonb.has_key(doc, "b"), jsonb.has_key(doc, "z")).first()
    assert one[0].replace(" ", "") in ('{"b":null,"a":[2]}', '{"a":[2],"b":null}') and one[1] == '{"b":null}' and one[2] == '{"e":[{"x":1}]}' and one[3] and not one[4]


def test_sinks(spark, tmp_path):
    at = str(tmp_path / "t")
    frame = lambda *r: spark.createDataFrame(list(r), "medium_hash string, v int")
    sinks.write_media(frame(("a", 1), ("b", 1)), at)
    sinks.write_media(frame(("a", 2)), at)
    assert {(r.medium_hash, r.v) for r in spark.read.parquet(at).collect()} == {("a", 2), ("b", 1)}
    assert sinks.insert_absent(frame(("a", 1)), frame(("a", 9), ("c", 3), ("c", 3)), ["medium_hash"]).count() == 2
    assert {tuple(r) for r in sinks.upsert(frame(("a", 1)), frame(("a", 2), ("b", 3)), ["medium_hash"], add=("v",)).collect()} == {("a", 3), ("b", 3)}
    with pytest.raises(ValueError):
        sinks.write_media(frame(("a", 1)), at, "other")


def test_log_source(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"stage": "load", "ts": 1, "rows": 5}\nnot json\n{"stage": "load", "ts": 2, "rows": 7}\n')
    log = raw.read_log(spark, str(tmp_path / "l.json"), "stage string, ts long, rows long")
    assert raw.last_rows(log, "load").first()[0] == "7" and raw.last_rows(log, "copy").first()[0] == "unknown"


def test_patterns_and_carved(spark, tmp_path):
    (tmp_path / "ignore").write_text("# comment\n\nnode_modules\n")
    assert raw.read_patterns(spark, str(tmp_path / "ignore")) == ["node_modules"]
    (tmp_path / "d").mkdir()
    for n in ("b", "a"):
        (tmp_path / "d" / n).write_text(n)
    assert [(r.ino, r.path[-1]) for r in raw.carved(spark, str(tmp_path / "d"), "m").orderBy("ino").collect()] == [(1, "a"), (2, "b")]


def test_verification(spark):
    blobs = spark.createDataFrame([("a" * 64, 1), ("b" * 64, None)], "blobid string, last_checked long")
    results = spark.createDataFrame([("a" * 64, True), ("b" * 64, False)], "blobid string, ok boolean")
    assert {r.last_checked for r in integrity.touch_verified(blobs, results, 9).collect()} == {9, None}
    assert integrity.violations(spark.createDataFrame([("f",), ("?",), (None,)], "k string"), "k", c.FS_TYPES).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).select((F.col("id") % 2).cast("string").alias("key"), F.lit(1).alias("delta")).write.parquet(str(tmp_path / "in" / str(i)))
        for f in (tmp_path / "in" / str(i)).glob("part-*"):
            f.rename(tmp_path / "in" / f.name)
    got = counters.queue_counts(spark.readStream.schema("key string, delta int").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in")))
    assert {(r.key, r.n) for r in got.collect()} == {("0", 15), ("1", 15)}


def test_mime_and_eta(spark):
    kinds = {b"": "application/x-empty", b"\x89PNG\r\n\x1a\n...": "image/png", b"plain text": "text/plain", b"a\x00b": "application/octet-stream", b"PK\x03\x04": "application/zip"}
    df = spark.createDataFrame([(bytearray(b), k) for b, k in kinds.items()], "b binary, k string")
    assert df.where(c.sniff_mime(F.col("b")) == F.col("k")).count() == len(kinds)
    assert spark.range(1).select(c.eta_seconds(F.lit(10), F.lit(30), F.lit(5.0)), c.eta_seconds(F.lit(0), F.lit(30), F.lit(5.0))).first()[:] == (10.0, None)


def test_backup_and_aging(spark):
    blobs = spark.createDataFrame([("a", None, True, None), ("b", None, None, None), ("x", False, None, 5)], "blobid string, external_copied boolean, external_copy_failed boolean, last_checked long")
    got = {r.blobid: tuple(r)[1:] for r in queue.mark_backup(blobs, spark.createDataFrame([("a", True), ("b", False)], "blobid string, ok boolean"), 9).collect()}
    assert got == {"a": (True, None, 9), "b": (None, True, None), "x": (False, None, 5)}
    kept, old = queue.old_events(spark.createDataFrame([(1,), (100,)], "day long"), 100)
    assert kept.count() == old.count() == 1


def test_refuse_failed_media_has_no_cap(spark):
    n = 100_050
    medium = spark.range(n).select(F.col("id").cast("string").alias("medium_hash"), F.lit("failed").alias("health"))
    inode = medium.select("medium_hash", F.lit(False).alias("copied"), F.lit(None).cast("string").alias("claimed_by"))
    assert queue.refuse_failed_media(inode, medium).where("copied and claimed_by = 'EXCLUDED: bad_health'").count() == n


def test_load(spark, tmp_path):
    """Raw records to inodes, paths and counts; hardlinks are one inode, and an inode whose paths are all excluded is done."""
    records = [("d", 1, "/"), ("f", 2, "/a"), ("f", 2, "/b"), ("f", 3, "/node_modules/x"), ("f", 4, "/c#"), ("f", 4, "/d"), ("l", 5, "/l")]
    (tmp_path / "x.raw").write_bytes(b"".join("\x1c".join([k, "1", str(i), "1", "10", "99", p]).encode() + b"\0" for k, i, p in records))
    inode, path, stats = ingest.load(raw.read_raw(spark, str(tmp_path / "x.raw")), "m", ["node_modules"])
    assert {(r.ino, r.copied, r.claimed_by) for r in inode.collect()} == {(1, True, "NON_FILE"), (2, False, None), (3, True, "EXCLUDED"), (4, False, None), (5, True, "NON_FILE")}
    assert tuple(ingest.load_counts(inode, path).first()) == ("m", 5, 2, 1, 2, 7, 2) and tuple(stats.first()) == ("m", 2, 5)
    at = str(tmp_path / "inode")
    assert sinks.copy_media(inode, at).where("same").count() == 1
    sinks.drop_medium(spark, at, "m")
    sinks.drop_medium(spark, at, "absent")
    assert not list((tmp_path / "inode").glob("medium_hash=*"))
    planned = queue.plan_batch(inode.withColumn("id", F.col("ino")), path, 1).select("ino", F.transform("paths", lambda x: x.cast("string")).alias("p")).collect()
    assert [(r.ino, r.p) for r in planned] == [(2, ["/a", "/b"])]


def test_search_projection(spark, tmp_path):
    paths = spark.createDataFrame([("m", "/x/%d.txt" % i) for i in range(20)], "medium_hash string, path string")
    for _ in range(2):  # a refresh replaces what was there
        sinks.refresh_search(paths, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("filename = '7.txt' and parent = 'x'").count() == 1


def test_reports_ids_and_enumeration(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b, \"c\"", 2)], "k string, n int")
    sinks.export_csv(rows, str(tmp_path / "r.csv"))
    sinks.export_json(rows, str(tmp_path / "r.json"))
    for name in ("r.csv", "r.json"):
        assert {tuple(r) for r in raw.read_report(spark, str(tmp_path / name), "k string, n int").collect()} == {("a", 1), ('b, "c"', 2)}
    assert {tuple(r) for r in sinks.keyed_json(rows, "n").collect()} == {("1", '{"k":"a","n":1}'), ("2", '{"k":"b, \\"c\\"","n":2}')}
    sinks.append_log(rows, str(tmp_path / "log"))
    sinks.append_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    (tmp_path / "ids").write_text(" x \n\ny\nx\nunknown\n")
    blobs = spark.createDataFrame([("x",), ("y",), ("z",)], "blobid string")
    assert {r.blobid for r in integrity.asked_blobs(blobs, raw.read_ids(spark, str(tmp_path / "ids"))).collect()} == {"x", "y"}
    (tmp_path / "tree" / "d").mkdir(parents=True)
    for n in ("b", "a", "c"):
        (tmp_path / "tree" / "d" / n).write_text(n * 3)
    found = raw.enumerated(spark, str(tmp_path / "tree")).orderBy("ino")
    assert [(r.ino, r.size, r.path[-1]) for r in found.collect()] == [("1", "3", "a"), ("2", "3", "b"), ("3", "3", "c")] and tuple(found.columns) == raw.FIELDS
    assert ingest.inodes(ingest.typed(found, "m")).count() == 3


def test_selection_and_results(spark):
    blobs = spark.createDataFrame([("a", 5), ("b", None), ("c", 1), ("d", None)], "blobid string, last_checked long")
    inode = spark.createDataFrame([("a", 1), ("c", 9), ("c", 2), ("z", 99), ("b", None)], "blobid string, processed long")
    pick = lambda mode, n, **how: [r.blobid for r in integrity.select_blobs(blobs, mode, n, inode=inode, **how).collect()]
    assert pick("oldest", 3) == ["b", "d", "c"] and pick("newest", 5) == ["c", "a"] and pick("never", 5) == ["b", "d"]
    assert pick("random", 2, share=0.0) == ["b", "d"] and set(pick("random", 4, share=1.0)) >= {"b", "d"}
    with pytest.raises(ValueError):
        integrity.select_blobs(blobs, "other", 1)
    paths = spark.createDataFrame([("a", "/1"), ("a", "/2"), ("b", "/3")], "blobid string, path string")
    got = {tuple(r) for r in integrity.verify(paths, spark.createDataFrame([("/1",), ("/3",)], "path string")).collect()}
    assert got == {("a", 2, 1, False), ("b", 1, 0, True)}
    assert {r.blobid for r in integrity.difference(blobs, inode, "blobid").collect()} == {"d"}
    backup = spark.createDataFrame([("a", True, None), ("b", False, True), ("c", None, None)], "blobid string, external_copied boolean, external_copy_failed boolean")
    assert [r.blobid for r in integrity.pending_backup(backup).collect()] == ["c"]


def test_orphans_are_added_to(spark):
    blobs = spark.createDataFrame([("a", 2)], "blobid string, n_hardlinks long")
    inode = spark.createDataFrame([("a", "success"), ("b", "success"), ("b", "success"), ("c", "pending"), (None, "success")], "blobid string, status string")
    assert {tuple(r) for r in queue.backfill_orphans(blobs, inode).collect()} == {("a", 2), ("b", 2)}
    assert {tuple(r) for r in queue.register_blobs(blobs, inode, counted=False).collect()} == {("a", 2), ("b", 0), ("c", 0)}


def files(spark, frame, at, n):
    """A folder of n files that a stream reads one at a time."""
    rows = frame.toArrow()
    at.mkdir()
    for i in range(n):
        a, z = i * len(rows) // n, (i + 1) * len(rows) // n
        pq.write_table(rows.slice(a, z - a), at / f"{i}.parquet")
        os.utime(at / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))  # a stream reads the oldest first
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(at))


def test_streams_over_several_batches(spark, tmp_path):
    rows = spark.createDataFrame([("ok", i % 2, "ok") for i in range(24)] + [("bad", 0, None)] * 6, "medium_hash string, ino long, health string")
    got = counters.drained(counters.retries(files(spark, rows, tmp_path / "a", 5), checkpoint=8, most=12, degraded=5), "r").collect()
    last = {(r.medium_hash, r.ino): (r.retries, r.action) for r in sorted(got, key=lambda r: r.retries)}
    assert last == {("ok", 0): (12, "give_up"), ("ok", 1): (12, "give_up"), ("bad", 0): (6, "give_up")}
    assert {r.action for r in got if r.medium_hash == "ok"} == {"retry", "diagnose", "give_up"}

    rates = spark.createDataFrame([("k%d" % (i % 2), i, float(i * i % 7)) for i in range(20)], "key string, at long, rate double")
    got = {(r.key, r.at): r.ema for r in counters.drained(counters.smoothed_rates(files(spark, rates, tmp_path / "b", 4)), "e").collect()}
    for key in ("k0", "k1"):
        ema = None
        for r in sorted((r for r in rates.collect() if r.key == key), key=lambda r: r.at):
            ema = r.rate if ema is None else 0.3 * r.rate + 0.7 * ema
            assert got[key, r.at] == pytest.approx(ema)

    results = spark.createDataFrame([("m", i % 3 == 0) for i in range(60)] + [("few", True)] * 5 + [("good", False)] * 60, "medium_hash string, failed boolean")
    flags = counters.error_rate_flags(files(spark, results, tmp_path / "c", 6), least=20).collect()
    assert [(r.medium_hash, r.processed >= 20, r.error_rate > 0.1) for r in flags] == [("m", True, True)]
    assert [r.medium_hash for r in queue.high_error_rate(results, least=20).collect()] == ["m"]


def test_polling_and_log_status(spark):
    left = [3, 0, 2, 0, 0, 0, 9]
    assert counters.until_idle(lambda: left.pop(0)) == 5 and left == [9]
    lines = spark.createDataFrame([("load", "start"), ("load", "done"), ("copy", "start"), ("copy", "failed"), ("copy", "done"), ("scan", "start")], "stage string, event string")
    assert {tuple(r) for r in counters.log_status(lines).collect()} == {("load", "done"), ("copy", "failed"), ("scan", "running")}


def test_more_columns(spark):
    value = lambda x: spark.range(1).select(x).first()[0]
    assert str(value(c.day_of(F.lit(1735689599)))) == "2024-12-31" and str(value(c.day_of(F.lit(1735689600)))) == "2025-01-01"
    assert value(c.content_hash(F.lit("abc"))).startswith("ba7816bf") and value(c.is_blob_id(c.content_hash(F.lit("abc"))))
    assert value(c.grandparent_name(F.lit("/a/b/c.txt"))) == "a" and value(c.grandparent_name(F.lit("/b/c"))) is None
    assert value(c.checkpoint_check(F.lit("Read beyond EOF"))) == "detected_beyond_eof" and value(c.checkpoint_check(F.lit("?"))) is None
    assert value(c.verified(F.lit(True), F.array(), F.lit(None))) is True and value(c.verified(F.lit(True), F.array(F.lit("x")), F.lit(None))) is False


def test_path_and_byte_forms(spark):
    value = lambda x: spark.range(1).select(x).first()[0]
    assert value(c.normalised_path(F.lit("p5:/mnt/h/Data\\r/x"), "/mnt", F.lit("h"))) == "/Data\r/x"
    assert value(c.escaped_bytes(F.lit(bytearray(b"a\\b\x00\xff")))) == "a\\\\b\\000\\377"
    assert value(c.identity(F.lit(0), F.lit("text"))).mime_type == c.EMPTY_TYPE and value(c.identity(F.lit(4), F.lit("text"))).mime_type == "text/plain"
    assert value(c.pretty_json(F.lit('{"a":1,"b":[2]}'))).count("\n") >= 3


def test_stored_catalog(spark, sf_dir, tmp_path):
    """The written catalog has the same rows, and a filter on the medium prunes folders."""
    from quarry.sources.catalog import Catalog

    plain = Catalog(spark, sf_dir)
    kept = plain.stored(str(tmp_path / "c"))
    for name in ("inode", "path", "blobs", "matrix"):
        a, b = getattr(plain, name), getattr(kept, name)
        assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
    plan = kept.inode.where("medium_hash = 'src3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(medium_hash" in plan


def test_json_elements_of_any_shape(spark):
    docs = [("a", '{"e":[{"ino":1,"x":{"y":2},"checks":["p","q"]},{"ino":"q"},5,null,[]]}'), ("b", "{bad"), ("c", None), ("d", '{"e":{"k":{"ino":7}}}'), ("f", "{}"), ("g", '{"e":3}'), ("h", "")]
    rows = spark.createDataFrame([(m, p, "v", 1) for m, p in docs], "m string, p string, v string, `a.b` int")
    found = jsonb.elements(rows, "p", "$.e")
    assert found.columns == ["m", "v", "a.b", "pos", "key", "value"]
    got = found.select("m", "pos", "key", F.to_json("value").alias("j"), jsonb.field(F.col("value"), "ino", "bigint").alias("ino"), jsonb.field(F.col("value"), "checks", "array<string>").alias("c"), jsonb.field(F.col("value"), "x.y", "int").alias("y")).collect()
    assert sorted((r.m, r.pos, r.key, r.ino, r.c, r.y) for r in got) == [("a", 0, None, 1, ["p", "q"], 2), ("a", 1, None, None, None, None), ("a", 2, None, None, None, None), ("a", 3, None, None, None, None), ("a", 4, None, None, None, None), ("d", 0, "k", 7, None, None)]
    assert [r.j for r in got if r.m == "a"][0] == '{"checks":["p","q"],"ino":1,"x":{"y":2}}'
    assert jsonb.elements(rows.limit(0), "p").count() == 0
