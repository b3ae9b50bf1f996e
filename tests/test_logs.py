"""Streams over logs, over several batches and a restart."""

import json
import time

from pyspark.sql import functions as F

from quarry.streaming import logs


def add(folder, name, rows):
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows) + "\n")


def drain(frame, sink, state):
    frame.writeStream.foreachBatch(sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def test_status_of_a_log_that_grows(spark, tmp_path):
    folder, seen = tmp_path / "log", []
    folder.mkdir()

    def sink(batch, number):
        seen.append(sorted(map(tuple, batch.collect())))

    def run():
        drain(logs.status_changes(logs.tailed(spark, str(folder))), sink, str(tmp_path / "state"))

    add(folder, "a.jsonl", [{"stage": "copy", "event": "running"}, {"stage": "copy", "event": "step"}, {"stage": "enum", "event": "done"}, "{broken", {"event": "failed"}])
    run()
    add(folder, "b.jsonl", [{"stage": "copy", "event": "running"}])
    run()  # a restart: nothing new to tell
    add(folder, "c.jsonl", [{"stage": "copy", "event": "failed"}, {"stage": "enum", "event": "running"}])
    run()
    add(folder, "d.jsonl", [{"stage": "copy", "event": "done"}])
    run()
    assert [x for x in seen if x] == [[("copy", "running", 2), ("enum", "done", 1)], [("copy", "failed", 4)]]


def test_rows_are_held_until_there_are_enough(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    source = spark.readStream.schema("medium string, id long").json(str(folder))

    def sink(batch, number):
        seen.extend((r.key, r.n, [x["id"] for x in json.loads(r.rows)]) for r in batch.collect())

    def run(enough):
        running = logs.gathered(source, "medium", size=10, wait_ms=3_600_000).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second").start()
        try:
            until = time.time() + 40
            while sum(n for _, n, _ in seen) < enough and time.time() < until:
                time.sleep(0.5)
        finally:
            running.stop()

    add(folder, "1.json", [{"medium": "a", "id": i} for i in range(7)] + [{"medium": "b", "id": i} for i in range(25)])
    run(20)
    assert sorted((k, n) for k, n, _ in seen) == [("b", 10), ("b", 10)]
    add(folder, "2.json", [{"medium": "a", "id": i} for i in range(7, 11)])
    run(30)  # a restart goes on with what was held
    assert [sorted(ids) for k, n, ids in seen if k == "a"] == [list(range(10))] or sum(n for k, n, _ in seen if k == "a") == 10
    assert len({(k, i) for k, _, ids in seen for i in ids}) == 30


def test_rows_go_out_after_a_while(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    add(folder, "1.json", [{"medium": "a", "id": 1}, {"medium": "a", "id": 2}])
    held = logs.gathered(spark.readStream.schema("medium string, id long").json(str(folder)), "medium", size=10, wait_ms=500)
    running = held.writeStream.foreachBatch(lambda b, n: seen.extend(tuple(r) for r in b.select("key", "n").collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 60
        while not seen and time.time() < until:
            time.sleep(0.5)
    finally:
        running.stop()
    assert seen == [("a", 2)]


def test_rotation(spark, tmp_path):
    now = [1_000.0]
    at = f"file://{tmp_path}/log"
    log = lambda: logs.RotatingLog(spark, at, most_bytes=2_000, most_seconds=100, keep_seconds=500, clock=lambda: now[0])  # noqa: E731  a new object is a restart
    rows = lambda k, n: spark.range(n).select(F.lit(k).alias("k"), "id")
    log().write(rows(0, 5), 0)
    log().write(rows(1, 5), 1)
    assert len(log().segments()) == 1
    log().write(rows(1, 5), 1)  # repeated
    log().write(rows(2, 300), 2)  # the segment is full with it
    assert len(log().segments()) == 1
    log().write(rows(3, 5), 3)
    assert len(log().segments()) == 2
    log().write(rows(2, 300), 2)  # a repeated batch stays where it was
    assert len(log().segments()) == 2
    now[0] += 150  # old enough
    log().write(rows(4, 5), 4)
    assert len(log().segments()) == 3
    counts = {r.k: r.n for r in log().read("k int, id long").groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 5, 1: 5, 2: 300, 3: 5, 4: 5}
    now[0] += 450  # the first two are past keeping
    log().write(rows(5, 1), 5)
    assert {r.k for r in log().read("k int, id long").select("k").distinct().collect()} == {4, 5}
