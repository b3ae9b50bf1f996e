"""Streams over logs: the status of a log that grows, rows held until there are enough of them, log files that are rotated."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.sources.shared import delete, file_system

#: later ones stand over earlier ones
STATES = ("running", "done", "failed")


def tailed(spark: SparkSession, path: str, schema: str = "stage string, event string, ts string") -> DataFrame:
    """A folder of JSON-lines logs as a stream of what is added; malformed lines are dropped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(path)


def status_changes(lines: DataFrame) -> DataFrame:
    """(stage, status, events) of a stream of (stage, event), a row for each stage and batch in which its status is new: failed stands over done over running.

    State is a status and a count for each stage; lines without a stage say nothing.
    """

    def watch(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, n = state.get if state.exists else (-1, 0)
        now = before
        for r in rows:
            n += len(r)
            now = max([now, *(STATES.index(e) if e in STATES else 0 for e in r["event"])])
        state.update((now, n))
        if now > before:
            yield pd.DataFrame({"stage": [key[0]], "status": [STATES[now]], "events": [n]})

    return lines.where("stage is not null").groupBy("stage").applyInPandasWithState(watch, "stage string, status string, events bigint", "status int, n bigint", "append", GroupStateTimeout.NoTimeout)


def gathered(rows: DataFrame, key: str, size: int = 100, wait_ms: int = 60_000) -> DataFrame:
    """(key, n, rows) of a stream: rows of a key are held in state and go out as one JSON array when there are ``size``, or when ``wait_ms`` have passed.

    A larger batch goes out in arrays of ``size``; what is left over is held.  For a stream that runs on (with the
    trigger availableNow a query ends only when nothing is held).
    """
    columns = rows.columns

    def hold(own_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            if held:
                yield pd.DataFrame({"key": [own_key[0]], "n": [len(held)], "rows": [json.dumps(held)]})
            return
        for b in batches:
            held += json.loads(b[columns].to_json(orient="records"))
            while len(held) >= size:
                yield pd.DataFrame({"key": [own_key[0]], "n": [size], "rows": [json.dumps(held[:size])]})
                held = held[size:]
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutDuration(wait_ms)
        elif state.exists:
            state.remove()

    own = "__key"
    while own in columns:
        own += "_"
    return rows.withColumn(own, F.col(key).cast("string")).groupBy(own).applyInPandasWithState(hold, "key string, n bigint, rows string", "held string", "append", GroupStateTimeout.ProcessingTimeTimeout)


class RotatingLog:
    """A JSON-lines log in segments: a new one begins when the newest has ``most_bytes`` or is ``most_seconds`` old; older ones than ``keep_seconds`` go.

    ``write`` is for ``foreachBatch``.  A segment's name is when it began, a batch is a folder in
    it; what is there is read from the folder itself, so that a restarted stream goes on
    with the same segment, and a batch that is repeated replaces itself.
    """

    def __init__(self, spark: SparkSession, at: str, most_bytes: int = 100 << 20, most_seconds: int = 86_400, keep_seconds: int = 30 * 86_400, clock: Callable[[], float] = time.time):
        self.spark, self.at, self.most_bytes, self.most_seconds, self.keep_seconds, self.clock = spark, at.rstrip("/"), most_bytes, most_seconds, keep_seconds, clock

    def segments(self) -> list[int]:
        """When each segment began, in milliseconds, in order."""
        fs, at = file_system(self.spark, self.at)
        return sorted(int(x.getPath().getName().removeprefix("segment-")) for x in fs.listStatus(at) if x.getPath().getName().startswith("segment-")) if fs.exists(at) else []

    def _holds(self, segment: int, number: int) -> bool:
        fs, at = file_system(self.spark, f"{self.at}/segment-{segment}/batch-{number}")
        return fs.exists(at)

    def write(self, batch: DataFrame, number: int) -> None:
        now, known = int(self.clock() * 1000), self.segments()
        repeated = [s for s in known[-2:] if self._holds(s, number)]
        newest = repeated[0] if repeated else known[-1] if known else None
        if not repeated and newest is not None:
            fs, at = file_system(self.spark, f"{self.at}/segment-{newest}")
            if fs.getContentSummary(at).getLength() >= self.most_bytes or now - newest >= self.most_seconds * 1000:
                newest = None
        segment = newest if newest is not None else max([now, *(s + 1 for s in known[-1:])])
        batch.write.mode("overwrite").json(f"{self.at}/segment-{segment}/batch-{number}")
        for old in known:
            if old != segment and now - old > self.keep_seconds * 1000:
                delete(self.spark, f"{self.at}/segment-{old}")

    def read(self, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(f"{self.at}/segment-*/batch-*")
