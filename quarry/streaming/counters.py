"""Structured Streaming forms of the queue's incremental behaviour.

Sources are append-only folders; a run takes what is there and stops
(``availableNow``), as polling until the queue is empty does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.functions import columns as c
from quarry.sources.shared import shared_folder


def stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The files of a folder, or one file (a file stream reads folders, so the others are filtered by name)."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def drained(frame: DataFrame, name: str) -> DataFrame:
    """Run an append stream over what is there now; its output as a table."""
    spark, at = frame.sparkSession, shared_folder(frame.sparkSession, name)
    frame.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{at}/out")


def queue_counts(deltas: DataFrame, name: str = "counts") -> DataFrame:
    """(key, n) of a stream of (key, delta): each batch adds one summed row a key; never below zero.

    Batches are written under their number, so a repeated batch replaces itself.
    """
    spark, at = deltas.sparkSession, shared_folder(deltas.sparkSession, name)

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy("key").agg(F.sum("delta").cast("long").alias("delta")).write.mode("overwrite").parquet(f"{at}/sums/batch={number}")

    deltas.writeStream.foreachBatch(add).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    sums = spark.read.schema("key string, delta bigint").parquet(f"{at}/sums/*")
    return sums.groupBy("key").agg(F.greatest(F.lit(0), F.sum("delta")).cast("long").alias("n"))


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Extension: counts in tumbling windows that the watermark has closed."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counted = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.unix_seconds("w.start").alias("start"), "event_type", "n")


def retries(failures: DataFrame, checkpoint: int = c.CHECKPOINT, most: int = c.MAX_RETRIES, degraded: int = 5) -> DataFrame:
    """(medium_hash, ino, retries, action) per batch and key: a counter in state, checkpoint and give-up at their thresholds.

    If ``failures`` has a column ``health``, media without one are degraded: both thresholds are ``degraded`` there.
    """
    known = "health" in failures.columns

    def count(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        n = (state.get[0] if state.exists else 0) + sum(len(r) for r in parts)
        state.update((n,))
        bad = known and all(r["health"].isna().all() for r in parts)
        most_, checkpoint_ = (degraded, degraded) if bad else (most, checkpoint)
        yield pd.DataFrame({"medium_hash": [key[0]], "ino": [key[1]], "retries": [n], "action": ["give_up" if n >= most_ else "diagnose" if n >= checkpoint_ else "retry"]})

    return failures.groupBy("medium_hash", "ino").applyInPandasWithState(count, "medium_hash string, ino bigint, retries bigint, action string", "n bigint", "append", GroupStateTimeout.NoTimeout)


def log_status(lines: DataFrame) -> DataFrame:
    """Status of each stage of a tailed log of (stage, event): failed beats done beats running."""
    e = F.col("event")
    return lines.groupBy("stage").agg(F.max(F.when(e == "failed", 3).when(e == "done", 2).otherwise(1)).alias("s")).select("stage", F.when(F.col("s") == 3, "failed").when(F.col("s") == 2, "done").otherwise("running").alias("status"))


def until_idle(poll, most_empty: int = 3) -> int:
    """Call ``poll`` (the number of rows that it took) until it has come back empty so many times in a row; all rows."""
    taken = empty = 0
    while empty < most_empty:
        n = poll()
        taken, empty = taken + n, 0 if n else empty + 1
    return taken


def smoothed_rates(deltas: DataFrame, alpha: float = 0.3) -> DataFrame:
    """(key, at, ema) of a stream of (key, at, rate): the average after each rate, its last value in state.  Rows of a batch go in order of ``at``."""

    def fold(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows)).sort_values("at", kind="stable")
        last, out = state.get[0] if state.exists else None, []
        for rate in own["rate"]:
            last = rate if last is None else alpha * rate + (1 - alpha) * last
            out.append(last)
        state.update((last,))
        yield pd.DataFrame({"key": key[0], "at": own["at"].to_numpy(), "ema": out})

    return deltas.groupBy("key").applyInPandasWithState(fold, "key string, at bigint, ema double", "last double", "append", GroupStateTimeout.NoTimeout)


def error_rate_flags(results: DataFrame, name: str = "rates", least: int = 100, most: float = 0.1) -> DataFrame:
    """(medium_hash, error_rate, errors, processed, threshold), one row for each medium of a stream of (medium_hash, failed) that was above the rate after some batch: the first such one."""

    def watch(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        errors, n, told = state.get if state.exists else (0, 0, False)
        for r in rows:
            errors, n = errors + int(r["failed"].sum()), n + len(r)
        now = not told and n >= least and errors / n > most
        state.update((errors, n, told or now))
        yield pd.DataFrame({"medium_hash": [key[0]] * now, "error_rate": [round(errors / n, 3)] * now, "errors": [errors] * now, "processed": [n] * now, "threshold": [most] * now})

    kind = "medium_hash string, error_rate double, errors bigint, processed bigint, threshold double"
    return drained(results.groupBy("medium_hash").applyInPandasWithState(watch, kind, "errors bigint, n bigint, told boolean", "append", GroupStateTimeout.NoTimeout), name)
