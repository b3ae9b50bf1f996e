"""Streaming queries, drained to the end of their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import query
from quarry.streaming import counters


@query("SELECT event_type AS key, greatest(0, CAST(sum(CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END) AS BIGINT)) AS n FROM events GROUP BY 1", on_catalog=False)
def streaming_queue_counts(k):
    events = counters.stream(k.spark, f"{k.sf_dir}/events.parquet")
    return counters.queue_counts(events.select(F.col("event_type").alias("key"), F.when(F.col("event_id") % 3 == 0, -1).otherwise(1).alias("delta")))


@query("""WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events) SELECT CAST(epoch_us(date_trunc('hour', ts)) // 1000000 AS BIGINT) AS start, event_type, count(*) AS n FROM events, m WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY ALL""", on_catalog=False)
def streaming_windows(k):
    """Windows that the watermark has closed when all files are read."""
    return counters.drained(counters.windowed(counters.stream(k.spark, f"{k.sf_dir}/events.parquet")), "windows")


@query("SELECT event_type AS medium_hash, user_id AS ino, count(*) AS retries, CASE WHEN count(*) >= 50 THEN 'give_up' WHEN count(*) >= 10 THEN 'diagnose' ELSE 'retry' END AS action FROM events GROUP BY ALL", on_catalog=False)
def streaming_retries(k):
    """One row a key here, as the whole input is one batch; the last one of several batches otherwise."""
    events = counters.stream(k.spark, f"{k.sf_dir}/events.parquet").select(F.col("event_type").alias("medium_hash"), F.col("user_id").alias("ino"))
    rows = counters.drained(counters.retries(events), "retries")
    return rows.groupBy("medium_hash", "ino").agg(F.max(F.struct("retries", "action")).alias("r")).select("medium_hash", "ino", "r.*")


@query("""SELECT event_type AS medium_hash, round(count(*) FILTER (WHERE event_id % 4 = 0) / count(*), 3) AS error_rate, count(*) FILTER (WHERE event_id % 4 = 0) AS errors, count(*) AS processed, 0.1::DOUBLE AS threshold FROM events GROUP BY 1 HAVING count(*) >= 100 AND count(*) FILTER (WHERE event_id % 4 = 0) / count(*) > 0.1""", on_catalog=False)
def streaming_error_rates(k):
    """Here the whole input is one batch."""
    events = counters.stream(k.spark, f"{k.sf_dir}/events.parquet")
    return counters.error_rate_flags(events.select(F.col("event_type").alias("medium_hash"), (F.col("event_id") % 4 == 0).alias("failed")))


@query("SELECT event_type AS key, max(event_id) AS at, round(list_reduce(list(value ORDER BY event_id), lambda s, x: (1::DOUBLE - 0.3::DOUBLE) * s + 0.3::DOUBLE * x), 6) AS ema FROM events GROUP BY 1", on_catalog=False)
def streaming_rates(k):
    """The last average of each key; here the whole input is one batch."""
    events = counters.stream(k.spark, f"{k.sf_dir}/events.parquet")
    rows = counters.drained(counters.smoothed_rates(events.select(F.col("event_type").alias("key"), F.col("event_id").alias("at"), F.col("value").alias("rate"))), "emas")
    return rows.groupBy("key").agg(F.max("at").alias("at"), F.round(F.max_by("ema", "at"), 6).alias("ema"))
