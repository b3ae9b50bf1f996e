"""Work queue: batches, outcomes and resets as pure functions from state to state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c


def is_pending() -> Column:
    return ~F.coalesce(F.col("copied"), F.lit(False)) & F.col("claimed_by").isNull()


def claim(inode: DataFrame, n: int, worker: str) -> DataFrame:
    """The first ``n`` pending rows of each medium by id get the worker; a rank limit keeps n rows a task."""
    first = inode.where(is_pending()).withColumn("rank", F.row_number().over(W.partitionBy("medium_hash").orderBy("id"))).where(F.col("rank") <= n).select("medium_hash", "id", F.lit(worker).alias("worker"))
    return inode.join(first, ["medium_hash", "id"], "left").withColumn("claimed_by", F.coalesce("worker", "claimed_by")).drop("worker")


def mark_success(inode: DataFrame, results: DataFrame) -> DataFrame:
    """``results``: (id, blob, mime).  Matched rows are copied and successful; a new MIME type replaces the old one."""
    done = inode.join(results.select("id", F.col("blob").alias("__blob"), F.col("mime").alias("__mime"), F.lit(True).alias("__done")), "id", "left")
    hit = F.col("__done").isNotNull()
    return done.select(*[
        {"copied": F.when(hit, True).otherwise(F.col("copied")), "blobid": F.when(hit, F.col("__blob")).otherwise(F.col("blobid")), "mime_type": F.coalesce("__mime", "mime_type"), "status": F.when(hit, "success").otherwise(F.col("status")), "claimed_by": F.when(~hit, F.col("claimed_by"))}.get(x, F.col(x)).alias(x)
        for x in inode.columns
    ])


def mark_failure(inode: DataFrame, failures: DataFrame, longest: int = 200) -> DataFrame:
    """``failures``: (id, message, exception).  A transient failure: '<exception>: <message>' is appended and the claim released; it will be tried again."""
    entry = F.concat_ws(": ", "exception", F.substring("message", 1, longest))
    f = failures.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("__m"))
    done = inode.join(f, "id", "left")
    hit = F.col("__m").isNotNull()
    out = {"errors": F.when(hit, F.concat(F.coalesce("errors", F.array().cast("array<string>")), F.col("__m"))).otherwise(F.col("errors")), "claimed_by": F.when(~hit, F.col("claimed_by"))}
    return done.select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def mark_classified(inode: DataFrame, failures: DataFrame) -> DataFrame:
    """``failures``: (id, message, exception).  Retries are at their end: the row counts as copied, with a status by the type of its error."""
    kind = c.classify_error(F.col("message"), F.col("exception"))
    f = failures.groupBy("id").agg(F.min_by(kind, "message").alias("__t"))
    done = inode.join(f, "id", "left")
    hit = F.col("__t").isNotNull()
    out = {"copied": F.when(hit, True).otherwise(F.col("copied")), "error_type": F.when(hit, F.col("__t")).otherwise(F.col("error_type")), "status": F.when(hit, c.failure_status(F.col("__t"))).otherwise(F.col("status")), "claimed_by": F.when(~hit, F.col("claimed_by"))}
    return done.select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def propagate_blobs(path: DataFrame, inode: DataFrame) -> DataFrame:
    """Paths that are not excluded take the blob of their inode."""
    known = inode.where("blobid is not null").select("medium_hash", "ino", F.col("blobid").alias("__b"))
    return path.join(known, ["medium_hash", "ino"], "left").withColumn("blobid", F.when(F.col("exclude_reason").isNull(), F.coalesce("__b", "blobid")).otherwise(F.col("blobid"))).drop("__b")


def give_up(inode: DataFrame, most: int = c.MAX_ERRORS) -> DataFrame:
    """Pending rows with ``most`` errors stop: permanent if the last one is an I/O error or beyond the end."""
    last = F.when(F.size("errors") >= most, F.coalesce(F.element_at("errors", -1), F.lit("unknown")))
    hard = last.contains("I/O error") | last.contains("beyond EOF")
    stop = last.isNotNull() & is_pending()
    out = {"copied": F.when(stop, True).otherwise(F.col("copied")), "claimed_by": F.when(stop, "MAX_RETRIES_EXCEEDED").otherwise(F.col("claimed_by")), "status": F.when(stop, F.when(hard, "failed_permanent").otherwise("failed_retryable")).otherwise(F.col("status")), "error_type": F.when(stop, F.when(hard, "io_error").otherwise("unknown")).otherwise(F.col("error_type"))}
    return inode.select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def exclude_repeated(inode: DataFrame) -> DataFrame:
    """Uncopied rows whose last errors are one and the same are excluded, and count as copied; the reason is the error without its type."""
    hit = c.same_tail(F.col("errors")) & ~F.coalesce(F.col("copied"), F.lit(False))
    reason = F.concat(F.lit("EXCLUDED: persistent_failure: "), F.regexp_replace(F.element_at("errors", -1), r"^[A-Za-z_.]+: ", ""))
    out = {"copied": F.when(hit, True).otherwise(F.col("copied")), "claimed_by": F.when(hit, reason).otherwise(F.col("claimed_by"))}
    return inode.select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def refuse_failed_media(inode: DataFrame, medium: DataFrame) -> DataFrame:
    """Uncopied rows of media of health 'failed' are excluded and count as copied."""
    bad = medium.where("health = 'failed'").select("medium_hash", F.lit(True).alias("__bad"))
    hit = F.col("__bad").isNotNull() & ~F.coalesce(F.col("copied"), F.lit(False))
    out = {"copied": F.when(hit, True).otherwise(F.col("copied")), "claimed_by": F.when(hit, "EXCLUDED: bad_health").otherwise(F.col("claimed_by"))}
    return inode.join(bad, "medium_hash", "left").select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def resettable(error_type: str | None = None) -> Column:
    hit = F.col("status") == "failed_retryable"
    return hit if error_type is None else hit & (F.col("error_type") == error_type)


def reset_failures(inode: DataFrame, error_type: str | None = None, medium: str | None = None) -> DataFrame:
    hit = resettable(error_type)
    hit = F.coalesce(hit if medium is None else hit & (F.col("medium_hash") == medium), F.lit(False))
    out = {"status": F.when(hit, "pending").otherwise(F.col("status")), "copied": F.when(hit, False).otherwise(F.col("copied")), "claimed_by": F.when(~hit, F.col("claimed_by")), "error_type": F.when(~hit, F.col("error_type")), "errors": F.when(~hit, F.col("errors")).otherwise(F.array().cast("array<string>"))}
    return inode.select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def derive_status(inode: DataFrame) -> DataFrame:
    """Status of rows from before statuses: a blob is success, copied without one an unknown failure."""
    ok, lost = F.col("blobid").isNotNull(), F.coalesce(F.col("copied"), F.lit(False)) & F.col("blobid").isNull()
    return inode.withColumn("error_type", F.when(lost, "unknown")).withColumn("status", F.when(ok, "success").when(lost, "failed_retryable").otherwise("pending"))


def backfill_mime(inode: DataFrame, found: DataFrame) -> DataFrame:
    """``found``: (blobid, mime); every inode of the blob without a type gets it."""
    return inode.join(found.select("blobid", F.col("mime").alias("__m")), "blobid", "left").withColumn("mime_type", F.coalesce("mime_type", "__m")).select(*inode.columns)


def register_blobs(blobs: DataFrame, inode: DataFrame, counted: bool = True) -> DataFrame:
    """Blobs of inodes that the table lacks, appended once (insert if absent)."""
    new = inode.where("blobid is not null").groupBy("blobid").agg((F.count("*") if counted else F.lit(0)).cast("long").alias("n_hardlinks")).join(blobs.select("blobid"), "blobid", "left_anti")
    return blobs.unionByName(new, allowMissingColumns=True)


def upsert_counts(stats: DataFrame, delta: DataFrame) -> DataFrame:
    """Signed deltas added per medium, never below zero."""
    both = stats.select("medium_hash", "unclaimed_count").unionByName(delta.select("medium_hash", F.col("delta").alias("unclaimed_count")))
    return both.groupBy("medium_hash").agg(F.greatest(F.lit(0), F.sum("unclaimed_count")).cast("long").alias("unclaimed_count"))


def mark_backup(blobs: DataFrame, results: DataFrame, now: int) -> DataFrame:
    """``results``: (blobid, ok).  Copied blobs are dated, failed ones flagged, others stay."""
    r = results.groupBy("blobid").agg(F.bool_or("ok").alias("__ok"))
    done = blobs.join(r, "blobid", "left")
    return done.withColumn("external_copied", F.when(F.col("__ok"), True).otherwise(F.col("external_copied"))).withColumn("external_copy_failed", F.when(~F.col("__ok"), True).when(F.col("__ok"), None).otherwise(F.col("external_copy_failed"))).withColumn("last_checked", F.when(F.col("__ok"), F.lit(now)).otherwise(F.col("last_checked"))).drop("__ok")


def populate_blobs(inode: DataFrame, now: int) -> DataFrame:
    """Every blob of the inodes with its number of links and first time of processing."""
    return inode.where("blobid is not null").groupBy("blobid").agg(F.count("*").alias("n_hardlinks"), F.coalesce(F.min("processed"), F.lit(now)).alias("created"))


def drop_medium(inode: DataFrame, medium: str) -> DataFrame:
    return inode.where(F.col("medium_hash") != medium)


def reset_medium(medium: DataFrame, medium_hash: str) -> DataFrame:
    """The media, the asked one again as before its enumeration; its tables go by ``sinks.drop_medium``."""
    hit = F.coalesce(F.col("medium_hash") == medium_hash, F.lit(False))
    return medium.select(*[F.when(~hit, F.col(x)).alias(x) if x in ("enum_done", "copy_done") else F.col(x) for x in medium.columns])


def old_events(events: DataFrame, day: int, keep_days: int = 90) -> tuple[DataFrame, DataFrame]:
    """(kept, archived) events, by age in days."""
    fresh = F.col("day") > day - keep_days
    return events.where(fresh), events.where(~fresh)


def archived_events(events: DataFrame, now: str, keep_days: int = 90) -> tuple[DataFrame, DataFrame]:
    """(kept, archived) events by their ``timestamp``; ``now`` in the same form.  One without a timestamp is kept."""
    old = F.coalesce(F.to_date("timestamp") < F.date_sub(F.to_date(F.lit(now)), keep_days), F.lit(False))
    return events.where(~old), events.where(old)


def backfill_orphans(blobs: DataFrame, inode: DataFrame) -> DataFrame:
    """Blobs of successful inodes that the table lacks, with their number of inodes; counts of a blob that is there are added to."""
    from quarry.sources.sinks import upsert

    lost = inode.where("blobid is not null and status = 'success'").join(blobs.select("blobid"), "blobid", "left_anti").groupBy("blobid").agg(F.count("*").alias("n_hardlinks"))
    return upsert(blobs, lost, ["blobid"], add=("n_hardlinks",))


def plan_batch(inode: DataFrame, path: DataFrame, n: int) -> DataFrame:
    """The next ``n`` pending rows of each medium, with all their live paths."""
    first = inode.where(is_pending()).withColumn("rank", F.row_number().over(W.partitionBy("medium_hash").orderBy("id"))).where(F.col("rank") <= n).drop("rank")
    live = path.where("exclude_reason is null").join(first.select("medium_hash", "ino"), ["medium_hash", "ino"], "left_semi").groupBy("medium_hash", "ino").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    return first.join(live, ["medium_hash", "ino"], "left")


def failures(inode: DataFrame, medium: str | None = None) -> DataFrame:
    """Failed rows, of one medium or all."""
    rows = inode.where(F.col("status").startswith("failed"))
    return rows if medium is None else rows.where(F.col("medium_hash") == medium)


def high_error_rate(results: DataFrame, least: int = 100, most: float = 0.1) -> DataFrame:
    """``results``: (medium_hash, failed).  Media above an error rate, of ``least`` results or more: one row each, however often it was exceeded."""
    n = results.groupBy("medium_hash").agg(F.count("*").alias("processed"), F.count_if("failed").alias("errors"))
    rate = F.col("errors") / F.col("processed")
    return n.where((F.col("processed") >= least) & (rate > most)).select("medium_hash", F.round(rate, 3).alias("error_rate"), "errors", "processed", F.lit(most).alias("threshold"))
