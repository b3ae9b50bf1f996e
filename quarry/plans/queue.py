"""Work-queue state queries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import queue
from quarry.plans.registry import query


@query("SELECT medium_hash, count(*) AS total, count(*) FILTER (WHERE NOT copied AND claimed_by IS NULL) AS pending, count(*) FILTER (WHERE claimed_by = 'NON_FILE') AS non_file, count(*) FILTER (WHERE claimed_by = 'EXCLUDED') AS excluded, count(*) FILTER (WHERE copied) AS completed FROM inode GROUP BY 1")
def pipeline_state(k):
    by = F.coalesce("claimed_by", F.lit(""))
    return k.inode.groupBy("medium_hash").agg(F.count("*").alias("total"), F.count_if(queue.is_pending()).alias("pending"), F.count_if(by == "NON_FILE").alias("non_file"), F.count_if(by == "EXCLUDED").alias("excluded"), F.count_if("copied").alias("completed"))


@query("SELECT status, error_type, count(*) AS n FROM inode WHERE status LIKE 'failed%' GROUP BY ALL")
def failures_by_type(k):
    return k.inode.where(F.col("status").startswith("failed")).groupBy("status", "error_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE status = 'failed_retryable') AS retryable, count(*) FILTER (WHERE status = 'failed_permanent') AS permanent FROM inode")
def failure_totals(k):
    s = F.col("status")
    return k.inode.agg(F.count_if(s == "failed_retryable").alias("retryable"), F.count_if(s == "failed_permanent").alias("permanent"))


@query("SELECT medium_hash, count(*) AS would_reset FROM inode WHERE status = 'failed_retryable' AND error_type = 'path_error' GROUP BY 1")
def reset_preview(k):
    return k.inode.where(queue.resettable("path_error")).groupBy("medium_hash").agg(F.count("*").alias("would_reset"))


@query("SELECT CASE WHEN status = 'failed_retryable' THEN 'pending' ELSE status END AS status, count(*) AS n, count(*) FILTER (WHERE status <> 'failed_retryable' AND error_type IS NOT NULL) AS typed FROM inode GROUP BY 1")
def status_after_reset(k):
    return queue.reset_failures(k.inode).groupBy("status").agg(F.count("*").alias("n"), F.count("error_type").alias("typed"))


@query("SELECT status, count(*) AS n, round(100::DOUBLE * (count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE), 2) AS pct FROM inode GROUP BY 1")
def status_distribution_pct(k):
    n = k.inode.groupBy("status").agg(F.count("*").alias("n"))
    return n.withColumn("pct", c.percent(F.col("n"), F.sum("n").over(W.partitionBy())))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(100::DOUBLE * (count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY o_orderstatus)::DOUBLE), 2) AS pct FROM orders GROUP BY o_orderstatus, o_orderpriority", on_catalog=False)
def order_status_pct(k):
    n = k.table("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return n.withColumn("pct", c.percent(F.col("n"), F.sum("n").over(W.partitionBy("o_orderstatus"))))


@query("SELECT m.medium_hash, count(*) AS depth FROM medium m JOIN inode i USING (medium_hash) WHERE m.health = 'ok' AND NOT i.copied AND i.claimed_by IS NULL GROUP BY 1")
def queue_depth(k):
    return k.inode.where(queue.is_pending()).join(k.medium.where("health = 'ok'").select("medium_hash"), "medium_hash", "left_semi").groupBy("medium_hash").agg(F.count("*").alias("depth"))


@query("""SELECT medium_hash, medium_human, message, image_path IS NOT NULL AS has_image, enum_done IS NOT NULL AS enum_complete, copy_done IS NOT NULL AS copy_complete, health, CAST(DATE '1970-01-01' + CAST(added // 86400 AS INTEGER) AS VARCHAR) AS added
FROM medium WHERE image_path IS NOT NULL AND (enum_done IS NULL OR copy_done IS NULL) ORDER BY medium.added""")
def incomplete_media(k):
    """Media that are imaged and not through, the longest waiting ones first."""
    has = lambda x, name: F.col(x).isNotNull().alias(name)
    rows = k.medium.where("image_path is not null and (enum_done is null or copy_done is null)").orderBy("added")
    return rows.select("medium_hash", "medium_human", "message", has("image_path", "has_image"), has("enum_done", "enum_complete"), has("copy_done", "copy_complete"), "health", c.day_of(F.col("added")).cast("string").alias("added"))


@query("SELECT medium_hash, ino, errors[-1] AS latest, len(errors) AS n_errors, len(errors) >= 3 AND len(list_distinct(errors[-3:])) = 1 AS repeated FROM inode WHERE message IS NOT NULL")
def latest_errors(k):
    return k.inode.where("message is not null").select("medium_hash", "ino", F.element_at("errors", -1).alias("latest"), F.size("errors").cast("long").alias("n_errors"), c.same_tail(F.col("errors")).alias("repeated"))


@query("SELECT count(*) FILTER (WHERE image_path IS NOT NULL) AS imaged, count(*) FILTER (WHERE enum_done IS NOT NULL) AS loaded, count(*) FILTER (WHERE copy_done IS NOT NULL) AS archived FROM medium")
def stage_counts(k):
    return k.medium.agg(F.count("image_path").alias("imaged"), F.count("enum_done").alias("loaded"), F.count("copy_done").alias("archived"))


@query("SELECT (SELECT count(*) FROM inode WHERE status = 'pending') AS pending, (SELECT count(*) FROM blobs) AS blobs")
def two_counts(k):
    return k.inode.where("status = 'pending'").agg(F.count("*").alias("pending")).crossJoin(k.blobs.agg(F.count("*").alias("blobs")))


@query("SELECT id, medium_hash FROM (SELECT *, row_number() OVER (PARTITION BY medium_hash ORDER BY id) AS rn FROM inode WHERE NOT copied AND claimed_by IS NULL) WHERE rn <= 2")
def claimed_batch(k):
    return queue.claim(k.inode, 2, "w").where("claimed_by = 'w'").select("id", "medium_hash")


@query("SELECT CASE WHEN blobid IS NOT NULL THEN 'success' WHEN copied THEN 'failed_retryable' ELSE 'pending' END AS status, count(*) AS n FROM inode GROUP BY 1")
def derived_status(k):
    return queue.derive_status(k.inode.drop("status", "error_type")).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT medium_hash, greatest(0, CAST(sum(CASE WHEN NOT copied AND claimed_by IS NULL THEN 1 ELSE 0 END) - 3 AS BIGINT)) AS unclaimed_count FROM inode GROUP BY 1")
def queue_stats_upsert(k):
    from quarry.operators.ingest import queue_stats

    stats = queue_stats(k.inode)
    return queue.upsert_counts(stats, stats.select("medium_hash", F.lit(-3).cast("long").alias("delta")))


@query("SELECT count(*) AS processed, count(*) FILTER (WHERE processed // 86400 = (SELECT max(processed) // 86400 FROM inode)) AS last_day FROM inode WHERE processed IS NOT NULL")
def processed_totals(k):
    day = F.floor(F.col("processed") / 86400)
    days = k.inode.where("processed is not null").groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    return days.agg(F.sum("n").alias("processed"), F.max(F.struct("day", "n")).getField("n").alias("last_day"))


@query("""WITH b AS (SELECT medium_hash, size FROM (SELECT *, row_number() OVER (PARTITION BY medium_hash ORDER BY id) AS rn FROM inode WHERE NOT copied AND claimed_by IS NULL) WHERE rn <= 50)
SELECT medium_hash, CASE WHEN size < 1024 THEN '<1KB' WHEN size < 10240 THEN '1-10KB' WHEN size < 102400 THEN '10-100KB' WHEN size < 1048576 THEN '100KB-1MB' WHEN size < 10485760 THEN '1-10MB' ELSE '>10MB' END AS bucket, count(*) AS n, round(sum(size)::DOUBLE / 1048576, 1) AS total_mb FROM b GROUP BY ALL""")
def batch_size_buckets(k):
    """Sizes of the next batch of 50 of each medium."""
    s = F.col("size")
    b = F.when(s < 1024, "<1KB").when(s < 10240, "1-10KB").when(s < 102400, "10-100KB").when(s < 1048576, "100KB-1MB").when(s < 10485760, "1-10MB").otherwise(">10MB")
    return queue.claim(k.inode, 50, "w").where("claimed_by = 'w'").groupBy("medium_hash", b.alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum("size").cast("double") / 1048576, 1).alias("total_mb"))


@query("""SELECT medium_hash, CASE WHEN size = 0 THEN 'empty' WHEN size < 1024 THEN '<1KB' WHEN size < 1048576 THEN '1KB-1MB' WHEN size < 10485760 THEN '1MB-10MB' WHEN size < 104857600 THEN '10MB-100MB' ELSE '>100MB' END AS size_range, count(*) AS count, CAST(sum(size) AS BIGINT) AS total_bytes FROM inode WHERE fs_type = 'f' GROUP BY ALL""")
def size_buckets(k):
    s = F.col("size")
    label = F.when(s == 0, "empty").when(s < 1024, "<1KB").when(s < 1048576, "1KB-1MB").when(s < 10485760, "1MB-10MB").when(s < 104857600, "10MB-100MB").otherwise(">100MB")
    rows = k.inode.where("fs_type = 'f'").groupBy("medium_hash", label.alias("size_range")).agg(F.count("*").alias("count"), F.sum("size").alias("total_bytes"))
    return rows.orderBy("medium_hash", F.when(F.col("size_range") == "empty", 1).when(F.col("size_range") == "<1KB", 2).when(F.col("size_range") == "1KB-1MB", 3).when(F.col("size_range") == "1MB-10MB", 4).when(F.col("size_range") == "10MB-100MB", 5).otherwise(6))


@query("""WITH g AS (SELECT *, NOT copied AND claimed_by IS NULL AND message IS NOT NULL AND len(errors) >= 5 AS stop, contains(message, 'I/O error') OR contains(message, 'beyond EOF') AS hard FROM inode)
SELECT copied OR stop AS copied, CASE WHEN stop THEN 'MAX_RETRIES_EXCEEDED' ELSE claimed_by END AS claimed_by, CASE WHEN stop THEN CASE WHEN hard THEN 'failed_permanent' ELSE 'failed_retryable' END ELSE status END AS status,
 CASE WHEN stop THEN CASE WHEN hard THEN 'io_error' ELSE 'unknown' END ELSE error_type END AS error_type, count(*) AS n FROM g WHERE message IS NOT NULL GROUP BY ALL""")
def given_up(k):
    return queue.give_up(k.inode.where("message is not null")).groupBy("copied", "claimed_by", "status", "error_type").agg(F.count("*").alias("n"))


@query("""SELECT medium_hash, i.copied OR coalesce(m.health = 'failed', FALSE) AS copied, CASE WHEN m.health = 'failed' AND NOT i.copied THEN 'EXCLUDED: bad_health' ELSE claimed_by END AS claimed_by, count(*) AS n FROM inode i LEFT JOIN medium m USING (medium_hash) GROUP BY ALL""")
def refused_media(k):
    return queue.refuse_failed_media(k.inode, k.medium).groupBy("medium_hash", "copied", "claimed_by").agg(F.count("*").alias("n"))


@query("""SELECT id, len(errors) + 1 AS n_errors, 'OSError: ' || substr(message, 1, 200) AS latest FROM (SELECT *, coalesce(message, 'odd') AS m FROM inode) WHERE message IS NOT NULL AND id % 3 = 0""")
def transient_failures(k):
    new = k.inode.where("message is not null and id % 3 = 0").select("id", "message", F.lit("OSError").alias("exception"))
    done = queue.mark_failure(k.inode, new)
    return done.join(new.select("id"), "id", "left_semi").select("id", F.size("errors").cast("long").alias("n_errors"), F.element_at("errors", -1).alias("latest"))


@query("SELECT id, TRUE AS copied, CASE WHEN error_type = 'io_error' THEN 'failed_permanent' ELSE 'failed_retryable' END AS status, error_type, CAST(NULL AS VARCHAR) AS claimed_by FROM inode WHERE message IS NOT NULL AND NOT copied")
def classified_failures(k):
    end = k.inode.where("message is not null and not copied").select("id", "message", F.lit(None).cast("string").alias("exception"))
    return queue.mark_classified(k.inode, end).join(end.select("id"), "id", "left_semi").select("id", "copied", "status", "error_type", "claimed_by")


@query("SELECT p.path, CASE WHEN p.exclude_reason IS NULL THEN i.blobid ELSE p.blobid END AS blobid FROM path p JOIN inode i ON p.medium_hash = i.medium_hash AND p.ino = i.ino")
def propagated_blobs(k):
    return queue.propagate_blobs(k.path, k.inode).select("path", "blobid")


@query("WITH lost AS (SELECT blobid, count(*) AS n FROM inode WHERE status = 'success' AND blobid IS NOT NULL AND blobid NOT IN (SELECT blobid FROM blobs) GROUP BY 1) SELECT blobid, n_hardlinks FROM blobs UNION ALL SELECT * FROM lost")
def backfilled_orphans(k):
    return queue.backfill_orphans(k.blobs.select("blobid", "n_hardlinks"), k.inode)


@query("SELECT blobid, n_hardlinks FROM blobs UNION ALL SELECT DISTINCT blobid, 0 FROM inode WHERE blobid IS NOT NULL AND blobid NOT IN (SELECT blobid FROM blobs)")
def backfilled_missing(k):
    return queue.register_blobs(k.blobs.select("blobid", "n_hardlinks"), k.inode, counted=False)


@query("WITH b AS (SELECT *, row_number() OVER (PARTITION BY medium_hash ORDER BY id) AS rn FROM inode WHERE NOT copied AND claimed_by IS NULL) SELECT b.id, b.medium_hash, coalesce(string_agg(DISTINCT p.path, ',' ORDER BY p.path), '') AS paths FROM b LEFT JOIN path p ON p.medium_hash = b.medium_hash AND p.ino = b.ino AND p.exclude_reason IS NULL WHERE rn <= 3 GROUP BY b.id, b.medium_hash")
def planned_batch(k):
    return queue.plan_batch(k.inode, k.path, 3).select("id", "medium_hash", F.coalesce(F.array_join("paths", ","), F.lit("")).alias("paths"))


@query("""SELECT medium_hash, round(count(*) FILTER (WHERE status LIKE 'failed%') / count(*), 3) AS error_rate, count(*) FILTER (WHERE status LIKE 'failed%') AS errors, count(*) AS processed, 0.05::DOUBLE AS threshold FROM inode GROUP BY 1 HAVING count(*) >= 5 AND count(*) FILTER (WHERE status LIKE 'failed%') / count(*) > 0.05""")
def media_above_error_rate(k):
    return queue.high_error_rate(k.inode.select("medium_hash", F.col("status").startswith("failed").alias("failed")), least=5, most=0.05)


@query("SELECT id, medium_hash, status, error_type FROM inode WHERE status LIKE 'failed%' AND medium_hash = 'src3'")
def failures_of_a_medium(k):
    return queue.failures(k.inode, "src3").select("id", "medium_hash", "status", "error_type")


@query("WITH t AS (SELECT unnest(errors) AS error, unnest(range(1, len(errors) + 1)) AS place, id FROM inode WHERE message IS NOT NULL) SELECT place, error, count(*) AS n FROM t GROUP BY ALL")
def errors_by_place(k):
    """Parallel arrays zipped and exploded."""
    both = F.arrays_zip(F.col("errors").alias("error"), F.sequence(F.lit(1).cast("long"), F.size("errors").cast("long")).alias("place"))
    return k.inode.where("message is not null").select(F.explode(both).alias("z")).groupBy("z.place", "z.error").agg(F.count("*").alias("n"))


@query("SELECT medium_hash, health, CASE WHEN medium_hash <> 'src3' THEN enum_done END AS enum_done, CASE WHEN medium_hash <> 'src3' THEN copy_done END AS copy_done FROM medium")
def reset_medium(k):
    return queue.reset_medium(k.medium, "src3").select("medium_hash", "health", "enum_done", "copy_done")


@query("""WITH n AS (SELECT max(CAST(substr(timestamp, 1, 10) AS DATE)) AS now FROM ev) SELECT CAST(substr(timestamp, 1, 10) AS DATE) < now - 5 AS archived, count(*) AS n FROM ev, n GROUP BY 1""")
def archived_events(k):
    """Here what is more than five days older than the newest event."""
    now = k.events.agg(F.max("timestamp")).first()[0] or "1970-01-01"
    kept, old = queue.archived_events(k.events, now, keep_days=5)
    count = lambda df, name: df.groupBy(F.lit(name).alias("archived")).agg(F.count("*").alias("n"))
    return count(kept, False).unionByName(count(old, True))


@query("SELECT id, TRUE AS copied, 'EXCLUDED: persistent_failure: ' || message AS claimed_by FROM inode WHERE message IS NOT NULL AND NOT copied AND len(errors) >= 3")
def persistent_failures(k):
    return queue.exclude_repeated(k.inode).where(F.col("claimed_by").startswith("EXCLUDED: persistent")).select("id", "copied", "claimed_by")
