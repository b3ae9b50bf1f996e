"""Diagnostic events out of semi-structured problems, and reporting."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import dedup, jsonb
from quarry.plans.registry import query


@query("SELECT medium_hash, count(*) AS event_count FROM ev GROUP BY 1 ORDER BY event_count DESC, medium_hash")
def media_with_events(k):
    n = k.problems.groupBy("medium_hash").agg(F.sum(F.json_array_length(F.get_json_object("problems", "$.diagnostic_events"))).alias("event_count"))
    return n.where("event_count is not null").orderBy(F.desc("event_count"), "medium_hash")


@query("SELECT ino, action, day, retry_count FROM ev WHERE medium_hash = 'src3'")
def medium_events(k):
    return k.events.where("medium_hash = 'src3'").select("ino", "action", "day", "retry_count")


@query("SELECT action, count(*) AS n, count(DISTINCT medium_hash) AS media FROM ev GROUP BY 1")
def json_actions_rollup(k):
    return k.events.groupBy("action").agg(F.count("*").alias("n"), F.count_distinct("medium_hash").alias("media"))


@query("SELECT c AS check_name, count(*) AS n, count(DISTINCT medium_hash) AS media FROM (SELECT medium_hash, unnest(checks) AS c FROM ev) GROUP BY 1")
def json_event_explode(k):
    """Events opened as VARIANT by a table function."""
    events = jsonb.elements(k.problems, "problems", "$.diagnostic_events").select("medium_hash", jsonb.field(F.col("value"), "checks", "array<string>").alias("checks"))
    return events.select("medium_hash", F.explode("checks").alias("check_name")).groupBy("check_name").agg(F.count("*").alias("n"), F.count_distinct("medium_hash").alias("media"))


@query("SELECT c AS check_name, action, count(*) AS n FROM (SELECT action, unnest(checks) AS c FROM ev) GROUP BY ALL")
def check_by_action(k):
    return k.events.select("action", F.explode("checks").alias("check_name")).groupBy("check_name", "action").agg(F.count("*").alias("n"))


@query("""SELECT medium_hash, count(DISTINCT ino) AS problem_inodes, t.total, round(100::DOUBLE * (count(DISTINCT ino)::DOUBLE / nullif(t.total::DOUBLE, 0)), 2) AS pct FROM ev JOIN (SELECT medium_hash, count(*) AS total FROM inode GROUP BY 1) t USING (medium_hash) GROUP BY medium_hash, t.total HAVING count(DISTINCT ino) > 0""")
def problem_inode_pct(k):
    n = k.events.groupBy("medium_hash").agg(F.count_distinct("ino").alias("problem_inodes")).where("problem_inodes > 0")
    return n.join(k.inode.groupBy("medium_hash").agg(F.count("*").alias("total")), "medium_hash").withColumn("pct", c.percent(F.col("problem_inodes"), F.col("total")))


@query("SELECT 'diagnostic' AS what, count(*) AS n FROM inode WHERE claimed_by LIKE 'DIAGNOSTIC_SKIP:%' UNION ALL SELECT 'clean', count(*) FROM inode WHERE copied AND claimed_by NOT LIKE 'DIAGNOSTIC_SKIP:%' UNION ALL SELECT 'pending', count(*) FROM inode WHERE NOT copied")
def union_labelled_counts(k):
    by = F.col("claimed_by")
    counted = k.inode.agg(F.count_if(by.like("DIAGNOSTIC_SKIP:%")).alias("diagnostic"), F.count_if(F.col("copied") & ~by.like("DIAGNOSTIC_SKIP:%")).alias("clean"), F.count_if(~F.col("copied")).alias("pending"))
    return counted.select(F.explode(F.array(*(F.struct(F.lit(x).alias("what"), F.col(x).alias("n")) for x in counted.columns))).alias("r")).select("r.*")


@query("SELECT fs_type, status, count(*) AS n, count(*) FILTER (WHERE copied) AS copied, count(DISTINCT medium_hash) FILTER (WHERE copied) AS media FROM inode GROUP BY ALL")
def inode_counts_by_state(k):
    return k.inode.groupBy("fs_type", "status").agg(F.count("*").alias("n"), F.count_if("copied").alias("copied"), F.count_distinct(F.when(F.col("copied"), F.col("medium_hash"))).alias("media"))


@query("SELECT count(*) AS paths, count(DISTINCT ino) AS inodes FROM path")
def paths_vs_inodes(k):
    return k.path.agg(F.count("*").alias("paths"), F.count_distinct("ino").alias("inodes"))


@query("SELECT claimed_by, count(*) AS n FROM inode WHERE claimed_by IS NOT NULL GROUP BY 1 ORDER BY n DESC, claimed_by")
def skip_reasons(k):
    return k.inode.where("claimed_by is not null").groupBy("claimed_by").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "claimed_by")


@query("SELECT event_type, CAST(sum(gap) AS BIGINT) AS micros, count(gap) AS n FROM (SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) GROUP BY 1", on_catalog=False)
def avg_gap_seconds(k):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = us - F.lag(us).over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return k.table("events").select("event_type", gap.alias("gap")).groupBy("event_type").agg(F.sum("gap").alias("micros"), F.count("gap").alias("n"))


@query("SELECT coalesce(health, 'unknown') AS health, count(*) AS n, round(100::DOUBLE * (count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE), 2) AS pct, count(image_path) AS images FROM medium GROUP BY 1")
def imaging_success(k):
    n = k.medium.groupBy(F.coalesce("health", F.lit("unknown")).alias("health")).agg(F.count("*").alias("n"), F.count("image_path").alias("images"))
    return n.select("health", "n", c.percent(F.col("n"), F.sum("n").over(W.partitionBy())).alias("pct"), "images")


@query("SELECT health IS NULL AS no_health, enum_done IS NULL AS no_enum, copy_done IS NULL AS no_copy, image_path IS NULL AS no_image, coalesce(health = 'failed', FALSE) AS failed, count(*) AS n FROM medium GROUP BY ALL")
def problem_flags(k):
    null = lambda x: F.col(x).isNull()
    return k.medium.groupBy(null("health").alias("no_health"), null("enum_done").alias("no_enum"), null("copy_done").alias("no_copy"), null("image_path").alias("no_image"), F.coalesce(F.col("health") == "failed", F.lit(False)).alias("failed")).agg(F.count("*").alias("n"))


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1", on_catalog=False)
def props_rollup(k):
    v = F.get_json_object("props", "$.k").cast("long")
    return k.table("events").where(v.isNotNull()).groupBy((v % 10).alias("k")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT medium_hash, day AS part, CAST(regexp_extract(medium_hash, '([0-9]+)', 1) AS INT) % 4 = 0 AS rated FROM ev")
def cleared_problems(k):
    """Without the flag key, with the events' key moved, and one key merged in."""
    cleared = jsonb.remove_key(F.col("problems"), "beyond_eof_detected")
    merged = jsonb.merge(cleared, F.lit('{"reviewed": "yes"}'))
    keys = F.json_object_keys(merged)
    return k.problems.where(F.array_contains(keys, "reviewed") & ~F.array_contains(keys, "beyond_eof_detected")).select("medium_hash", "part", F.array_contains(F.json_object_keys("problems"), "high_error_rate").alias("rated"))


def _named(k):
    """Events with the name of their medium."""
    return k.events.join(k.medium.select("medium_hash", "medium_human"), "medium_hash")


def _listed(column):
    """Distinct values, in order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def _problem(name):
    return F.get_json_object("problems", f"$.{name}")


@query("SELECT medium_hash, medium_human, count(*) AS beyond_eof_count FROM ev JOIN medium USING (medium_hash) WHERE list_contains(checks, 'detected_beyond_eof') OR list_contains(checks, 'dmesg:beyond_eof') GROUP BY ALL")
def json_containment(k):
    hit = F.array_contains("checks", "detected_beyond_eof") | F.array_contains("checks", "dmesg:beyond_eof")
    return _named(k).where(hit).groupBy("medium_hash", "medium_human").agg(F.count("*").alias("beyond_eof_count"))


@query("SELECT CAST(CAST(substr(timestamp, 1, 10) AS DATE) AS VARCHAR) AS date, action, count(*) AS events, count(DISTINCT medium_hash) AS media_count FROM ev GROUP BY ALL ORDER BY date DESC, events DESC, action")
def event_timeline(k):
    day = F.to_date("timestamp").cast("string")
    return k.events.groupBy(day.alias("date"), "action").agg(F.count("*").alias("events"), F.count_distinct("medium_hash").alias("media_count")).orderBy(F.desc("date"), F.desc("events"), "action")


@query("""SELECT medium_hash, medium_human, TRUE AS beyond_eof, (SELECT count(*) FROM inode i WHERE i.medium_hash = m.medium_hash AND claimed_by LIKE 'DIAGNOSTIC_SKIP:%') AS skipped_inodes, (SELECT count(*) FROM inode i WHERE i.medium_hash = m.medium_hash) AS total_inodes FROM medium m WHERE beyond_eof""")
def flagged_media_skips(k):
    """Both correlated counts are one pass over the inodes."""
    flagged = k.medium.where(_problem("beyond_eof_detected") == "true").select("medium_hash", "medium_human", F.lit(True).alias("beyond_eof"))
    n = k.inode.groupBy("medium_hash").agg(F.count_if(F.col("claimed_by").startswith("DIAGNOSTIC_SKIP:")).alias("skipped_inodes"), F.count("*").alias("total_inodes"))
    return flagged.join(n, "medium_hash", "left").na.fill(0, ["skipped_inodes", "total_inodes"])


@query("SELECT medium_hash, medium_human, rate_percent AS error_rate, CAST(detected_at_count AS BIGINT) AS sample_size, copy_done FROM medium WHERE rate_percent IS NOT NULL ORDER BY error_rate DESC, medium_hash")
def high_error_rate_media(k):
    found = k.medium.where(_problem("high_error_rate").isNotNull())
    return found.select("medium_hash", "medium_human", _problem("high_error_rate.rate_percent").cast("double").alias("error_rate"), _problem("high_error_rate.detected_at_count").cast("long").alias("sample_size"), "copy_done").orderBy(F.desc("error_rate"), "medium_hash")


@query("""SELECT m.medium_hash, m.medium_human, CASE WHEN beyond_eof THEN 'beyond_eof' END AS beyond_eof_flag, CAST(rate_percent AS VARCHAR) || '%' AS error_rate, coalesce(e.n, 0) AS event_count, copy_done
FROM medium m LEFT JOIN (SELECT medium_hash, count(*) AS n FROM ev GROUP BY 1) e USING (medium_hash) WHERE has_problems OR e.n > 0 ORDER BY copy_done DESC NULLS FIRST, m.medium_hash""")
def medium_problems(k):
    e = k.problems.groupBy("medium_hash").agg(F.sum(F.json_array_length(F.get_json_object("problems", "$.diagnostic_events"))).alias("n"))
    both = k.medium.join(e, "medium_hash", "left").where("problems is not null or n > 0")
    return both.select(
        "medium_hash", "medium_human", F.when(_problem("beyond_eof_detected") == "true", "beyond_eof").alias("beyond_eof_flag"), F.concat(_problem("high_error_rate.rate_percent"), F.lit("%")).alias("error_rate"), F.coalesce("n", F.lit(0)).cast("long").alias("event_count"), "copy_done",
    ).orderBy(F.desc_nulls_first("copy_done"), "medium_hash")


@query("SELECT exception_type, count(*) AS count, count(DISTINCT medium_hash) AS media_affected, string_agg(DISTINCT action, ',' ORDER BY action) AS actions_taken FROM ev GROUP BY 1 ORDER BY count DESC, exception_type")
def exception_types(k):
    return k.events.groupBy("exception_type").agg(F.count("*").alias("count"), F.count_distinct("medium_hash").alias("media_affected"), _listed("action").alias("actions_taken")).orderBy(F.desc("count"), "exception_type")


@query("SELECT worker_id, count(*) AS events, count(DISTINCT medium_hash) AS media_processed, string_agg(DISTINCT action, ',' ORDER BY action) AS actions_taken FROM ev GROUP BY 1 ORDER BY events DESC, worker_id")
def events_per_worker(k):
    return k.events.groupBy("worker_id").agg(F.count("*").alias("events"), F.count_distinct("medium_hash").alias("media_processed"), _listed("action").alias("actions_taken")).orderBy(F.desc("events"), "worker_id")


@query("SELECT timestamp, medium_hash, ino AS inode, action, retry_count, exception_type AS exception FROM ev WHERE CAST(timestamp AS TIMESTAMP) > (SELECT max(CAST(timestamp AS TIMESTAMP)) FROM ev) - INTERVAL 24 HOUR")
def recent_events(k):
    """The last day before the newest event: 'now' is a parameter, so results repeat.  The times have one format, in which order of text is order of time."""
    start = k.events.agg(F.date_format(F.max("timestamp").cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS"), "yyyy-MM-dd'T'HH:mm:ss").alias("start"))
    return k.events.join(F.broadcast(start), F.col("timestamp") > F.col("start")).select("timestamp", "medium_hash", F.col("ino").alias("inode"), "action", "retry_count", F.col("exception_type").alias("exception"))


@query("""SELECT CASE WHEN action = 'diagnostic_skip' THEN 'Prevented infinite loop (skipped)' WHEN action = 'continuing' THEN 'Logged but continued' WHEN action = 'max_retries' THEN 'Hit max retries (failed)' ELSE action END AS outcome,
 count(*) AS count, round(100::DOUBLE * (count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE), 2) AS percentage FROM ev GROUP BY action ORDER BY count DESC, outcome""")
def events_pct_of_total(k):
    a = F.col("action")
    n = k.events.groupBy("action").agg(F.count("*").alias("count"))
    outcome = F.when(a == "diagnostic_skip", "Prevented infinite loop (skipped)").when(a == "continuing", "Logged but continued").when(a == "max_retries", "Hit max retries (failed)").otherwise(a)
    return n.select(outcome.alias("outcome"), "count", c.percent(F.col("count"), F.sum("count").over(W.partitionBy())).alias("percentage")).orderBy(F.desc("count"), "outcome")


_EVENTS = "WITH es AS (SELECT medium_hash, count(*) AS event_count, count(DISTINCT ino) AS problem_inodes, string_agg(DISTINCT action, ',' ORDER BY action) AS actions_taken, string_agg(DISTINCT exception_type, ',' ORDER BY exception_type) AS exception_types FROM ev GROUP BY 1), t AS (SELECT medium_hash, count(*) AS total_inodes, count(*) FILTER (WHERE copied) AS copied_inodes, count(*) FILTER (WHERE NOT copied) AS unclaimed FROM inode GROUP BY 1)"


def _summaries(k):
    e = k.events.groupBy("medium_hash").agg(F.count("*").alias("event_count"), F.count_distinct("ino").alias("problem_inodes"), _listed("action").alias("actions_taken"), _listed("exception_type").alias("exception_types"))
    t = k.inode.groupBy("medium_hash").agg(F.count("*").alias("total_inodes"), F.count_if("copied").alias("copied_inodes"), F.count_if(~F.col("copied")).alias("unclaimed"))
    return k.medium.join(e, "medium_hash", "left").join(t, "medium_hash", "left").na.fill(0, ["total_inodes", "copied_inodes", "unclaimed"])


@query(_EVENTS + """ SELECT medium_hash, medium_human, CASE WHEN beyond_eof THEN 'true' END AS beyond_eof_flag, CAST(rate_percent AS VARCHAR) AS error_rate, event_count, problem_inodes, actions_taken, exception_types, coalesce(total_inodes, 0) AS total_inodes, coalesce(copied_inodes, 0) AS copied_inodes, enum_done, copy_done
FROM medium LEFT JOIN es USING (medium_hash) LEFT JOIN t USING (medium_hash)""")
def medium_report(k):
    """The full diagnostic summary, of every medium; filter by ``medium_hash`` for one."""
    return _summaries(k).select("medium_hash", "medium_human", _problem("beyond_eof_detected").alias("beyond_eof_flag"), _problem("high_error_rate.rate_percent").alias("error_rate"), "event_count", "problem_inodes", "actions_taken", "exception_types", "total_inodes", "copied_inodes", "enum_done", "copy_done")


@query(_EVENTS + """ SELECT medium_hash, medium_human, coalesce(total_inodes, 0) AS total_inodes, coalesce(copied_inodes, 0) AS copied, coalesce(unclaimed, 0) AS unclaimed, CASE WHEN beyond_eof THEN 'true' END AS beyond_eof, CAST(rate_percent AS VARCHAR) AS error_rate, event_count AS diagnostic_events, enum_done, copy_done
FROM medium LEFT JOIN es USING (medium_hash) LEFT JOIN t USING (medium_hash)""")
def why_failing(k):
    return _summaries(k).select("medium_hash", "medium_human", "total_inodes", F.col("copied_inodes").alias("copied"), "unclaimed", _problem("beyond_eof_detected").alias("beyond_eof"), _problem("high_error_rate.rate_percent").alias("error_rate"), F.col("event_count").alias("diagnostic_events"), "enum_done", "copy_done")


@query("""WITH p AS (SELECT medium_hash, list_sort(list_distinct(flatten(list(checks)))) AS checks, list_sort(list(DISTINCT action)) AS actions FROM ev GROUP BY 1)
SELECT a.medium_hash AS medium_1, b.medium_hash AS medium_2, array_to_string(a.checks, ',') AS common_checks, array_to_string(a.actions, ',') AS common_actions FROM p a JOIN p b ON a.medium_hash < b.medium_hash AND list_has_any(a.checks, b.checks) WHERE len(a.checks) > 1""")
def array_overlap_pairs(k):
    """Media whose sets of checks overlap, with the first one's; asked once for each pair of distinct sets, of which there are few."""
    checks = k.events.select("medium_hash", F.explode("checks").alias("c")).groupBy("medium_hash").agg(F.array_sort(F.collect_set("c")).alias("checks"))
    p = checks.join(k.events.groupBy("medium_hash").agg(F.array_sort(F.collect_set("action")).alias("actions")), "medium_hash")
    meet = dedup.overlapping(p.select("checks").distinct(), "checks").where(F.size("checks") > 1)
    pairs = p.withColumnRenamed("medium_hash", "medium_1").join(meet, "checks").join(p.select(F.col("medium_hash").alias("medium_2"), F.col("checks").alias("others")), "others").where("medium_1 < medium_2")
    return pairs.select("medium_1", "medium_2", F.array_join("checks", ",").alias("common_checks"), F.array_join("actions", ",").alias("common_actions"))


@query("""SELECT i.medium_hash, i.ino, i.size, i.copied, i.claimed_by, CASE WHEN message IS NOT NULL THEN len(i.errors) END AS error_count, retry_count AS diagnostic_retry, action AS diagnostic_action, timestamp AS diagnostic_time, array_to_string(checks, ',') AS checks_performed FROM inode i JOIN ev e ON e.medium_hash = i.medium_hash AND e.ino = i.ino""")
def inodes_with_events(k):
    of = lambda name, kind: jsonb.field(F.col("value"), name, kind)
    events = jsonb.elements(k.problems, "problems", "$.diagnostic_events")
    e = events.select("medium_hash", of("ino", "bigint").alias("ino"), of("retry_count", "bigint").alias("diagnostic_retry"), of("action", "string").alias("diagnostic_action"), of("timestamp", "string").alias("diagnostic_time"), F.array_join(of("checks", "array<string>"), ",").alias("checks_performed"))
    n = F.when(F.col("message").isNotNull(), F.size("errors")).cast("long")
    return k.inode.join(e, ["medium_hash", "ino"]).select("medium_hash", "ino", "size", "copied", "claimed_by", n.alias("error_count"), "diagnostic_retry", "diagnostic_action", "diagnostic_time", "checks_performed")


@query("""SELECT medium_hash, medium_human, '{' || array_to_string(list_filter([CASE WHEN io_errors IS NOT NULL THEN '"io_errors":' || io_errors END, CASE WHEN fat_errors IS NOT NULL THEN '"fat_errors":' || fat_errors END,
 CASE WHEN error_files IS NOT NULL THEN '"error_files":[' || array_to_string(list_transform(range(1, error_files + 1), lambda i: '"f' || i || '"'), ',') || ']' END, CASE WHEN beyond_eof THEN '"beyond_eof_detected":true' END,
 CASE WHEN rate_percent IS NOT NULL THEN '"high_error_rate":{"rate_percent":' || rate_percent || ',"detected_at_count":' || detected_at_count || '}' END, CASE WHEN enum_failed THEN '"enum_failed":true' END], lambda x: x IS NOT NULL), ',') || '}' AS problems FROM medium WHERE has_problems""")
def problems_dump(k):
    """The rows of the JSON export; write them with ``sinks.export_json``."""
    return k.medium.where("problems is not null").select("medium_hash", "medium_human", "problems")


@query("""SELECT medium_hash, medium_human, ino AS inode, retry_count, action, timestamp, exception_type, exception_msg, '["' || array_to_string(checks, '","') || '"]' AS checks FROM ev JOIN medium USING (medium_hash)""")
def events_flat(k):
    """The rows of the CSV export; write them with ``sinks.export_csv``."""
    return _named(k).select("medium_hash", "medium_human", F.col("ino").alias("inode"), "retry_count", "action", "timestamp", "exception_type", "exception_msg", F.to_json("checks").alias("checks"))


@query("SELECT exception_type AS exception, count(*) AS occurrences, count(DISTINCT medium_hash) AS media_affected, string_agg(DISTINCT action, ',' ORDER BY action) AS actions_taken FROM ev WHERE CAST(timestamp AS TIMESTAMP) > (SELECT max(CAST(timestamp AS TIMESTAMP)) FROM ev) - INTERVAL 7 DAY GROUP BY 1 ORDER BY occurrences DESC, exception LIMIT 10")
def top_exceptions(k):
    start = k.events.agg(F.date_format(F.max("timestamp").cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS"), "yyyy-MM-dd'T'HH:mm:ss").alias("start"))
    recent = k.events.join(F.broadcast(start), F.col("timestamp") > F.col("start"))
    return recent.groupBy(F.col("exception_type").alias("exception")).agg(F.count("*").alias("occurrences"), F.count_distinct("medium_hash").alias("media_affected"), _listed("action").alias("actions_taken")).orderBy(F.desc("occurrences"), "exception").limit(10)


@query("SELECT 'Total media' AS metric, count(*) AS count FROM medium WHERE enum_done IS NOT NULL UNION ALL SELECT 'Media with diagnostics', count(*) FROM medium WHERE medium_hash IN (SELECT medium_hash FROM ev) UNION ALL SELECT 'Media with BEYOND_EOF', count(*) FROM medium WHERE beyond_eof UNION ALL SELECT 'Media with high error rate', count(*) FROM medium WHERE rate_percent IS NOT NULL")
def diagnostic_totals(k):
    """Four counts in one pass over the media."""
    seen = k.problems.select("medium_hash").distinct().withColumn("events", F.lit(True))
    n = k.medium.join(seen, "medium_hash", "left").agg(F.count("enum_done").alias("Total media"), F.count("events").alias("Media with diagnostics"), F.count_if(_problem("beyond_eof_detected") == "true").alias("Media with BEYOND_EOF"), F.count(_problem("high_error_rate")).alias("Media with high error rate"))
    return n.select(F.explode(F.array(*(F.struct(F.lit(x).alias("metric"), F.col(f"`{x}`").alias("count")) for x in n.columns))).alias("r")).select("r.*")


@query("SELECT medium_hash, medium_human, CASE WHEN copy_done IS NOT NULL THEN 'archived' WHEN enum_done IS NOT NULL THEN 'loaded' ELSE 'ready' END AS status, has_problems FROM medium WHERE enum_done IS NULL AND copy_done IS NULL AND NOT has_problems ORDER BY medium_human")
def ready_media(k):
    status = F.when(F.col("copy_done").isNotNull(), "archived").when(F.col("enum_done").isNotNull(), "loaded").otherwise("ready")
    return k.medium.where("enum_done is null and copy_done is null and problems is null").select("medium_hash", "medium_human", status.alias("status"), F.col("problems").isNotNull().alias("has_problems")).orderBy("medium_human")


@query("""SELECT CASE WHEN fat_errors IS NOT NULL THEN 'FAT errors' WHEN io_errors IS NOT NULL THEN 'I/O errors' WHEN enum_failed THEN 'Enumeration failed' ELSE 'Other' END AS problem_type, count(*) AS count FROM medium WHERE has_problems GROUP BY 1 ORDER BY count DESC, problem_type""")
def problem_precedence(k):
    """The first key that is there decides."""
    out = F
    for key, name in (("fat_errors", "FAT errors"), ("io_errors", "I/O errors"), ("boot_sector_corruption", "Boot sector bad"), ("erased_disk", "Erased/unformatted"), ("enum_failed", "Enumeration failed")):
        out = out.when(jsonb.has_key(F.col("problems"), key), name)
    return k.medium.where("problems is not null").groupBy(out.otherwise("Other").alias("problem_type")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "problem_type")


@query("SELECT count(*) AS media_processed, round(avg(copy_done - enum_done), 3) AS avg_processing_seconds, min(copy_done - enum_done) AS min_seconds, max(copy_done - enum_done) AS max_seconds FROM medium WHERE copy_done IS NOT NULL AND enum_done IS NOT NULL")
def processing_seconds(k):
    s = F.col("copy_done") - F.col("enum_done")
    return k.medium.where("copy_done is not null and enum_done is not null").agg(F.count("*").alias("media_processed"), F.round(F.avg(s), 3).alias("avg_processing_seconds"), F.min(s).alias("min_seconds"), F.max(s).alias("max_seconds"))


@query("SELECT medium_hash, medium_human, CAST(io_errors AS BIGINT) AS io_error_count, CAST(fat_errors AS BIGINT) AS fat_error_count, CAST(error_files AS BIGINT) AS error_file_count FROM medium WHERE io_errors IS NOT NULL OR fat_errors IS NOT NULL ORDER BY coalesce(io_errors, 0) + coalesce(fat_errors, 0) DESC, medium_hash")
def retry_patterns(k):
    io, fat = _problem("io_errors").cast("long"), _problem("fat_errors").cast("long")
    some = k.medium.where(jsonb.has_key(F.col("problems"), "io_errors") | jsonb.has_key(F.col("problems"), "fat_errors"))
    rows = some.select("medium_hash", "medium_human", io.alias("io_error_count"), fat.alias("fat_error_count"), F.json_array_length(_problem("error_files")).cast("long").alias("error_file_count"))
    return rows.orderBy(F.desc(F.coalesce("io_error_count", F.lit(0)) + F.coalesce("fat_error_count", F.lit(0))), "medium_hash")


@query("SELECT count(*) FILTER (WHERE copy_done IS NOT NULL) AS archived, count(*) FILTER (WHERE enum_done IS NOT NULL AND copy_done IS NULL) AS loaded, count(*) FILTER (WHERE enum_done IS NULL) AS not_started, count(*) FILTER (WHERE has_problems) AS with_problems, round(100::DOUBLE * (count(*) FILTER (WHERE copy_done IS NOT NULL)::DOUBLE / nullif(count(*)::DOUBLE, 0)), 2) AS success_rate FROM medium")
def overall_success(k):
    copied, listed = F.col("copy_done").isNotNull(), F.col("enum_done").isNotNull()
    n = k.medium.agg(F.count_if(copied).alias("archived"), F.count_if(listed & ~copied).alias("loaded"), F.count_if(~listed).alias("not_started"), F.count("problems").alias("with_problems"), F.count("*").alias("n"))
    return n.withColumn("success_rate", c.percent(F.col("archived"), F.col("n"))).drop("n")


@query("WITH w(medium_hash) AS (VALUES ('src1'), ('src2'), ('nowhere')) SELECT w.medium_hash, m.medium_human, m.copy_done IS NOT NULL AS completed, coalesce(m.has_problems, FALSE) AS has_problems FROM w LEFT JOIN medium m USING (medium_hash)")
def phase_progress(k):
    asked = k.spark.createDataFrame([("src1",), ("src2",), ("nowhere",)], "medium_hash string")
    return asked.join(k.medium, "medium_hash", "left").select("medium_hash", "medium_human", F.col("copy_done").isNotNull().alias("completed"), F.col("problems").isNotNull().alias("has_problems"))


@query("SELECT medium_hash, medium_human, copy_done, copy_done - enum_done AS processing_seconds FROM medium WHERE copy_done >= (SELECT max(copy_done) FROM medium) - 604800 ORDER BY copy_done DESC, medium_hash")
def recently_completed(k):
    newest = k.medium.agg(F.max("copy_done").alias("newest"))
    recent = k.medium.join(F.broadcast(newest), F.col("copy_done") >= F.col("newest") - 604800)
    return recent.select("medium_hash", "medium_human", "copy_done", (F.col("copy_done") - F.col("enum_done")).alias("processing_seconds")).orderBy(F.desc("copy_done"), "medium_hash")


@query("SELECT medium_hash, ino, action FROM ev WHERE list_contains(checks, 'detected_error')")
def events_with_error_check(k):
    """Array membership asked with the key operator."""
    return k.events.where(F.array_contains("checks", "detected_error")).select("medium_hash", "ino", "action")


def _diagnosed(name):
    return F.get_json_object("diagnostics", f"$.{name}")


@query("SELECT content_hash, string_agg(medium_hash, ',' ORDER BY medium_hash) AS duplicates, count(*) AS duplicate_count FROM medium WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_images(k):
    """Media whose images have one content."""
    doc = _diagnosed("content_hash")
    n = k.medium.where(doc.isNotNull()).groupBy(doc.alias("content_hash")).agg(F.array_join(F.array_sort(F.collect_list("medium_hash")), ",").alias("duplicates"), F.count("*").alias("duplicate_count"))
    return n.where("duplicate_count > 1")


@query("""WITH RECURSIVE h AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
e AS (SELECT user_id, i, value AS ema FROM h WHERE i = 1 UNION ALL SELECT h.user_id, h.i, 0.3::DOUBLE * h.value + (1::DOUBLE - 0.3::DOUBLE) * e.ema FROM e JOIN h ON h.user_id = e.user_id AND h.i = e.i + 1)
SELECT user_id, round(ema, 6) AS ema FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i DESC) AS rn FROM e) WHERE rn = 1""", on_catalog=False)
def ema_rate(k):
    """Moving average over all values of a user as one weighted sum, so that no array grows.

    A value's place from the end is its place in its day and the number of later
    days' values; so a user with many events is many groups.
    """
    e = k.table("events").select("user_id", "ts", "event_id", "value", F.to_date("ts").alias("day"))
    days = e.groupBy("user_id", "day").agg(F.count("*").alias("n"))
    later = days.select("user_id", "day", F.coalesce(F.sum("n").over(W.partitionBy("user_id").orderBy(F.desc("day")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("later"), F.sum("n").over(W.partitionBy("user_id")).alias("all"))
    own = e.withColumn("own", F.row_number().over(W.partitionBy("user_id", "day").orderBy(F.desc("ts"), F.desc("event_id")))).join(later, ["user_id", "day"])
    back = F.col("own") + F.col("later") - 1
    weight = F.pow(F.lit(0.7), back) * F.when(back == F.col("all") - 1, 1.0).otherwise(0.3)
    return own.groupBy("user_id").agg(F.round(F.sum(weight * F.col("value")), 6).alias("ema"))
