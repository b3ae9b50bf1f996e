"""Further queries: actions, inventories, extraction rates, backfills."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import blake3
from quarry.functions import columns as c
from quarry.operators import queue
from quarry.plans.dedup import new_vs_dedup_action
from quarry.plans.registry import query
from quarry.sources import blobs
from quarry.sources.catalog import sniff_sql
from quarry.sources.shared import shared_folder


@query("""WITH a AS (SELECT size, CASE WHEN fs_type = 'd' THEN 'create_directory' WHEN fs_type = 'l' THEN 'create_symlink' WHEN fs_type <> 'f' THEN 'record_special' WHEN size = 0 THEN 'handle_empty_file' WHEN blobid IS NULL THEN 'skip'
 WHEN row_number() OVER (PARTITION BY blobid ORDER BY ino, medium_hash) = 1 THEN 'copy_new_file' ELSE 'link_existing_file' END AS action FROM inode) SELECT action, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM a GROUP BY 1""")
def action_totals(k):
    return new_vs_dedup_action(k).join(k.inode.select("ino", "medium_hash", "size"), ["ino", "medium_hash"]).groupBy("action").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


@query("""WITH e AS (SELECT source AS medium_hash, '/' || lang || '/' || source || '/' || doc_id || '.txt' AS path FROM documents)
SELECT e.medium_hash, e.path FROM e LEFT JOIN path p ON p.path = e.path AND p.medium_hash = e.medium_hash WHERE p.path IS NULL""")
def expected_paths_missing(k):
    """A list of expected files, as it was written out with escapes, against the catalog's paths."""
    d = k.table("documents")
    expected = d.select(F.col("source").alias("medium_hash"), F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    stored = k.path.select("medium_hash", c.escaped_bytes(F.encode("path", "UTF-8")).alias("path"))
    return expected.join(stored, ["medium_hash", "path"], "left_anti")


@query("""WITH f AS (SELECT DISTINCT substr('./' || substr(blobid, 1, 2) || '/' || substr(blobid, 3, 2) || '/' || blobid, 9) AS blobid FROM blobs)
SELECT (SELECT count(*) FROM f) AS stored, (SELECT count(DISTINCT blobid) FROM inode) AS known, (SELECT count(DISTINCT i.blobid) FROM inode i JOIN f USING (blobid)) AS in_both""")
def by_hash_inventory(k):
    """Stored files by their names without the two folder levels, against the inodes' blobs."""
    files = k.blobs.select(F.concat(F.lit("./"), c.by_hash_path(F.col("blobid"))).alias("name"))
    stored = files.select(F.substring("name", 9, 64).alias("blobid")).distinct().withColumn("s", F.lit(1))
    known = k.inode.where("blobid is not null").select("blobid").distinct().withColumn("i", F.lit(1))
    return stored.join(known, "blobid", "full").agg(F.count("s").alias("stored"), F.count("i").alias("known"), F.count_if(F.col("s").isNotNull() & F.col("i").isNotNull()).alias("in_both"))


@query("""SELECT mime_type, count(*) AS n, count(*) FILTER (WHERE blobid IS NOT NULL) AS extracted, count(*) FILTER (WHERE status LIKE 'failed%') AS failed, round(100::DOUBLE * (count(*) FILTER (WHERE status LIKE 'failed%')::DOUBLE / nullif(count(*)::DOUBLE, 0)), 2) AS failed_pct,
CAST(coalesce(sum(size) FILTER (WHERE blobid IS NOT NULL), 0) AS BIGINT) AS bytes, count(DISTINCT blobid) AS uniq FROM inode WHERE mime_type IS NOT NULL GROUP BY 1""")
def archive_rates(k):
    has, failed = F.col("blobid").isNotNull(), F.col("status").startswith("failed")
    n = k.inode.where("mime_type is not null").groupBy("mime_type").agg(F.count("*").alias("n"), F.count_if(has).alias("extracted"), F.count_if(failed).alias("failed"), F.sum(F.when(has, F.col("size")).otherwise(0)).alias("bytes"), F.count_distinct("blobid").alias("uniq"))
    return n.withColumn("failed_pct", c.percent(F.col("failed"), F.col("n")))


_TYPED = f"WITH store AS (SELECT DISTINCT sha256(content) AS blobid, {sniff_sql('content')} AS mime FROM files WHERE d % 41 <> 5), f AS (SELECT DISTINCT i.blobid, s.mime FROM inode i LEFT JOIN store s USING (blobid) WHERE i.blobid IS NOT NULL AND i.mime_type IS NULL)"


def _archive(k):
    """The content store of the archive, but for what was lost of it, as files below a shared folder."""
    root = shared_folder(k.spark, "by-hash")
    blobs.store_blobs(k.files.where("d % 41 <> 5").select(F.sha2("content", 256).alias("blobid"), "content"), root).write.format("noop").mode("overwrite").save()
    return root


@query(_TYPED + " SELECT coalesce(i.mime_type, f.mime, 'none') AS mime_type, count(*) AS n FROM inode i LEFT JOIN f ON f.blobid = i.blobid GROUP BY 1")
def mime_backfill(k):
    """Types of the blobs that have none, by the first bytes of their files, for all their inodes; a lost file leaves them without."""
    found = blobs.typed_blobs(k.inode, _archive(k)).where("mime is not null")
    return queue.backfill_mime(k.inode, found).groupBy(F.coalesce("mime_type", F.lit("none")).alias("mime_type")).agg(F.count("*").alias("n"))


@query(_TYPED + """ SELECT CASE WHEN mime IS NULL THEN 'missing' WHEN mime = 'application/x-empty' THEN 'empty' ELSE 'detected' END AS outcome, coalesce(mime, 'none') AS mime_type, count(*) AS blobs FROM f GROUP BY ALL""")
def mime_outcomes(k):
    """What typing did to each distinct blob that had no type."""
    return blobs.typed_blobs(k.inode, _archive(k)).groupBy("outcome", F.coalesce("mime", F.lit("none")).alias("mime_type")).agg(F.count("*").alias("blobs"))


@query("SELECT blobid, count(*) AS n_hardlinks, coalesce(min(processed), 7) AS created FROM inode WHERE blobid IS NOT NULL GROUP BY 1")
def populated_blobs(k):
    return queue.populate_blobs(k.inode, 7)


@query("SELECT count(*) AS n, count(DISTINCT blobid) AS uniq, round(1::DOUBLE - count(DISTINCT blobid)::DOUBLE / nullif(count(blobid)::DOUBLE, 0), 4) AS ratio FROM (SELECT blobid FROM inode WHERE blobid IS NOT NULL ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 500)")
def sampled_dedup_ratio(k):
    """The ratio of a seeded sample of 500 rows, as a dashboard shows it."""
    some = k.inode.where("blobid is not null").orderBy(F.md5(F.col("id").cast("string")), "id").limit(500).agg(F.count("*").alias("n"), F.count_distinct("blobid").alias("uniq"))
    return some.withColumn("ratio", F.round(F.lit(1.0) - c.ratio(F.col("uniq"), F.col("n")), 4))


@query("SELECT 'checkpoint' AS what, checks[1] AS check_name, count(*) AS n FROM ev WHERE retry_count = 10 GROUP BY ALL")
def checkpoint_checks(k):
    return k.events.where("retry_count = 10").groupBy(F.lit("checkpoint").alias("what"), F.element_at("checks", 1).alias("check_name")).agg(F.count("*").alias("n"))


@query("SELECT (SELECT CAST(sum(size) AS BIGINT) FROM matrix) AS listed, (SELECT CAST(sum(s) AS BIGINT) FROM (SELECT max(size) AS s FROM matrix GROUP BY blobid)) AS stored, (SELECT count(*) FROM inode WHERE nlink > 1) AS hardlinked")
def listed_vs_stored(k):
    per = k.matrix.groupBy("blobid").agg(F.sum("size").alias("l"), F.max("size").alias("s")).agg(F.sum("l").alias("listed"), F.sum("s").alias("stored"))
    return per.crossJoin(k.inode.agg(F.count_if(F.col("nlink") > 1).alias("hardlinked")))


def _diagnosed(name):
    return F.get_json_object("diagnostics", f"$.{name}")


@query("SELECT filesystem AS fs_type, count(*) AS count FROM medium GROUP BY 1 ORDER BY count DESC, fs_type")
def filesystem_types(k):
    kind = F.regexp_extract(_diagnosed("blkid"), "TYPE=([^ ]+)", 1)
    return k.medium.where(_diagnosed("blkid").isNotNull()).groupBy(kind.alias("fs_type")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "fs_type")


@query("SELECT medium_hash, medium_human FROM medium WHERE filesystem = 'hfsplus'")
def hfs_images(k):
    return k.medium.where(_diagnosed("blkid").like("%TYPE=hfsplus%")).select("medium_hash", "medium_human")


@query("""SELECT medium_hash, CASE WHEN image_size_bytes < 10240 THEN image_size_bytes || ' bytes' WHEN (image_size_bytes // 512 + 1) // 2 < 10240 THEN ((image_size_bytes // 512 + 1) // 2) || ' kB' WHEN (image_size_bytes // 524288 + 1) // 2 < 10240 THEN ((image_size_bytes // 524288 + 1) // 2) || ' MB' ELSE ((image_size_bytes // 536870912 + 1) // 2) || ' GB' END AS size FROM medium ORDER BY image_size_bytes DESC, medium_hash LIMIT 10""")
def image_sizes(k):
    n = _diagnosed("image_size_bytes").cast("long")
    return k.medium.where(n.isNotNull()).orderBy(F.desc(n), "medium_hash").limit(10).select("medium_hash", c.size_pretty(n).alias("size"))


@query("SELECT extraction_method, count(*) AS archives, round(avg(files_extracted), 4) AS avg_files, CAST(sum(files_extracted) AS BIGINT) AS total_files FROM blobs WHERE extraction_status = 'complete' GROUP BY 1")
def extraction_stats(k):
    return k.blobs.where("extraction_status = 'complete'").groupBy("extraction_method").agg(F.count("*").alias("archives"), F.round(F.avg("files_extracted"), 4).alias("avg_files"), F.sum("files_extracted").alias("total_files"))


@query("SELECT extraction_error, count(*) AS n, round(100::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM blobs WHERE extraction_status IN ('complete', 'failed', 'pilot'))::DOUBLE), 2) AS pct FROM blobs WHERE extraction_status = 'failed' GROUP BY 1 ORDER BY n DESC, extraction_error")
def extraction_failures(k):
    """One pass: the tried ones without an error are a group of their own until the share is known."""
    n = k.blobs.where("extraction_status in ('complete', 'failed', 'pilot')").groupBy("extraction_status", "extraction_error").agg(F.count("*").alias("n"))
    n = n.withColumn("pct", c.percent(F.col("n"), F.sum("n").over(W.partitionBy())))
    return n.where("extraction_status = 'failed'").select("extraction_error", "n", "pct").orderBy(F.desc("n"), "extraction_error")


@query("SELECT count(*) AS blobs_processed, round((max(extracted_at) - min(extracted_at)) / 3600, 4) AS hours, round(count(*) / nullif((max(extracted_at) - min(extracted_at)) / 3600, 0), 4) AS blobs_per_hour FROM blobs WHERE extraction_status IN ('complete', 'pilot')")
def extraction_rate(k):
    hours = (F.max("extracted_at") - F.min("extracted_at")) / 3600
    return k.blobs.where("extraction_status in ('complete', 'pilot')").agg(F.count("*").alias("blobs_processed"), F.round(hours, 4).alias("hours"), F.round(c.ratio(F.count("*"), hours), 4).alias("blobs_per_hour"))


@query("SELECT CAST(sum(files_extracted) AS BIGINT) AS total_files_extracted, count(DISTINCT blobid) AS unique_blobs_created, round(100::DOUBLE * (1 - count(DISTINCT blobid)::DOUBLE / sum(files_extracted)::DOUBLE), 2) AS dedup_percentage FROM blobs WHERE extraction_status = 'complete' AND extracted_at > (SELECT min(extracted_at) FROM blobs WHERE extraction_status = 'pilot')")
def extraction_dedup(k):
    done = _after_pilot(k).where("extraction_status = 'complete'").agg(F.sum("files_extracted").alias("total_files_extracted"), F.count_distinct("blobid").alias("unique_blobs_created"))
    return done.withColumn("dedup_percentage", F.round(F.lit(100.0) * (F.lit(1.0) - c.ratio(F.col("unique_blobs_created"), F.col("total_files_extracted"))), 2))


def _after_pilot(k):
    start = k.blobs.where("extraction_status = 'pilot'").agg(F.min("extracted_at").alias("start"))
    return k.blobs.join(F.broadcast(start), F.col("extracted_at") > F.col("start"))


@query("""SELECT count(*) FILTER (WHERE is_intermediate) AS intermediate_count, count(*) FILTER (WHERE NOT is_intermediate) AS final_count, CAST(coalesce(sum(i.size) FILTER (WHERE is_intermediate), 0) AS BIGINT) AS intermediate_bytes, CAST(coalesce(sum(i.size) FILTER (WHERE NOT is_intermediate), 0) AS BIGINT) AS final_bytes,
round(100::DOUBLE * (coalesce(sum(i.size) FILTER (WHERE is_intermediate), 0)::DOUBLE / nullif(sum(i.size)::DOUBLE, 0)), 2) AS intermediate_pct FROM blobs b JOIN inode i USING (blobid) WHERE b.extracted_at > (SELECT min(extracted_at) FROM blobs WHERE extraction_status = 'pilot')""")
def intermediate_overhead(k):
    both = _after_pilot(k).select("blobid", "is_intermediate").join(k.inode.where("blobid is not null").select("blobid", "size"), "blobid")
    mid = F.col("is_intermediate")
    n = both.agg(F.count_if(mid).alias("intermediate_count"), F.count_if(~mid).alias("final_count"), F.coalesce(F.sum(F.when(mid, F.col("size"))), F.lit(0)).alias("intermediate_bytes"), F.coalesce(F.sum(F.when(~mid, F.col("size"))), F.lit(0)).alias("final_bytes"))
    return n.withColumn("intermediate_pct", c.percent(F.col("intermediate_bytes"), F.col("intermediate_bytes") + F.col("final_bytes")))


@query(f"SELECT CASE WHEN size % 10 = 0 THEN sha256('') ELSE sha256(html) END AS blobid, CASE WHEN size % 10 = 0 THEN 'application/x-empty' ELSE {sniff_sql('encode(html)')} END AS mime_type, page_id FROM (SELECT page_id, html, length(html) AS size FROM pages)", on_catalog=False)
def file_identities(k):
    """Files whose size is given as 0 are the empty file, whatever is there."""
    size = F.when(F.length("html") % 10 == 0, 0).otherwise(F.length("html"))
    return k.table("pages").select("page_id", c.identity(size, F.col("html")).alias("i")).select("i.*", "page_id")


@query(None)
def blake3_ids(k):
    """BLAKE3 of every document, at once and out of parts of 4,096 bytes (no SQL twin; tests compute it anew)."""
    size = 4096
    d = k.table("documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    whole = d.select("doc_id", F.octet_length("content").alias("n_bytes"), blake3.content_id(F.col("content")).alias("blobid"))
    last = F.greatest(F.lit(0), F.floor((F.octet_length("content") - 1) / size).cast("int"))
    parts = d.select(F.col("doc_id").alias("file"), "content", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    parts = parts.select("file", "part", F.substring("content", F.col("part") * size + 1, F.lit(size)).alias("content"))
    merged = blake3.merge_parts(blake3.part_values(parts, size)).select(F.col("file").alias("doc_id"), F.col("blobid").alias("by_parts"))
    return whole.join(merged, "doc_id").select("doc_id", "n_bytes", "blobid", "by_parts")
