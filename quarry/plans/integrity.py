"""Integrity and verification queries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import integrity, queue
from quarry.plans.registry import query
from quarry.sources import raw, shared, sinks, store


@query("SELECT blobid, count(DISTINCT size) AS sizes FROM inode WHERE blobid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT size) > 1 ORDER BY 1")
def hash_size_conflicts(k):
    return k.inode.where("blobid is not null").groupBy("blobid").agg(F.count_distinct("size").alias("sizes")).where("sizes > 1").orderBy("blobid")


@query("SELECT count(*) AS blobs, count(*) FILTER (WHERE lo = hi) AS one_size FROM (SELECT blobid, min(size) AS lo, max(size) AS hi FROM inode WHERE blobid IS NOT NULL GROUP BY 1)")
def hash_size_consistency(k):
    n = k.inode.where("blobid is not null").groupBy("blobid").agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    return n.agg(F.count("*").alias("blobs"), F.count_if(F.col("lo") == F.col("hi")).alias("one_size"))


@query("SELECT b.blobid FROM blobs b WHERE NOT EXISTS (SELECT 1 FROM inode i WHERE i.blobid = b.blobid)")
def unreferenced_blobs(k):
    return k.blobs.join(k.inode.select("blobid"), "blobid", "left_anti").select("blobid")


@query("SELECT i.medium_hash, count(*) AS n FROM inode i WHERE i.medium_hash IN (SELECT medium_hash FROM medium WHERE copy_done IS NULL) GROUP BY 1")
def incomplete_semi(k):
    return k.inode.join(k.medium.where("copy_done is null").select("medium_hash"), "medium_hash", "left_semi").groupBy("medium_hash").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT source AS k, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT medium_hash AS k, count(i.ino) AS n FROM medium m LEFT JOIN inode i USING (medium_hash) GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n, coalesce(a.n, 0) = coalesce(b.n, 0) AS same FROM a FULL OUTER JOIN b ON a.k = b.k""")
def count_reconcile_full_outer(k):
    """What was enumerated of each medium against what its inodes are."""
    loaded = k.medium.select("medium_hash").join(k.inode.select("medium_hash", "ino"), "medium_hash", "left").groupBy(F.col("medium_hash").alias("k")).agg(F.count("ino").alias("n"))
    return integrity.reconcile(k.table("documents").groupBy(F.col("source").alias("k")).agg(F.count("*").alias("n")), loaded, "k")


@query("SELECT DISTINCT i.blobid FROM inode i WHERE substr(i.blobid, 1, 12) IN (SELECT substr(blobid, 1, 12) FROM blobs WHERE last_checked IS NULL)")
def short_hash_lookup(k):
    short = k.blobs.where("last_checked is null").select(F.substring("blobid", 1, 12).alias("short"))
    return integrity.full_hashes(short, k.inode.where("blobid is not null").select("blobid").distinct())


@query("SELECT 'inode blobs' AS what, count(DISTINCT blobid) AS n FROM inode UNION ALL SELECT 'blobs', count(*) FROM blobs UNION ALL SELECT 'hardlinks', CAST(sum(n_hardlinks) AS BIGINT) FROM blobs UNION ALL SELECT 'inodes with a blob', count(blobid) FROM inode")
def source_derived_totals(k):
    label = lambda df, what, n: df.agg(n.alias("n")).select(F.lit(what).alias("what"), "n")
    return label(k.inode, "inode blobs", F.count_distinct("blobid")).unionByName(label(k.blobs, "blobs", F.count("*"))).unionByName(label(k.blobs, "hardlinks", F.sum("n_hardlinks"))).unionByName(label(k.inode, "inodes with a blob", F.count("blobid")))


@query("SELECT count(*) FILTER (WHERE NOT coalesce(external_copied, FALSE)) AS to_copy, count(*) FILTER (WHERE NOT coalesce(external_copied, FALSE) AND NOT coalesce(external_copy_failed, FALSE)) AS to_try, count(*) FILTER (WHERE external_copied) AS copied FROM blobs")
def pending_backup(k):
    done, failed = F.coalesce("external_copied", F.lit(False)), F.coalesce("external_copy_failed", F.lit(False))
    return k.blobs.agg(F.count_if(~done).alias("to_copy"), F.count_if(~done & ~failed).alias("to_try"), F.count_if(done).alias("copied"))


@query("SELECT m.medium_hash, count(i.id) AS file_count FROM medium m LEFT JOIN inode i ON i.medium_hash = m.medium_hash WHERE m.enum_done IS NOT NULL GROUP BY m.medium_hash HAVING count(i.id) = 0")
def media_without(k):
    """Enumerated media that have no inode."""
    return k.medium.where("enum_done is not null").join(k.inode.select("medium_hash"), "medium_hash", "left_anti").select("medium_hash", F.lit(0).cast("long").alias("file_count"))


_ARCHIVES = ("application/gzip", "application/x-bzip2", "application/x-tar", "application/zip")


@query(f"""WITH s AS (SELECT blobid, mime_type, row_number() OVER (PARTITION BY mime_type ORDER BY md5(blobid || '7'), blobid) AS rn FROM blobs WHERE mime_type IN {_ARCHIVES} AND extraction_status = 'pending')
SELECT blobid, mime_type, 'pilot' AS extraction_status FROM s WHERE rn <= 250""")
def stratified_sample_hash(k):
    """The pilot of an extraction: up to 250 pending archives of each type."""
    pending = k.blobs.where(F.col("mime_type").isin(*_ARCHIVES) & (F.col("extraction_status") == "pending"))
    return integrity.stratified(pending.select("mime_type", "blobid"), "mime_type", "blobid", 250, seed=7).select("blobid", "mime_type", F.lit("pilot").alias("extraction_status"))


@query("SELECT d.doc_id, l.doc_id IS NULL AS never FROM documents d LEFT JOIN labels l USING (doc_id) ORDER BY l.doc_id NULLS FIRST, d.doc_id LIMIT 25", on_catalog=False)
def never_first(k):
    seen = k.table("labels").select("doc_id", F.col("doc_id").alias("l"))
    return k.table("documents").select("doc_id").join(seen, "doc_id", "left").orderBy(F.asc_nulls_first("l"), "doc_id").limit(25).select("doc_id", F.col("l").isNull().alias("never"))


@query("SELECT CAST(sum(CASE WHEN i % 7 <> 0 THEN size ELSE 0 END) AS BIGINT) AS rescued, CAST(sum(size) AS BIGINT) AS total, floor(CAST(sum(CASE WHEN i % 7 <> 0 THEN size ELSE 0 END) AS DOUBLE) * 10000 / sum(size)) / 100 AS pct, CASE WHEN floor(CAST(sum(CASE WHEN i % 7 <> 0 THEN size ELSE 0 END) AS DOUBLE) * 10000 / sum(size)) / 100 >= 90 THEN 'incomplete' WHEN floor(CAST(sum(CASE WHEN i % 7 <> 0 THEN size ELSE 0 END) AS DOUBLE) * 10000 / sum(size)) / 100 >= 20 THEN 'corrupt' ELSE 'failed' END AS health FROM (SELECT doc_id AS i, n_chars AS size FROM documents)", on_catalog=False)
def mapfile_health(k):
    from quarry.sources.raw import mapfile_rows, rescue_summary

    lines = k.table("documents").select(F.concat(F.lit("0x"), F.hex("doc_id"), F.lit("  0x"), F.hex("n_chars"), F.when(F.col("doc_id") % 7 != 0, "  +").otherwise("  -")).alias("value"))
    return rescue_summary(mapfile_rows(lines))


_PICK = """WITH newest AS (SELECT b.blobid, max(i.processed) AS latest FROM blobs b JOIN inode i ON i.blobid = b.blobid WHERE i.processed IS NOT NULL GROUP BY b.blobid),
picked AS (SELECT blobid FROM blobs WHERE substr(md5(blobid || '7'), 1, 2) < '40' ORDER BY md5(blobid || '7'), blobid LIMIT 5),
pool AS (SELECT blobid, 0 AS o FROM picked UNION ALL SELECT * FROM (SELECT blobid, 1 AS o FROM blobs WHERE last_checked IS NULL AND blobid NOT IN (SELECT blobid FROM picked) ORDER BY blobid LIMIT 5))
SELECT 'oldest' AS mode, blobid FROM (SELECT blobid FROM blobs ORDER BY last_checked NULLS FIRST, blobid LIMIT 5) UNION ALL SELECT 'newest', blobid FROM (SELECT blobid FROM newest ORDER BY latest DESC, blobid LIMIT 5)
UNION ALL SELECT 'never', blobid FROM (SELECT blobid FROM blobs WHERE last_checked IS NULL ORDER BY blobid LIMIT 5) UNION ALL SELECT 'random', blobid FROM (SELECT blobid FROM pool ORDER BY o, blobid LIMIT 5)"""


@query(_PICK)
def verify_selection_modes(k):
    modes = [integrity.select_blobs(k.blobs, m, 5, seed=7, inode=k.inode).select(F.lit(m).alias("mode"), "blobid") for m in ("oldest", "newest", "never", "random")]
    return modes[0].unionByName(modes[1]).unionByName(modes[2]).unionByName(modes[3])


_LOST = "WITH lost AS (SELECT i.* FROM inode i LEFT JOIN blobs b USING (blobid) WHERE i.blobid IS NOT NULL AND b.blobid IS NULL AND i.status = 'success')"


@query(_LOST + " SELECT medium_hash, any_value(medium_human) AS medium_human, count(DISTINCT blobid) AS unique_orphaned_blobids, count(*) AS orphaned_files, CAST(sum(size) AS BIGINT) AS total_bytes FROM lost LEFT JOIN medium USING (medium_hash) GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20")
def orphans_anti(k):
    n = integrity.orphans(k.inode, k.blobs).groupBy("medium_hash").agg(F.count_distinct("blobid").alias("unique_orphaned_blobids"), F.count("*").alias("orphaned_files"), F.sum("size").alias("total_bytes"))
    return n.join(k.medium.select("medium_hash", "medium_human"), "medium_hash", "left").select("medium_hash", "medium_human", "unique_orphaned_blobids", "orphaned_files", "total_bytes").orderBy(F.desc("unique_orphaned_blobids"), "medium_hash").limit(20)


@query(_LOST + " SELECT count(DISTINCT blobid) AS unique_orphaned_blobids, count(*) AS total_orphaned_inode_rows, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_orphaned_bytes, count(*) FILTER (WHERE processed IS NULL) AS no_timestamp, count(processed) AS has_timestamp FROM lost")
def orphan_summary(k):
    return integrity.orphans(k.inode, k.blobs).agg(F.count_distinct("blobid").alias("unique_orphaned_blobids"), F.count("*").alias("total_orphaned_inode_rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_orphaned_bytes"), F.count_if(F.col("processed").isNull()).alias("no_timestamp"), F.count("processed").alias("has_timestamp"))


@query(_LOST + " SELECT blobid, count(*) AS inode_count, min(size) AS min_size, max(size) AS max_size FROM lost GROUP BY 1 ORDER BY inode_count DESC, blobid LIMIT 10")
def orphan_sample(k):
    return integrity.orphans(k.inode, k.blobs).groupBy("blobid").agg(F.count("*").alias("inode_count"), F.min("size").alias("min_size"), F.max("size").alias("max_size")).orderBy(F.desc("inode_count"), "blobid").limit(10)


@query(_LOST + " SELECT CAST(DATE '1970-01-01' + CAST(copy_done // 86400 AS INTEGER) AS VARCHAR) AS copy_date, count(DISTINCT blobid) AS unique_orphaned_blobids, count(*) AS orphaned_files FROM lost JOIN medium USING (medium_hash) WHERE copy_done IS NOT NULL GROUP BY 1 ORDER BY copy_date DESC LIMIT 20")
def orphan_timeline(k):
    dated = integrity.orphans(k.inode, k.blobs).join(k.medium.where("copy_done is not null").select("medium_hash", "copy_done"), "medium_hash")
    return dated.groupBy(c.day_of(F.col("copy_done")).cast("string").alias("copy_date")).agg(F.count_distinct("blobid").alias("unique_orphaned_blobids"), F.count("*").alias("orphaned_files")).orderBy(F.desc("copy_date")).limit(20)


_HOUR = "(SELECT max(processed) - 3600 FROM inode)"


@query(f"""SELECT (SELECT count(*) FROM inode i LEFT JOIN blobs b USING (blobid) WHERE i.copied AND i.blobid IS NOT NULL AND b.blobid IS NULL) AS orphaned_count,
(SELECT count(*) FROM inode WHERE status = 'success' AND copied AND processed > {_HOUR}) AS recent_success, (SELECT count(*) FROM blobs WHERE blobid IN (SELECT blobid FROM inode WHERE processed > {_HOUR} AND blobid IS NOT NULL)) AS recent_blobs,
(SELECT count(*) FROM blobs WHERE coalesce(external_copied, FALSE) = FALSE AND blobid IN (SELECT blobid FROM inode WHERE processed > {_HOUR} AND blobid IS NOT NULL)) AS pending_backup""")
def last_hour_checks(k):
    """The last hour before the newest row."""
    start = k.inode.agg((F.max("processed") - 3600).alias("start"))
    recent = k.inode.join(F.broadcast(start), F.col("processed") > F.col("start"))
    lost = k.inode.where("copied and blobid is not null").join(k.blobs.select("blobid"), "blobid", "left_anti").agg(F.count("*").alias("orphaned_count"))
    good = recent.where("status = 'success' and copied").agg(F.count("*").alias("recent_success"))
    new = k.blobs.join(recent.where("blobid is not null").select("blobid"), "blobid", "left_semi").agg(F.count("*").alias("recent_blobs"), F.count_if(~F.coalesce(F.col("external_copied"), F.lit(False))).alias("pending_backup"))
    return lost.crossJoin(good).crossJoin(new)  # of one row each


@query("SELECT DISTINCT blobid FROM inode WHERE blobid NOT IN (SELECT blobid FROM blobs)")
def orphans_not_in(k):
    """NOT IN as SQL has it (see ``integrity.not_in``)."""
    return integrity.not_in(k.inode.select("blobid").distinct(), "blobid", k.blobs.select("blobid"))


@query("""SELECT 'blobs' AS list, count(*) AS n FROM inode WHERE blobid NOT IN (SELECT blobid FROM blobs) UNION ALL SELECT 'inodes, nulls among them', count(*) FROM blobs WHERE blobid NOT IN (SELECT blobid FROM inode)
UNION ALL SELECT 'inodes that have one', count(*) FROM blobs WHERE blobid NOT IN (SELECT blobid FROM inode WHERE blobid IS NOT NULL) UNION ALL SELECT 'nothing', count(*) FROM inode WHERE blobid NOT IN (SELECT blobid FROM blobs WHERE n_hardlinks < 0)""")
def not_in_lists(k):
    """NOT IN over lists with a null, without one, and over an empty list."""
    count = lambda name, rows, listed: integrity.not_in(rows.select("blobid"), "blobid", listed.select("blobid")).agg(F.count("*").alias("n")).select(F.lit(name).alias("list"), "n")
    have = k.inode.where("blobid is not null")
    return count("blobs", k.inode, k.blobs).unionByName(count("inodes, nulls among them", k.blobs, k.inode)).unionByName(count("inodes that have one", k.blobs, have)).unionByName(count("nothing", k.inode, k.blobs.where("n_hardlinks < 0")))


@query("WITH s AS (SELECT blobid FROM blobs WHERE last_checked IS NULL ORDER BY blobid LIMIT 20) SELECT p.blobid, count(DISTINCT p.path) AS n_paths, string_agg(DISTINCT p.path, ',' ORDER BY p.path) AS paths FROM path p JOIN s USING (blobid) WHERE p.exclude_reason IS NULL GROUP BY ALL")
def verify_paths(k):
    picked = integrity.select_blobs(k.blobs, "never", 20)
    return k.path.where("exclude_reason is null").join(picked, "blobid", "left_semi").groupBy("blobid").agg(F.count_distinct("path").alias("n_paths"), F.array_join(F.array_sort(F.collect_set("path")), ",").alias("paths"))


@query("WITH p AS (SELECT DISTINCT blobid, path FROM path WHERE blobid IS NOT NULL AND exclude_reason IS NULL) SELECT blobid, count(*) AS n_paths, count(*) FILTER (WHERE length(path) % 5 = 0) AS n_missing, count(*) FILTER (WHERE length(path) % 5 = 0) = 0 AS ok FROM p GROUP BY 1")
def verification_results(k):
    paths = k.path.where("blobid is not null and exclude_reason is null").select("blobid", "path").distinct()
    return integrity.verify(paths, paths.where(F.length("path") % 5 != 0).select("path"))


@query("SELECT blobid, n_hardlinks FROM blobs WHERE blobid IN (SELECT trim(r) FROM (SELECT ' ' || sha256(r_name) || ' ' AS r FROM region))")
def asked_blobs(k):
    """Blobs of a list of ids as it is read from a file."""
    lines = k.table("region").select(F.concat(F.lit(" "), F.sha2("r_name", 256), F.lit(" ")).alias("value")).unionByName(k.spark.createDataFrame([("",), ("  ",)], "value string"))
    return integrity.asked_blobs(k.blobs, lines).select("blobid", "n_hardlinks")


@query("""WITH log AS (SELECT substr(blobid, 1, 12) AS short FROM inode WHERE blobid IS NOT NULL AND ino % 5 = 0) SELECT DISTINCT i.blobid FROM inode i WHERE substr(i.blobid, 1, 12) IN (SELECT short FROM log)""")
def parsed_log_hashes(k):
    """A verification log, parsed to short ids and looked up whole."""
    log = k.inode.where("blobid is not null").select(F.struct(F.struct(F.struct(F.when(F.col("ino") % 5 == 0, "ERROR").otherwise("INFO").alias("name")).alias("level"), F.struct(F.col("blobid").alias("blob")).alias("extra")).alias("record")).alias("l")).select("l.record")
    return integrity.full_hashes(raw.missing_blobs(log), k.inode.where("blobid is not null").select("blobid").distinct())


@query("SELECT medium_hash, count(*) AS old_n, count(*) AS new_n, TRUE AS same FROM inode GROUP BY 1")
def copied_media(k):
    """All media written partitioned and counted on both sides."""
    return sinks.copy_media(k.inode.drop("errors"), shared.shared_folder(k.spark, "media"))


@query("SELECT id, ino, size FROM inode WHERE medium_hash = 'src3'")
def medium_partition(k):
    """One medium of a partitioned table: the filter prunes all other folders."""
    at = shared.shared_folder(k.spark, "media")
    sinks.write_media(k.inode.select("medium_hash", "id", "ino", "size"), at)
    return k.spark.read.parquet(at).where("medium_hash = 'src3'").select("id", "ino", "size")


@query("SELECT count(*) FILTER (WHERE status NOT IN ('pending', 'success', 'failed_retryable', 'failed_permanent')) AS bad_status, count(*) FILTER (WHERE error_type NOT IN ('path_error', 'io_error', 'hash_error', 'permission_error', 'unknown')) AS bad_error_type, count(*) FILTER (WHERE fs_type NOT IN ('d', 'f', 'l', 's', 'p', 'b', 'c', 'u')) AS bad_fs_type, count(*) FILTER (WHERE (status = 'success' AND blobid IS NULL) OR (status IN ('failed_retryable', 'failed_permanent') AND blobid IS NOT NULL)) AS invalid_states FROM inode")
def invalid_states(k):
    """Rows against each check of the state model; ``integrity.violations`` has the rows themselves."""
    s = F.col("status")
    outside = lambda x, allowed: F.count_if(F.col(x).isNotNull() & ~F.col(x).isin(*allowed))
    wrong = ((s == "success") & F.col("blobid").isNull()) | (s.isin("failed_retryable", "failed_permanent") & F.col("blobid").isNotNull())
    return k.inode.agg(outside("status", c.STATUSES).alias("bad_status"), outside("error_type", c.ERROR_TYPES).alias("bad_error_type"), outside("fs_type", c.FS_TYPES).alias("bad_fs_type"), F.count_if(wrong).alias("invalid_states"))


@query("SELECT p.medium_hash, count(*) AS violations FROM path p LEFT JOIN (SELECT * FROM inode WHERE id % 29 <> 0) i ON p.medium_hash = i.medium_hash AND p.ino = i.ino WHERE i.ino IS NULL GROUP BY 1")
def fk_violations(k):
    """Paths without their inode, here with some inodes taken away."""
    lost = k.path.join(k.inode.where("id % 29 <> 0").select("medium_hash", "ino"), ["medium_hash", "ino"], "left_anti")
    return lost.groupBy("medium_hash").agg(F.count("*").alias("violations"))


@query("""WITH o AS (SELECT medium_hash, count(*) AS a FROM inode GROUP BY 1), n AS (SELECT medium_hash, count(*) AS b FROM inode WHERE medium_hash <> 'src2' GROUP BY 1), op AS (SELECT medium_hash, count(*) AS x FROM path WHERE medium_hash <> 'src3' GROUP BY 1), np AS (SELECT medium_hash, count(*) AS y FROM path WHERE ino % 50 <> 0 GROUP BY 1)
SELECT medium_hash, coalesce(a, 0) AS old_inodes, coalesce(b, 0) AS new_inodes, coalesce(x, 0) AS old_paths, coalesce(y, 0) AS new_paths, coalesce(a, 0) = coalesce(b, 0) AS inode_match, coalesce(x, 0) = coalesce(y, 0) AS path_match FROM o FULL OUTER JOIN n USING (medium_hash) FULL OUTER JOIN op USING (medium_hash) FULL OUTER JOIN np USING (medium_hash)""")
def table_copies_reconciled(k):
    """Old and new counts of two tables by medium, in a chain of full joins."""
    count = lambda df, name: df.groupBy("medium_hash").agg(F.count("*").alias(name))
    sides = [count(k.inode, "old_inodes"), count(k.inode.where("medium_hash <> 'src2'"), "new_inodes"), count(k.path.where("medium_hash <> 'src3'"), "old_paths"), count(k.path.where("ino % 50 <> 0"), "new_paths")]
    out = sides[0]
    for side in sides[1:]:
        out = out.join(side, "medium_hash", "full")
    out = out.na.fill(0)
    return out.select("*", (F.col("old_inodes") == F.col("new_inodes")).alias("inode_match"), (F.col("old_paths") == F.col("new_paths")).alias("path_match"))


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY medium_hash, ino) AS i, medium_hash, ino, size, copied FROM inode ORDER BY medium_hash, ino LIMIT 10), b AS (SELECT row_number() OVER (ORDER BY medium_hash, ino) AS i, medium_hash, ino, size, copied FROM inode WHERE id % 3 <> 0 ORDER BY medium_hash, ino LIMIT 10)
SELECT bool_and(a.medium_hash = b.medium_hash AND a.ino = b.ino AND a.size = b.size AND a.copied = b.copied) AS sample_matches, count(*) AS n FROM a JOIN b USING (i)""")
def sample_bool_and(k):
    """The first ten rows of two tables, side by side."""
    first = lambda df, x: df.orderBy("medium_hash", "ino").limit(10).select(F.row_number().over(W.orderBy("medium_hash", "ino")).alias("i"), F.struct("medium_hash", "ino", "size", "copied").alias(x))
    both = first(k.inode, "a").join(first(k.inode.where("id % 3 <> 0"), "b"), "i")
    return both.agg(F.bool_and(F.col("a") == F.col("b")).alias("sample_matches"), F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count(DISTINCT blobid) AS blobs, count(DISTINCT medium_hash) AS media, CAST(sum(size) AS BIGINT) AS bytes FROM matrix")
def stored_matrix(k):
    """The blob-medium table written and read back."""
    kept = k.stored(shared.shared_folder(k.spark, "catalog"))
    return kept.matrix.agg(F.count("*").alias("n_rows"), F.count_distinct("blobid").alias("blobs"), F.count_distinct("medium_hash").alias("media"), F.sum("size").alias("bytes"))


@query("""WITH p AS (SELECT medium_hash, id, row_number() OVER (PARTITION BY medium_hash ORDER BY id) AS rn FROM inode WHERE NOT copied AND claimed_by IS NULL), c AS (SELECT medium_hash, id FROM p WHERE rn <= 3)
SELECT i.medium_hash, count(*) FILTER (WHERE i.status = 'success' OR (c.id IS NOT NULL AND c.id % 2 = 0)) AS successful, count(*) FILTER (WHERE i.copied OR (c.id IS NOT NULL AND c.id % 2 = 0)) AS copied, count(i.claimed_by) AS claimed,
CAST(sum(len(i.errors) + CASE WHEN c.id % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_errors, 3 AS version FROM inode i LEFT JOIN c ON c.medium_hash = i.medium_hash AND c.id = i.id GROUP BY 1""")
def stored_transitions(k):
    """A worker's batch against the stored queue: three rows of each medium are claimed, even ones succeed, odd ones fail; each step is a version."""
    kept = store.Store(k.spark, shared.shared_folder(k.spark, "store"))
    media = kept.replace({"inode": k.inode}).media("inode")
    kept.change(media, ("inode", lambda rows: queue.claim(rows, 3, "batch")))
    batch = kept.read("inode").where("claimed_by = 'batch'").select("id")
    done = batch.where("id % 2 = 0").select("id", F.sha2(F.col("id").cast("string"), 256).alias("blob"), F.lit(None).cast("string").alias("mime"))
    failed = batch.where("id % 2 = 1").select("id", F.lit("no such device").alias("message"), F.lit("OSError").alias("exception"))
    after = kept.change(media, ("inode", lambda rows: queue.mark_failure(queue.mark_success(rows, done), failed)))
    n = kept.read("inode", version=after).groupBy("medium_hash").agg(F.count_if(F.col("status") == "success").alias("successful"), F.count_if("copied").alias("copied"), F.count("claimed_by").alias("claimed"), F.sum(F.size("errors")).alias("n_errors"))
    return n.withColumn("version", F.lit(after.number))
