"""Load, exclusion and path-search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import ingest
from quarry.plans.registry import query
from quarry.sources import search
from quarry.sources.shared import shared_folder


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1", on_catalog=False)
def distinct_on_first(k):
    """DISTINCT ON as one map-side-combined minimum instead of a window."""
    order = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return k.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(order).alias("f")).select("l_orderkey", "l_linenumber", "f.l_partkey", "f.l_suppkey")


@query("SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL", on_catalog=False)
def distinct_by_max(k):
    return k.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"), F.max("l_suppkey").alias("l_suppkey"))


@query("SELECT medium_hash, count(*) AS paths, count(*) FILTER (WHERE exclude_reason IS NOT NULL) AS excluded, round(100::DOUBLE * (count(*) FILTER (WHERE exclude_reason IS NOT NULL)::DOUBLE / nullif(count(*)::DOUBLE, 0)), 2) AS pct FROM path GROUP BY ALL")
def exclude_regex_rate(k):
    n = k.path.groupBy("medium_hash").agg(F.count("*").alias("paths"), F.count_if(F.col("exclude_reason").isNotNull()).alias("excluded"))
    return n.withColumn("pct", c.percent(F.col("excluded"), F.col("paths")))


@query(r"SELECT count(*) AS urls, count(*) FILTER (WHERE regexp_matches(url, '/en/')) AS english, count(*) FILTER (WHERE regexp_matches(url, 'utm_source')) AS tracked, count(*) FILTER (WHERE regexp_matches(url, '/$')) AS folder FROM pages", on_catalog=False)
def exclude_pattern_impact(k):
    url = F.col("url")
    return k.table("pages").agg(F.count("*").alias("urls"), F.count_if(url.rlike("/en/")).alias("english"), F.count_if(url.rlike("utm_source")).alias("tracked"), F.count_if(url.rlike("/$")).alias("folder"))


@query(r"SELECT CASE WHEN regexp_matches(url, 'utm_source') THEN 'tracked' WHEN regexp_matches(url, '/en/') THEN 'english' WHEN regexp_matches(url, '/$') THEN 'folder' ELSE 'none' END AS first_match, count(*) AS n FROM pages GROUP BY 1", on_catalog=False)
def exclude_first_match(k):
    url = F.col("url")
    first = F.when(url.rlike("utm_source"), "tracked").when(url.rlike("/en/"), "english").when(url.rlike("/$"), "folder").otherwise("none")
    return k.table("pages").groupBy(first.alias("first_match")).agg(F.count("*").alias("n"))


_SEARCH = "WITH s AS (SELECT medium_hash, path, regexp_replace(path, '^.*/', '') AS filename, nullif(regexp_extract(path, '([^/]+)/[^/]*$', 1), '') AS parent FROM path)"


@query(_SEARCH + " SELECT medium_hash, path, filename, parent FROM s WHERE filename IN ('26.txt', '13', '7.txt')")
def path_filename_search(k):
    return ingest.path_search(k.path).where(F.col("filename").isin("26.txt", "13", "7.txt"))


@query(_SEARCH + " SELECT filename, count(*) AS n, string_agg(DISTINCT medium_hash, ',' ORDER BY medium_hash) AS media, string_agg(DISTINCT parent, ',' ORDER BY parent) AS parents FROM s GROUP BY filename HAVING count(*) > 1")
def path_filenames_grouped(k):
    joined = lambda x: F.array_join(F.array_sort(F.collect_set(x)), ",")
    return ingest.path_search(k.path).groupBy("filename").agg(F.count("*").alias("n"), joined("medium_hash").alias("media"), joined("parent").alias("parents")).where("n > 1")


@query("SELECT p.medium_hash, count(*) AS paths, count(DISTINCT (p.dev, p.ino)) AS inodes, CAST(sum(i.size) AS BIGINT) AS bytes, count(*) FILTER (WHERE i.copied) AS copied FROM path p JOIN inode i ON i.medium_hash = p.medium_hash AND i.ino = p.ino WHERE starts_with(p.path, '/backup/') GROUP BY ALL")
def prefix_stats(k):
    return ingest.media_with_prefix(k.path, k.inode, "/backup")


@query(r"SELECT count(*) AS n, count(*) FILTER (WHERE contains(html, chr(13))) AS cr, count(*) FILTER (WHERE contains(html, chr(10))) AS lf FROM pages", on_catalog=False)
def cr_lf_counts(k):
    return k.table("pages").agg(F.count("*").alias("n"), F.count_if(F.col("html").contains("\r")).alias("cr"), F.count_if(F.col("html").contains("\n")).alias("lf"))


@query("SELECT medium_hash, ino, path FROM path p WHERE NOT EXISTS (SELECT 1 FROM path q WHERE q.medium_hash = p.medium_hash AND q.ino = p.ino AND starts_with(q.path, p.path || '/'))")
def longest_paths(k):
    return ingest.leaf_paths(k.path.select("medium_hash", "ino", "path"))


@query("SELECT ino, substr(blobid, 1, 2) || '/' || substr(blobid, 3, 2) || '/' || blobid AS stored, regexp_matches(blobid, '^[0-9a-f]{64}$') AS is_id, CASE WHEN size < 10240 THEN size || ' bytes' ELSE ((size // 512 + 1) // 2) || ' kB' END AS pretty FROM inode WHERE blobid IS NOT NULL")
def stored_names(k):
    return k.inode.where("blobid is not null").select("ino", c.by_hash_path(F.col("blobid")).alias("stored"), c.is_blob_id(F.col("blobid")).alias("is_id"), c.size_pretty(F.col("size")).alias("pretty"))


@query("""WITH staged AS (SELECT medium_hash, ino, path, exclude_reason FROM path), i AS (SELECT medium_hash, ino, fs_type, fs_type = 'f' AND NOT EXISTS (SELECT 1 FROM staged s WHERE s.medium_hash = inode.medium_hash AND s.ino = inode.ino AND s.exclude_reason IS NULL) AS out FROM inode)
SELECT medium_hash, count(*) AS inodes, count(*) FILTER (WHERE fs_type <> 'f') AS non_file, count(*) FILTER (WHERE out) AS all_excluded, count(*) FILTER (WHERE fs_type = 'f' AND NOT out) AS unclaimed, any_value(p.paths) AS paths, any_value(p.excluded) AS excluded
FROM i JOIN (SELECT medium_hash, count(*) AS paths, count(exclude_reason) AS excluded FROM staged GROUP BY 1) p USING (medium_hash) GROUP BY medium_hash""")
def load_summary(k):
    """The load of all media, from staged records to the counts that it reports."""
    staged = k.inode.select("medium_hash", "dev", "ino", "nlink", "size", "mtime", "fs_type").join(k.path.select("medium_hash", "ino", "path", "exclude_reason"), ["medium_hash", "ino"])
    return ingest.load_counts(ingest.exclude_inodes(ingest.inodes(staged), k.path), k.path)


@query("SELECT count(*) AS n_rows, count(DISTINCT ino) AS inodes, count(DISTINCT (ino, path)) AS ino_paths, count(*) FILTER (WHERE nlink > 1) AS hardlinked FROM path")
def staging_profile(k):
    return k.path.agg(F.count("*").alias("n_rows"), F.count_distinct("ino").alias("inodes"), F.count_distinct(F.struct("ino", "path")).alias("ino_paths"), F.count_if(F.col("nlink") > 1).alias("hardlinked"))


@query(_SEARCH + """, g AS (SELECT *, nullif(regexp_extract(path, '([^/]+)/[^/]+/[^/]*$', 1), '') AS grandparent FROM s)
SELECT medium_hash, count(*) AS n, count(*) FILTER (WHERE parent = medium_hash) AS own, count(*) FILTER (WHERE grandparent = medium_hash) AS own_grandparent, round(100::DOUBLE * (count(*) FILTER (WHERE parent = medium_hash)::DOUBLE / nullif(count(*)::DOUBLE, 0)), 2) AS pct FROM g GROUP BY 1""")
def path_parent_match_pct(k):
    same = lambda x: F.count_if(F.coalesce(x == F.col("medium_hash"), F.lit(False)))
    n = ingest.path_search(k.path).groupBy("medium_hash").agg(F.count("*").alias("n"), same(F.col("parent")).alias("own"), same(c.grandparent_name(F.col("path"))).alias("own_grandparent"))
    return n.withColumn("pct", c.percent(F.col("own"), F.col("n")))


@query("SELECT medium_hash, medium_human FROM medium WHERE medium_human ILIKE '%SRC1%'")
def media_by_name(k):
    return k.medium.where(F.col("medium_human").ilike("%SRC1%")).select("medium_hash", "medium_human")


@query("SELECT path FROM path WHERE exclude_reason = 'pattern_match' ORDER BY md5(path || '7'), path LIMIT 20")
def excluded_sample(k):
    """A seeded preview of what the patterns exclude, to look for false positives."""
    return k.path.where("exclude_reason = 'pattern_match'").orderBy(F.md5(F.concat("path", F.lit("7"))), "path").limit(20).select("path")


@query("SELECT medium_hash, count(*) FILTER (WHERE regexp_matches(path, '/backup/')) AS would_mark, count(*) AS live FROM path WHERE exclude_reason IS NULL GROUP BY 1")
def remark_preview(k):
    """How many live rows a new pattern would mark."""
    live = k.path.where("exclude_reason is null")
    marked = ingest.mark_excluded(live, ["/backup/"])
    return marked.groupBy("medium_hash").agg(F.count("exclude_reason").alias("would_mark"), F.count("*").alias("live"))


@query("SELECT html AS content, sha256(html) AS hash, octet_length(encode(html)) AS n_bytes, length(html) AS n_chars FROM pages", on_catalog=False)
def content_identity(k):
    html = F.col("html")
    return k.table("pages").select(html.alias("content"), c.content_hash(html).alias("hash"), F.octet_length(html).cast("long").alias("n_bytes"), F.length(html).cast("long").alias("n_chars"))


@query("SELECT p.medium_hash, count(DISTINCT p.ino) FILTER (WHERE exclude_reason IS NOT NULL) AS excluded_inodes, count(DISTINCT p.ino) FILTER (WHERE exclude_reason IS NULL) AS live_inodes, count(DISTINCT p.blobid) FILTER (WHERE exclude_reason IS NULL) AS live_blobs, count(DISTINCT p.path) AS paths FROM path p GROUP BY 1")
def distinct_counts_filtered(k):
    """Several distinct counts, each with a filter of its own, in one aggregation."""
    when = lambda cond, x: F.count_distinct(F.when(cond, F.col(x)))
    live = F.col("exclude_reason").isNull()
    return k.path.groupBy("medium_hash").agg(when(~live, "ino").alias("excluded_inodes"), when(live, "ino").alias("live_inodes"), when(live, "blobid").alias("live_blobs"), F.count_distinct("path").alias("paths"))


@query("SELECT medium_hash, medium_human FROM medium m WHERE EXISTS (SELECT 1 FROM path p WHERE p.medium_hash = m.medium_hash AND p.exclude_reason IS NULL AND starts_with(p.path, '/backup/'))")
def media_with_backups(k):
    hit = k.path.where(F.col("exclude_reason").isNull() & F.col("path").startswith("/backup/")).select("medium_hash")
    return k.medium.join(hit, "medium_hash", "left_semi").select("medium_hash", "medium_human")


def _index(k):
    """The stored search index over the catalog's paths."""
    found = search.SearchIndex(k.spark, shared_folder(k.spark, "search"))
    found.build(k.path.select("medium_hash", "path"), rows_per_file=2_000)
    return found


_NAMES = "WITH s AS (SELECT medium_hash, path, regexp_replace(path, '^.*/', '') AS filename, regexp_replace(path, '^.*/([^/]+/[^/]+)$', '\\1') AS parent_filename FROM path)"


@query(_NAMES + " SELECT medium_hash, path, filename, parent_filename FROM s WHERE filename = '26'")
def index_one_name(k):
    return _index(k).by_name("26")


@query(_NAMES + " SELECT filename, count(*) AS match_count, string_agg(DISTINCT medium_hash, ',' ORDER BY medium_hash) AS found_in FROM s WHERE filename IN (SELECT (doc_id * 3) || '.txt' FROM documents WHERE doc_id < 500) GROUP BY 1")
def index_many_names(k):
    """Several hundred names at once, as a search for what a lost medium held."""
    names = [f"{3 * i}.txt" for i in range(500)]
    return _index(k).matches(*names).withColumn("found_in", F.array_join("found_in", ","))


@query(_NAMES + " SELECT medium_hash, path, filename, parent_filename FROM s WHERE path LIKE '%/a.x/26' OR path LIKE '%9.txt' OR path LIKE '%src4/13'")
def index_path_endings(k):
    return _index(k).by_ending("/a.x/26", "9.txt", "src4/13")


_IGNORED = ("node_modules", r"\.cache", "/backup/", r"[1-3]\.txt$", "/(en|de)/src1")


@query("WITH p AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _IGNORED) + "]) AS pattern) SELECT pattern, count(path) AS n_paths FROM p LEFT JOIN path ON regexp_matches(path, pattern) GROUP BY 1")
def ignore_pattern_impact(k):
    """How many of the catalog's paths each line of an ignore file would drop."""
    return ingest.pattern_impact(k.path, [*_IGNORED, "# a comment"])
