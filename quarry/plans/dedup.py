"""Dedup queries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.operators import dedup
from quarry.plans.registry import query
from quarry.sources import sinks

_ORDER = """WITH ord AS (SELECT medium_hash, medium_human, coalesce(medium_human, substr(medium_hash, 1, 12) || '...') AS medium_name, added, row_number() OVER (ORDER BY added, medium_hash) AS seq
  FROM medium m WHERE health = 'ok' AND EXISTS (SELECT 1 FROM matrix x WHERE x.medium_hash = m.medium_hash)),
firsts AS (SELECT blobid, size, min(seq) AS first_seq FROM matrix JOIN ord USING (medium_hash) GROUP BY ALL),
r AS (SELECT seq, medium_hash, medium_name, added, count(*) AS total_blobs, count(*) FILTER (WHERE seq = first_seq) AS new_blobs, count(*) FILTER (WHERE first_seq < seq) AS dup_blobs, CAST(coalesce(sum(size) FILTER (WHERE seq = first_seq), 0) AS BIGINT) AS new_bytes,
  CAST(coalesce(sum(size) FILTER (WHERE first_seq < seq), 0) AS BIGINT) AS dup_bytes, CAST(sum(size) AS BIGINT) AS total_bytes FROM matrix JOIN ord USING (medium_hash) JOIN firsts USING (blobid, size) GROUP BY ALL),
b AS (SELECT CAST(seq AS INTEGER) AS seq, medium_hash, medium_name, added, total_blobs, new_blobs, dup_blobs, new_bytes, dup_bytes, round(new_bytes::DOUBLE / 1073741824, 2) AS new_gb, round(dup_bytes::DOUBLE / 1073741824, 2) AS dup_gb,
  coalesce(round(100::DOUBLE * (dup_bytes::DOUBLE / nullif(total_bytes::DOUBLE, 0)), 1), 0) AS dedup_pct, CAST(sum(new_blobs) OVER w AS BIGINT) AS cumulative_blobs, round(sum(new_bytes) OVER w::DOUBLE / 1073741824, 2) AS cumulative_gb FROM r WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING))"""


@query("SELECT count(*) AS n_rows, count(DISTINCT blobid) AS blobs, count(DISTINCT medium_hash) AS media, round(sum(size)::DOUBLE / 1073741824, 6) AS total_gib FROM matrix")
def blob_media_matrix_totals(k):
    return k.matrix.agg(F.count("*").alias("n_rows"), F.count_distinct("blobid").alias("blobs"), F.count_distinct("medium_hash").alias("media"), F.round(F.sum("size").cast("double") / 1073741824, 6).alias("total_gib"))


@query("SELECT i.blobid, i.medium_hash, i.size FROM inode i JOIN blobs b ON i.blobid = b.blobid WHERE b.n_hardlinks > 1 AND i.fs_type = 'f' AND i.copied GROUP BY ALL")
def blob_media_matrix_shared(k):
    shared = k.blobs.where("n_hardlinks > 1").select("blobid")
    return k.inode.where("fs_type = 'f' and copied").join(shared, "blobid", "left_semi").select("blobid", "medium_hash", "size").distinct()


_PAIRS = "WITH pairs AS (SELECT x.medium_hash AS a, y.medium_hash AS b, count(*) AS shared_blobs, CAST(sum(x.size) AS BIGINT) AS shared_bytes FROM matrix x JOIN matrix y ON x.blobid = y.blobid AND x.size = y.size AND x.medium_hash < y.medium_hash GROUP BY ALL)"
_SIM = _PAIRS + """, n AS (SELECT medium_hash, count(*) AS blobs FROM matrix GROUP BY 1), sim AS (SELECT a, b, shared_blobs, round(shared_blobs::DOUBLE / (na.blobs + nb.blobs - shared_blobs)::DOUBLE, 4) AS jaccard, round(shared_bytes::DOUBLE / 1e9, 6) AS shared_gb,
 round(100::DOUBLE * (shared_blobs::DOUBLE / na.blobs::DOUBLE), 2) AS pct_of_a, round(100::DOUBLE * (shared_blobs::DOUBLE / nb.blobs::DOUBLE), 2) AS pct_of_b FROM pairs JOIN n na ON na.medium_hash = a JOIN n nb ON nb.medium_hash = b)"""


@query(_PAIRS + " SELECT m.medium_hash AS a, n.medium_hash AS b, coalesce(shared_blobs, 0) AS shared_blobs, coalesce(shared_bytes, 0) AS shared_bytes FROM medium m JOIN medium n ON m.medium_hash < n.medium_hash LEFT JOIN pairs ON a = m.medium_hash AND b = n.medium_hash")
def sharing_matrix_pairs(k):
    return dedup.sharing_pairs(k.matrix, k.medium)


@query(_SIM + " SELECT * FROM sim ORDER BY jaccard DESC, a, b LIMIT 10")
def jaccard_top(k):
    return dedup.similarity(k.matrix).orderBy(F.desc("jaccard"), "a", "b").limit(10)


@query(_SIM + " SELECT a, b, pct_of_a, pct_of_b FROM sim")
def containment_pct(k):
    return dedup.similarity(k.matrix).select("a", "b", "pct_of_a", "pct_of_b")


@query("WITH s AS (SELECT blobid, string_agg(DISTINCT medium_hash, '+' ORDER BY medium_hash) AS pattern, count(DISTINCT medium_hash) AS n_media FROM matrix GROUP BY 1) SELECT pattern, n_media, count(*) AS n_blobs FROM s GROUP BY ALL")
def upset_patterns(k):
    return dedup.patterns(k.matrix)


@query(_PAIRS + ", e AS (SELECT a AS m, shared_blobs FROM pairs UNION ALL SELECT b, shared_blobs FROM pairs) SELECT m AS medium_hash, count(*) AS degree, CAST(sum(shared_blobs) AS BIGINT) AS strength FROM e GROUP BY 1")
def network_degree(k):
    pairs = dedup.sharing_pairs(k.matrix)
    return pairs.select(F.explode(F.array("a", "b")).alias("medium_hash"), "shared_blobs").groupBy("medium_hash").agg(F.count("*").alias("degree"), F.sum("shared_blobs").alias("strength"))


@query(_PAIRS + ", e AS (SELECT a AS m, shared_blobs FROM pairs UNION ALL SELECT b, shared_blobs FROM pairs) SELECT m AS medium_hash, CAST(sum(shared_blobs) AS BIGINT) AS strength FROM e GROUP BY 1 ORDER BY strength DESC, medium_hash LIMIT 1")
def hub_medium(k):
    return network_degree(k).select("medium_hash", "strength").orderBy(F.desc("strength"), "medium_hash").limit(1)


@query(_PAIRS + " SELECT (SELECT count(*) FROM pairs) AS edges, (SELECT count(*) FROM medium) AS media, round((SELECT count(*) FROM pairs)::DOUBLE / nullif((SELECT count(*) * (count(*) - 1) / 2 FROM medium)::DOUBLE, 0), 4) AS density")
def network_density(k):
    n = k.medium.agg(F.count("*").alias("media"))
    return dedup.sharing_pairs(k.matrix).agg(F.count("*").alias("edges")).crossJoin(n).select("edges", "media", F.round(c.ratio(F.col("edges"), F.col("media") * (F.col("media") - 1) / 2), 4).alias("density"))


@query("SELECT medium_hash, count(*) AS blobs, CAST(sum(size) AS BIGINT) AS bytes FROM matrix GROUP BY ALL")
def medium_totals(k):
    return dedup.totals(k.matrix)


@query("SELECT blobid, count(DISTINCT medium_hash) AS n_media, string_agg(DISTINCT medium_hash, '+' ORDER BY medium_hash) AS media FROM matrix GROUP BY blobid HAVING count(DISTINCT medium_hash) >= 3")
def widespread_blobs(k):
    return k.matrix.groupBy("blobid").agg(F.count_distinct("medium_hash").alias("n_media"), F.array_join(F.array_sort(F.collect_set("medium_hash")), "+").alias("media")).where("n_media >= 3").select("blobid", "n_media", "media")


@query("SELECT blobid, count(DISTINCT medium_hash) AS n_media, max(size) AS size FROM matrix GROUP BY blobid HAVING count(DISTINCT medium_hash) = (SELECT count(DISTINCT medium_hash) FROM matrix)")
def universal_blobs(k):
    """Blobs on every medium that has one."""
    n = k.matrix.agg(F.count_distinct("medium_hash").alias("media"))
    return k.matrix.groupBy("blobid").agg(F.count_distinct("medium_hash").alias("n_media"), F.max("size").alias("size")).join(F.broadcast(n), F.col("n_media") == F.col("media")).select("blobid", "n_media", "size")


@query("SELECT medium_hash, count(*) AS total, count(DISTINCT blobid) AS uniq, count(*) - count(DISTINCT blobid) AS duplicates, round(100::DOUBLE * ((count(*) - count(DISTINCT blobid))::DOUBLE / nullif(count(*)::DOUBLE, 0)), 2) AS dup_pct FROM inode WHERE blobid IS NOT NULL GROUP BY ALL")
def dedup_rate_by_medium(k):
    n = k.inode.where("blobid is not null").groupBy("medium_hash").agg(F.count("*").alias("total"), F.count_distinct("blobid").alias("uniq"))
    return n.select("medium_hash", "total", "uniq", (F.col("total") - F.col("uniq")).alias("duplicates"), c.percent(F.col("total") - F.col("uniq"), F.col("total")).alias("dup_pct"))


@query("WITH m AS (SELECT medium_hash, count(*) AS total, count(DISTINCT blobid) AS uniq FROM inode WHERE blobid IS NOT NULL GROUP BY ALL) SELECT count(*) AS media, CAST(sum(total) AS BIGINT) AS files, CAST(sum(uniq) AS BIGINT) AS unique_within, round(100::DOUBLE * (1::DOUBLE - sum(uniq)::DOUBLE / sum(total)::DOUBLE), 2) AS dup_pct FROM m")
def dedup_rate_overall(k):
    m = dedup_rate_by_medium(k).agg(F.count("*").alias("media"), F.sum("total").alias("files"), F.sum("uniq").alias("unique_within"))
    return m.select("media", "files", "unique_within", F.round(F.lit(100.0) * (F.lit(1.0) - c.ratio(F.col("unique_within"), F.col("files"))), 2).alias("dup_pct"))


@query("""SELECT ino, medium_hash, CASE WHEN fs_type = 'd' THEN 'create_directory' WHEN fs_type = 'l' THEN 'create_symlink' WHEN fs_type <> 'f' THEN 'record_special' WHEN size = 0 THEN 'handle_empty_file' WHEN blobid IS NULL THEN 'skip'
 WHEN row_number() OVER (PARTITION BY blobid ORDER BY ino, medium_hash) = 1 THEN 'copy_new_file' ELSE 'link_existing_file' END AS action FROM inode""")
def new_vs_dedup_action(k):
    """The first occurrence of a blob is copied, the others linked.  Rows without a blob meet no window."""
    first = k.inode.where("blobid is not null").groupBy("blobid").agg(F.min(F.struct("ino", "medium_hash")).alias("f"))
    rows = k.inode.join(first, "blobid", "left")
    is_first = (F.col("f.ino") == F.col("ino")) & (F.col("f.medium_hash") == F.col("medium_hash"))
    action = F.when(F.col("fs_type") == "d", "create_directory").when(F.col("fs_type") == "l", "create_symlink").when(F.col("fs_type") != "f", "record_special").when(F.col("size") == 0, "handle_empty_file").when(F.col("blobid").isNull(), "skip").when(is_first, "copy_new_file").otherwise("link_existing_file")
    return rows.select("ino", "medium_hash", action.alias("action"))


_EXPECTED = "WITH x AS (SELECT b.blobid, b.n_hardlinks, coalesce(e.n, 0) AS expected FROM blobs b LEFT JOIN (SELECT blobid, count(DISTINCT path) AS n FROM path WHERE exclude_reason IS NULL AND blobid IS NOT NULL GROUP BY 1) e USING (blobid))"


def _expected(k):
    e = k.path.where("exclude_reason is null and blobid is not null").groupBy("blobid").agg(F.count_distinct("path").alias("expected"))
    return k.blobs.join(e, "blobid", "left").select("blobid", "n_hardlinks", F.coalesce("expected", F.lit(0)).cast("long").alias("expected"))


@query(_EXPECTED + " SELECT count(*) AS blobs, count(*) FILTER (WHERE expected = 0) AS without_paths, count(*) FILTER (WHERE expected > n_hardlinks) AS incomplete, CAST(max(expected) AS BIGINT) AS most FROM x")
def expected_hardlinks_stats(k):
    e = F.col("expected")
    return _expected(k).agg(F.count("*").alias("blobs"), F.count_if(e == 0).alias("without_paths"), F.count_if(e > F.col("n_hardlinks")).alias("incomplete"), F.max("expected").alias("most"))


@query(_ORDER + " SELECT * FROM b")
def incremental_dedup_blobs(k):
    return dedup.incremental(k.matrix, k.medium)


@query(_ORDER + """
, own AS (SELECT DISTINCT medium_hash, path FROM path WHERE exclude_reason IS NULL), path_first AS (SELECT path, min(seq) AS first_seq FROM own JOIN ord USING (medium_hash) GROUP BY path),
p AS (SELECT medium_hash, count(*) FILTER (WHERE first_seq = seq) AS new_paths, count(*) FILTER (WHERE first_seq < seq) AS dup_paths FROM own JOIN ord USING (medium_hash) JOIN path_first USING (path) GROUP BY 1)
SELECT seq, medium_hash, medium_name, added, coalesce(new_paths, 0) AS new_paths, coalesce(dup_paths, 0) AS dup_paths, new_blobs, dup_blobs, new_gb, dup_gb, cumulative_blobs, cumulative_gb FROM b LEFT JOIN p USING (medium_hash)""")
def incremental_dedup_paths(k):
    blobs = dedup.incremental(k.matrix, k.medium).select("seq", "medium_hash", "medium_name", "added", "new_blobs", "dup_blobs", "new_gb", "dup_gb", "cumulative_blobs", "cumulative_gb")
    blobs = sinks.kept(blobs, "incremental")  # a row a medium, asked for twice
    return blobs.join(dedup.incremental_paths(k.path, blobs), "seq", "left").na.fill(0, ["new_paths", "dup_paths"])


@query("""WITH h AS (SELECT CAST(1 AS BIGINT) << (length(bin(n_hardlinks)) - 1) AS lower_bound, (CAST(1 AS BIGINT) << length(bin(n_hardlinks))) - 1 AS upper_bound, count(*) AS num_blobs, CAST(sum(n_hardlinks) AS BIGINT) AS total_inodes FROM blobs WHERE n_hardlinks > 1 GROUP BY ALL)
SELECT *, round(100::DOUBLE * (num_blobs::DOUBLE / (sum(num_blobs) OVER ())::DOUBLE), 1) AS pct_blobs, round(100::DOUBLE * (total_inodes::DOUBLE / (sum(total_inodes) OVER ())::DOUBLE), 1) AS pct_inodes FROM h""")
def hardlink_log2_histogram(k):
    low, every = c.log2_bucket(F.col("n_hardlinks")), W.partitionBy()  # over a row a bucket
    n = k.blobs.where("n_hardlinks > 1").groupBy(low.alias("lower_bound"), (low * 2 - 1).alias("upper_bound")).agg(F.count("*").alias("num_blobs"), F.sum("n_hardlinks").alias("total_inodes"))
    share = lambda x: c.percent(F.col(x), F.sum(x).over(every), 1)
    return n.select("*", share("num_blobs").alias("pct_blobs"), share("total_inodes").alias("pct_inodes"))


@query("SELECT medium_hash, year(DATE '1970-01-01' + CAST(mtime // 86400 AS INTEGER)) AS year, count(*) AS files FROM inode WHERE copied AND fs_type = 'f' GROUP BY ALL")
def files_per_year(k):
    return k.inode.where("copied and fs_type = 'f'").groupBy("medium_hash", F.year(c.day_of(F.col("mtime"))).cast("long").alias("year")).agg(F.count("*").alias("files"))


@query("""WITH s AS (SELECT b.blobid, b.n_hardlinks AS actual_hardlinks, count(DISTINCT p.path) AS expected_hardlinks FROM blobs b JOIN inode i ON i.blobid = b.blobid JOIN path p ON p.medium_hash = i.medium_hash AND p.dev = i.dev AND p.ino = i.ino GROUP BY ALL)
SELECT blobid, actual_hardlinks, expected_hardlinks, expected_hardlinks - actual_hardlinks AS missing_hardlinks, CASE WHEN actual_hardlinks = expected_hardlinks THEN 'complete' WHEN actual_hardlinks > 0 THEN 'partial' ELSE 'none' END AS status FROM s""")
def hardlink_status_view(k):
    """The join of inodes and paths has the medium in its key: inode numbers repeat across media."""
    own = k.inode.where("blobid is not null").select("medium_hash", "dev", "ino", "blobid").join(k.path.select("medium_hash", "dev", "ino", "path"), ["medium_hash", "dev", "ino"])
    n = own.groupBy("blobid").agg(F.count_distinct("path").alias("expected_hardlinks"))
    both = k.blobs.select("blobid", F.col("n_hardlinks").alias("actual_hardlinks")).join(n, "blobid")
    status = F.when(F.col("actual_hardlinks") == F.col("expected_hardlinks"), "complete").when(F.col("actual_hardlinks") > 0, "partial").otherwise("none")
    return both.select("*", (F.col("expected_hardlinks") - F.col("actual_hardlinks")).alias("missing_hardlinks"), status.alias("status"))


@query(_EXPECTED + " SELECT *, expected - n_hardlinks AS missing, coalesce(round(n_hardlinks::DOUBLE / nullif(expected::DOUBLE, 0), 4), 0) AS completeness FROM x WHERE expected > n_hardlinks ORDER BY missing DESC, blobid LIMIT 20")
def top_missing_hardlinks(k):
    done = F.coalesce(F.round(c.ratio(F.col("n_hardlinks"), F.col("expected")), 4), F.lit(0.0))
    return _expected(k).where("expected > n_hardlinks").select("*", (F.col("expected") - F.col("n_hardlinks")).alias("missing"), done.alias("completeness")).orderBy(F.desc("missing"), "blobid").limit(20)


@query("""WITH l AS (SELECT medium_hash, nullif(regexp_extract(path, '^(/[^/]+/[^/]+/[^/]+)', 1), '') AS label, count(*) AS n FROM path GROUP BY ALL),
best AS (SELECT medium_hash, label FROM (SELECT *, row_number() OVER (PARTITION BY medium_hash ORDER BY n DESC, label NULLS LAST) AS rn FROM l) WHERE rn = 1)
SELECT m.medium_hash, count(DISTINCT m.blobid) AS unique_blobs, coalesce(any_value(best.label), m.medium_hash) AS label FROM matrix m LEFT JOIN best USING (medium_hash) GROUP BY m.medium_hash""")
def medium_modal_label(k):
    """The most common three upper levels of a medium's paths; paths of fewer levels count together, and name nothing."""
    label = F.nullif(F.regexp_extract("path", "^(/[^/]+/[^/]+/[^/]+)", 1), F.lit(""))
    n = k.path.groupBy("medium_hash", label.alias("label")).agg(F.count("*").alias("n"))
    best = n.groupBy("medium_hash").agg(F.min(F.struct((-F.col("n")).alias("o"), F.col("label").isNull().alias("none"), "label")).alias("b"))
    blobs = k.matrix.groupBy("medium_hash").agg(F.count_distinct("blobid").alias("unique_blobs"))
    return blobs.join(best, "medium_hash", "left").select("medium_hash", "unique_blobs", F.coalesce("b.label", "medium_hash").alias("label"))


@query("""WITH s AS (SELECT blobid, CAST(n_hardlinks AS BIGINT) AS n_hardlinks FROM blobs WHERE n_hardlinks BETWEEN 32 AND 63 ORDER BY md5(blobid || '7'), blobid LIMIT 100)
SELECT s.blobid, max(i.size) AS size, any_value(n_hardlinks) AS n_hardlinks, string_agg(DISTINCT p.path, ',' ORDER BY p.path) AS sample_paths FROM s JOIN inode i ON i.blobid = s.blobid JOIN path p ON p.medium_hash = i.medium_hash AND p.ino = i.ino GROUP BY s.blobid""")
def sampled_hot_blobs(k):
    """A sample of the blobs of 32 to 63 copies, with their paths, of which there are as few."""
    some = k.blobs.where("n_hardlinks between 32 and 63").orderBy(F.md5(F.concat("blobid", F.lit("7"))), "blobid").limit(100).select("blobid", "n_hardlinks")
    own = k.inode.select("medium_hash", "ino", "blobid", "size").join(some, "blobid").join(k.path.select("medium_hash", "ino", "path"), ["medium_hash", "ino"])
    return own.groupBy("blobid").agg(F.max("size").alias("size"), F.first("n_hardlinks").alias("n_hardlinks"), F.array_join(F.array_sort(F.collect_set("path")), ",").alias("sample_paths"))


@query("SELECT m.medium_hash, m.medium_human, CAST(sum(i.size) AS BIGINT) AS total_file_bytes, count(*) FILTER (WHERE i.copied) AS files_copied FROM medium m JOIN inode i ON i.medium_hash = m.medium_hash WHERE m.copy_done IS NOT NULL AND i.fs_type = 'f' GROUP BY ALL")
def storage_efficiency(k):
    done = k.medium.where("copy_done is not null").select("medium_hash", "medium_human")
    return k.inode.where("fs_type = 'f'").join(done, "medium_hash").groupBy("medium_hash", "medium_human").agg(F.sum("size").alias("total_file_bytes"), F.count_if("copied").alias("files_copied"))


@query("SELECT x.blobid, m.medium_hash, CAST(max(CASE WHEN x.medium_hash = m.medium_hash THEN 1 ELSE 0 END) AS INTEGER) AS present FROM matrix x CROSS JOIN (SELECT DISTINCT medium_hash FROM matrix) m GROUP BY ALL")
def upset_indicator(k):
    """Blob by medium membership over all media, one row a cell; ``dedup.indicator`` gives it as columns."""
    media = sorted(r[0] for r in k.matrix.select("medium_hash").distinct().collect())  # a row a medium
    wide = dedup.indicator(k.matrix, media)
    return wide.unpivot("blobid", [f"`{m}`" for m in media], "medium_hash", "present").select("blobid", "medium_hash", "present")
