"""The archive catalog over the tables of a data folder.

A medium is a source of documents, an inode a document, a blob a distinct content:
the text, for a third of them after the first bytes of a known file type.  Beside
the documents every medium has one file that is on all media, and some have one that
dozens of files are copies of.  Everything is derived by plain expressions, so filters and columns reach the
scan; ``SQL`` has the same views for the differential tests.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as c

MESSAGES = ("No such file or directory: x", "Permission denied", "Input/output error", "read beyond EOF", "BLAKE3 mismatch", "File name too long", "strange failure")
FILESYSTEMS = ("ext4", "vfat", "hfsplus", "iso9660")
PATTERNS = ["node_modules", r"\.cache"]
#: a common multiple of what the rows' numbers are divided by, so that planted files have the remainders that are added to it
FAR = 2 * 5 * 7 * 11 * 13 * 17 * 19 * 23 * 29 * 31
#: beginnings of files, in hexadecimal, with the zeros before bytes that stand further on
BEGINNINGS = tuple("00" * offset + magic for offset, magic, _ in c.MAGIC) + ("".join(f"{b:02X}" for b in b"<!DOCTYPE html>\n"), "".join(f"{b:02X}" for b in b"  \n#!/bin/sh\n"), "0001", "")


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def files(self) -> DataFrame:
        """(d, born, text, source, lang, n_chars, content): the documents, and the planted files under numbers far above theirs."""
        born = F.col("doc_id")
        # 0: the document, 1: one of 33 copies, 2: what all media have; by number, so that texts are not copied and one scan is enough
        kinds = F.array_compact(F.array(F.lit(0), F.when(born % 15 == 9, 1), F.when((born < 200) | (born % 50 == 7), 2)))
        far = F.lit(FAR) * (born + 1)
        copy = F.concat(F.lit("shared "), F.floor(born / 495).cast("string"))
        pick = lambda own, shared, common: F.when(F.col("kind") == 0, own).when(F.col("kind") == 1, shared).otherwise(common)
        every = self.table("documents").select("*", F.explode(kinds).alias("kind")).select(
            pick(born, far + 12, far + 1).alias("d"), born.alias("born"), pick(F.col("text"), copy, F.lit("common")).alias("text"), "source",
            pick(F.col("lang"), F.lit("en"), F.lit("en")).alias("lang"), pick(F.col("n_chars"), F.length(copy), F.lit(6)).cast("long").alias("n_chars"),
        )
        kind = F.length("text") / 3
        begin = F.when(F.length("text") % 3 == 0, F.unhex(F.element_at(F.array(*(F.lit(x) for x in BEGINNINGS)), (F.floor(kind) % len(BEGINNINGS) + 1).cast("int")))).otherwise(F.lit(b""))
        return every.withColumn("content", F.concat(begin, F.encode("text", "UTF-8")))

    @cached_property
    def inode(self) -> DataFrame:
        d = F.col("d")
        file = ~((d % 17 == 0) | (d % 19 == 0))
        failed = file & (d % 10 == 3)
        message = F.when(failed, F.element_at(F.array(*map(F.lit, MESSAGES)), ((d / 10).cast("long") % 7 + 1).cast("int")))
        base = self.files.select(
            d.alias("id"), F.col("source").alias("medium_hash"), (d % 2 + 1).alias("dev"), d.alias("ino"), F.when(d % 13 == 0, 3).otherwise(1).alias("nlink"), F.col("n_chars").alias("size"), (F.lit(1400000000) + F.col("born") * 7200).alias("mtime"),
            F.when(d % 17 == 0, "d").when(d % 19 == 0, "l").otherwise("f").alias("fs_type"), F.when(file & ~failed & (d % 23 != 0), F.sha2("content", 256)).alias("blobid"), message.alias("message"), "lang",
        )
        kind = F.when(F.col("message").isNotNull(), c.classify_error(F.col("message")))
        copied = (F.col("fs_type") != "f") | F.col("blobid").isNotNull() | (F.col("message").isNotNull() & ((F.col("id") / 10).cast("long") % 4 == 0))
        base = base.withColumn("error_type", kind).withColumn("copied", copied)
        status = F.when(F.col("message").isNotNull(), c.failure_status(F.col("error_type"))).when((F.col("fs_type") == "f") & F.col("blobid").isNull(), "pending").otherwise("success")
        claimed = F.when(F.col("fs_type") != "f", "NON_FILE").when(F.col("id") % 29 == 0, "EXCLUDED").when(F.col("id") % 31 == 0, "DIAGNOSTIC_SKIP:beyond_eof").when(F.col("id") % 7 == 0, F.concat(F.lit("worker-"), F.col("id") % 3))
        return base.select(
            "*", status.alias("status"), claimed.alias("claimed_by"), F.array_repeat("message", (F.col("id") % 6 + 1).cast("int")).alias("errors"),
            F.when(F.col("fs_type") == "f", F.when(F.col("lang") == "en", "text/plain").when(F.col("lang") == "de", "text/html")).otherwise(F.when(F.col("fs_type") == "d", "inode/directory").otherwise("inode/symlink")).alias("mime_type"),
            F.when(F.col("copied"), F.col("mtime") + (F.col("id") % 97) * 30).alias("processed"),
        )

    @cached_property
    def contents(self) -> DataFrame:
        """(blobid, content) of every file, as the archive's store has them."""
        return self.files.select(F.sha2("content", 256).alias("blobid"), "content")

    @cached_property
    def medium(self) -> DataFrame:
        m = self.table("documents").groupBy(F.col("source").alias("medium_hash")).agg(F.min("doc_id").alias("k"))
        bare = self.table("nation").where("n_nationkey % 6 = 0").select(F.concat(F.lit("bare"), F.col("n_nationkey").cast("string")).alias("medium_hash"), (F.lit(1_000_000) + F.col("n_nationkey")).cast("long").alias("k"))
        m = m.unionByName(bare)  # enumerated, some of them, and without a file
        k = F.col("k")
        return m.select(
            "medium_hash", F.concat(F.lit("Medium "), F.col("medium_hash")).alias("medium_human"), (F.lit(1600000000) + F.col("k") * 3600).alias("added"),
            F.when(k % 6 == 1, "incomplete").when(k % 6 == 2, "corrupt").when(k % 6 == 3, "failed").when(k % 6 != 0, "ok").alias("health"),
            F.when(k % 5 != 4, F.lit(1600000600) + k * 3660).alias("enum_done"), F.when((k % 5 != 4) & (k % 4 != 0), F.lit(1600009000) + k * 3700).alias("copy_done"),
            F.when(k % 3 != 0, F.concat(F.lit("/img/"), F.col("medium_hash"), F.lit(".img"))).alias("image_path"), self._problems(k).alias("problems"),
            F.to_json(F.struct(F.concat(F.lit("/dev/loop0: LABEL=x TYPE="), F.element_at(F.array(*map(F.lit, FILESYSTEMS)), (k % 4 + 1).cast("int")), F.lit(" UUID=1")).alias("blkid"), (k * 7_654_321 + 1000).alias("image_size_bytes"), F.when(k % 3 != 0, F.concat(F.lit("image-"), (k % 6).cast("string"))).alias("content_hash"))).alias("diagnostics"),
            F.when(k % 4 == 1, "second pass").alias("message"),
        )

    @staticmethod
    def _problems(k: Column) -> Column:
        """A medium's problems without its events (see ``problems``), as JSON; null where there are none."""
        bad = k % 4 < 2
        files = F.when(bad, F.transform(F.sequence(F.lit(1).cast("long"), k % 3 + 1), lambda i: F.concat(F.lit("f"), i.cast("string"))))
        fields = F.struct(
            F.when(k % 4 == 0, k + 1).alias("io_errors"), F.when(k % 4 == 1, k + 2).alias("fat_errors"), files.alias("error_files"), F.when(k % 3 == 0, F.lit(True)).alias("beyond_eof_detected"),
            F.when(k % 5 == 2, F.struct((k + 10.5).alias("rate_percent"), (k + 100).alias("detected_at_count"))).alias("high_error_rate"), F.when(k % 7 == 3, F.lit(True)).alias("enum_failed"),
        )
        return F.when(bad | (k % 3 == 0) | (k % 5 == 2) | (k % 7 == 3), F.to_json(fields))

    @cached_property
    def path(self) -> DataFrame:
        d = self.inode
        own = F.concat(F.lit("/"), "lang", F.lit("/"), "medium_hash", F.lit("/"), F.col("ino").cast("string"), F.lit(".txt"))
        more = F.when(F.col("nlink") > 1, F.array(own, F.concat(F.lit("/node_modules/"), F.col("ino").cast("string")), F.concat(F.lit("/backup/"), "medium_hash", F.lit("/a.x/"), F.col("ino").cast("string")))).when(F.col("ino") % 11 == 0, F.array(F.concat(F.lit("/.cache/#"), F.col("ino").cast("string")))).otherwise(F.array(own))
        paths = d.select("medium_hash", "dev", "ino", "nlink", "blobid", F.explode(more).alias("path"))
        return paths.withColumn("exclude_reason", c.excluded(F.col("path"), PATTERNS))

    @cached_property
    def blobs(self) -> DataFrame:
        own = self.inode.where("blobid is not null").groupBy("blobid").agg(F.count("*").alias("n_hardlinks"), F.min("processed").alias("created"), F.min("ino").alias("k")).where("k % 37 <> 0")
        lone = self.table("region").select(F.sha2("r_name", 256).alias("blobid"), F.lit(0).cast("long").alias("n_hardlinks"), F.lit(None).cast("long").alias("created"), F.col("r_regionkey").cast("long").alias("k"))
        every = own.unionByName(lone)
        checked = F.when(F.col("k") % 3 != 0, F.lit(1700000000) + F.col("k"))
        return every.select("blobid", "n_hardlinks", "created", checked.alias("last_checked"), F.when(F.col("k") % 4 == 0, True).when(F.col("k") % 4 == 1, False).alias("external_copied"), F.when(F.col("k") % 11 == 0, True).alias("external_copy_failed"), *self._extraction(F.col("k")))

    @staticmethod
    def _extraction(k: Column) -> list[Column]:
        """What an archive's extraction left of it."""
        status = F.when(k % 5 == 0, "complete").when(k % 5 == 1, "failed").when(k % 5 == 2, "pilot").when(k % 5 == 3, "pending")
        kinds = F.array(*map(F.lit, ("application/gzip", "application/x-bzip2", "application/x-tar", "application/zip", "text/plain")))
        return [
            F.element_at(kinds, (k % 7 % 5 + 1).cast("int")).alias("mime_type"),
            status.alias("extraction_status"), F.when(k % 2 == 0, "tar").otherwise("zip").alias("extraction_method"), F.when(k % 5 == 1, F.when(k % 3 == 0, "bad header").otherwise("password")).alias("extraction_error"),
            (k % 7 + 1).alias("files_extracted"), (k % 6 == 0).alias("is_intermediate"), F.when(k % 5 < 3, F.lit(1700000000) + k * 60).alias("extracted_at"),
        ]

    @cached_property
    def matrix(self) -> DataFrame:
        """Distinct (blob, medium, size) of copied files with a path that is not excluded."""
        live = self.path.where("exclude_reason is null").select("medium_hash", "ino").distinct()
        return self.inode.where("blobid is not null and copied").join(live, ["medium_hash", "ino"], "left_semi").select("blobid", "medium_hash", "size").distinct()

    @cached_property
    def events(self) -> DataFrame:
        """Diagnostic events, exploded out of each medium's JSON problems."""
        kind = "array<struct<ino:bigint,retry_count:bigint,checks:array<string>,action:string,day:bigint,worker_id:string,exception_type:string,exception_msg:string,timestamp:string>>"
        return self.problems.select("medium_hash", F.explode(F.from_json(F.get_json_object("problems", "$.diagnostic_events"), kind)).alias("e")).select("medium_hash", "e.*")

    @cached_property
    def problems(self) -> DataFrame:
        """(medium_hash, part, problems): JSON with at most 500 diagnostic_events and, for some, high_error_rate or beyond_eof_detected."""
        e, u = F.col("event_id"), F.col("user_id")
        kind, at = F.col("event_type"), F.element_at(F.array(*map(F.lit, MESSAGES)), (F.col("event_id") % 7 + 1).cast("int"))
        row = F.struct(
            F.col("event_id").alias("ino"), (e % 50 + 1).alias("retry_count"), F.array(F.concat(F.lit("detected_"), kind), F.when(e % 3 == 0, "dmesg:beyond_eof").otherwise("dmesg:clean")).alias("checks"),
            F.when(e % 5 == 0, "diagnostic_skip").when(e % 5 == 1, "remounted").otherwise("continuing").alias("action"), (e / 500).cast("long").alias("day"), F.concat(F.lit("worker-"), e % 4).alias("worker_id"), F.when(e % 2 == 0, "OSError").otherwise("PermissionError").alias("exception_type"), at.alias("exception_msg"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        )
        grouped = self.table("events").groupBy(F.concat(F.lit("src"), u % 20).alias("medium_hash"), (e / 500).cast("long").alias("part")).agg(F.sort_array(F.collect_list(row)).alias("diagnostic_events"))
        k = F.regexp_extract("medium_hash", "([0-9]+)", 1).cast("int")
        rate = F.when(k % 4 == 0, F.struct((k + 10).cast("double").alias("rate_percent"), F.lit(True).alias("flagged")))
        return grouped.select("medium_hash", "part", F.to_json(F.struct("diagnostic_events", rate.alias("high_error_rate"), F.when(k % 3 == 0, F.lit(True)).alias("beyond_eof_detected"))).alias("problems"))

    def stored(self, at: str) -> Stored:
        """Write the tables below ``at``, those of media partitioned by medium, and read them from there: texts are hashed once."""
        from quarry.sources.sinks import write_media

        for name in ("inode", "path"):
            write_media(getattr(self, name), f"{at}/{name}")
        kept = Stored(self.spark, self.sf_dir, at)
        write_media(kept.derived_matrix, f"{at}/matrix")
        Catalog.blobs.func(kept).write.mode("overwrite").parquet(f"{at}/blobs")
        return kept


class Stored(Catalog):
    """The catalog out of its written tables; a filter on the medium prunes the others' folders."""

    def __init__(self, spark: SparkSession, sf_dir: str, at: str):
        super().__init__(spark, sf_dir)
        self.at = at

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/{name}")

    @cached_property
    def inode(self) -> DataFrame:
        return self._read("inode")

    @cached_property
    def path(self) -> DataFrame:
        return self._read("path")

    @property
    def derived_matrix(self) -> DataFrame:
        return Catalog.matrix.func(self)

    @cached_property
    def matrix(self) -> DataFrame:
        return self._read("matrix")

    @cached_property
    def blobs(self) -> DataFrame:
        return self._read("blobs")


_classes = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(message), {chr(39)}{p}{chr(39)})' for p in parts)} THEN '{kind}'" for kind, parts in c.ERROR_RULES) + " ELSE 'unknown' END"
_messages = "[" + ", ".join(f"'{m}'" for m in MESSAGES) + "]"
_begin = "[" + ", ".join(f"'{x}'" for x in BEGINNINGS) + "]"


def sniff_sql(content: str) -> str:
    """``columns.sniff_mime`` of a blob expression, for DuckDB."""
    digits = f"substr(hex({content}), 1, {2 * c.HEAD})"
    blank = "(09|0A|0D|20)*"
    when = [f"WHEN substr({digits}, {2 * offset + 1}, {len(magic)}) = '{magic}' THEN '{kind}'" for offset, magic, kind in c.MAGIC]
    for begin, kind in c.TEXT_MAGIC:
        either = "".join(f"({ord(x):02X}|{ord(x.upper()):02X})" for x in begin)
        when.append(f"WHEN regexp_matches(substr({digits}, 1, 128), '^{blank}{either}') THEN '{kind}'")
    return f"CASE WHEN octet_length({content}) = 0 THEN '{c.EMPTY_TYPE}' {' '.join(when)} WHEN NOT regexp_matches({digits}, '^(..)*00') THEN 'text/plain' ELSE 'application/octet-stream' END"


SQL = f"""
WITH files_own AS (
  SELECT doc_id AS d, doc_id AS born, text, source, lang, n_chars FROM documents
  UNION ALL SELECT {FAR} * (doc_id + 1) + 1, doc_id, 'common', source, 'en', 6 FROM documents WHERE doc_id < 200 OR doc_id % 50 = 7
  UNION ALL SELECT {FAR} * (doc_id + 1) + 12, doc_id, 'shared ' || (doc_id // 495), source, 'en', length('shared ' || (doc_id // 495)) FROM documents WHERE doc_id % 15 = 9),
files AS (SELECT *, (CASE WHEN length(text) % 3 = 0 THEN unhex({_begin}[(length(text) // 3) % {len(BEGINNINGS)} + 1]) ELSE ''::BLOB END) || encode(text) AS content FROM files_own),
inode_base AS (
  SELECT d AS id, source AS medium_hash, d % 2 + 1 AS dev, d AS ino, CASE WHEN d % 13 = 0 THEN 3 ELSE 1 END AS nlink, n_chars AS size, 1400000000 + born * 7200 AS mtime,
    CASE WHEN d % 17 = 0 THEN 'd' WHEN d % 19 = 0 THEN 'l' ELSE 'f' END AS fs_type,
    CASE WHEN d % 17 <> 0 AND d % 19 <> 0 AND d % 10 <> 3 AND d % 23 <> 0 THEN sha256(content) END AS blobid,
    CASE WHEN d % 17 <> 0 AND d % 19 <> 0 AND d % 10 = 3 THEN {_messages}[(d // 10) % 7 + 1] END AS message, lang FROM files),
inode_kind AS (
  SELECT *, CASE WHEN message IS NOT NULL THEN {_classes} END AS error_type,
    fs_type <> 'f' OR blobid IS NOT NULL OR (message IS NOT NULL AND (id // 10) % 4 = 0) AS copied FROM inode_base),
inode AS (
  SELECT *, CASE WHEN message IS NOT NULL THEN CASE WHEN error_type = 'io_error' THEN 'failed_permanent' ELSE 'failed_retryable' END WHEN fs_type = 'f' AND blobid IS NULL THEN 'pending' ELSE 'success' END AS status,
    CASE WHEN fs_type <> 'f' THEN 'NON_FILE' WHEN id % 29 = 0 THEN 'EXCLUDED' WHEN id % 31 = 0 THEN 'DIAGNOSTIC_SKIP:beyond_eof' WHEN id % 7 = 0 THEN 'worker-' || (id % 3) END AS claimed_by,
    list_transform(range(id % 6 + 1), lambda i: message) AS errors,
    CASE WHEN fs_type = 'f' THEN CASE lang WHEN 'en' THEN 'text/plain' WHEN 'de' THEN 'text/html' END WHEN fs_type = 'd' THEN 'inode/directory' ELSE 'inode/symlink' END AS mime_type,
    CASE WHEN copied THEN mtime + (id % 97) * 30 END AS processed FROM inode_kind),
medium_base AS (SELECT source AS medium_hash, min(doc_id) AS k FROM documents GROUP BY source UNION ALL SELECT 'bare' || n_nationkey, 1000000 + n_nationkey FROM nation WHERE n_nationkey % 6 = 0),
medium AS (
  SELECT medium_hash, 'Medium ' || medium_hash AS medium_human, 1600000000 + k * 3600 AS added,
    CASE k % 6 WHEN 1 THEN 'incomplete' WHEN 2 THEN 'corrupt' WHEN 3 THEN 'failed' WHEN 0 THEN NULL ELSE 'ok' END AS health,
    CASE WHEN k % 5 <> 4 THEN 1600000600 + k * 3660 END AS enum_done, CASE WHEN k % 5 <> 4 AND k % 4 <> 0 THEN 1600009000 + k * 3700 END AS copy_done,
    CASE WHEN k % 3 <> 0 THEN '/img/' || medium_hash || '.img' END AS image_path,
    CASE WHEN k % 4 = 0 THEN k + 1 END AS io_errors, CASE WHEN k % 4 = 1 THEN k + 2 END AS fat_errors, CASE WHEN k % 4 < 2 THEN k % 3 + 1 END AS error_files, k % 3 = 0 AS beyond_eof,
    CASE WHEN k % 5 = 2 THEN CAST(k + 10.5 AS DOUBLE) END AS rate_percent, CASE WHEN k % 5 = 2 THEN k + 100 END AS detected_at_count, k % 7 = 3 AS enum_failed,
    k % 4 < 2 OR k % 3 = 0 OR k % 5 = 2 OR k % 7 = 3 AS has_problems, ['ext4', 'vfat', 'hfsplus', 'iso9660'][k % 4 + 1] AS filesystem, CAST(k * 7654321 + 1000 AS BIGINT) AS image_size_bytes,
    CASE WHEN k % 3 <> 0 THEN 'image-' || (k % 6) END AS content_hash, CASE WHEN k % 4 = 1 THEN 'second pass' END AS message FROM medium_base),
path_all AS (
  SELECT medium_hash, dev, ino, nlink, blobid, unnest(CASE WHEN nlink > 1 THEN ['/' || lang || '/' || medium_hash || '/' || ino || '.txt', '/node_modules/' || ino, '/backup/' || medium_hash || '/a.x/' || ino]
    WHEN ino % 11 = 0 THEN ['/.cache/#' || ino] ELSE ['/' || lang || '/' || medium_hash || '/' || ino || '.txt'] END) AS path FROM inode),
path AS (SELECT *, CASE WHEN regexp_matches(path, 'node_modules|\\.cache|#') THEN 'pattern_match' END AS exclude_reason FROM path_all),
blob_base AS (
  SELECT blobid, count(*) AS n_hardlinks, min(processed) AS created, min(ino) AS k FROM inode WHERE blobid IS NOT NULL GROUP BY blobid HAVING min(ino) % 37 <> 0
  UNION ALL SELECT sha256(r_name), 0, NULL, r_regionkey FROM region),
blobs AS (
  SELECT blobid, n_hardlinks, created, CASE WHEN k % 3 <> 0 THEN 1700000000 + k END AS last_checked, CASE k % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS external_copied,
    CASE WHEN k % 11 = 0 THEN TRUE END AS external_copy_failed, CASE k % 5 WHEN 0 THEN 'complete' WHEN 1 THEN 'failed' WHEN 2 THEN 'pilot' WHEN 3 THEN 'pending' END AS extraction_status, ['application/gzip', 'application/x-bzip2', 'application/x-tar', 'application/zip', 'text/plain'][k % 7 % 5 + 1] AS mime_type, CASE WHEN k % 2 = 0 THEN 'tar' ELSE 'zip' END AS extraction_method,
    CASE WHEN k % 5 = 1 THEN CASE WHEN k % 3 = 0 THEN 'bad header' ELSE 'password' END END AS extraction_error, k % 7 + 1 AS files_extracted, k % 6 = 0 AS is_intermediate, CASE WHEN k % 5 < 3 THEN 1700000000 + k * 60 END AS extracted_at FROM blob_base),
matrix AS (
  SELECT DISTINCT i.blobid, i.medium_hash, i.size FROM inode i JOIN path p ON p.medium_hash = i.medium_hash AND p.ino = i.ino WHERE i.blobid IS NOT NULL AND i.copied AND p.exclude_reason IS NULL),
ev AS (
  SELECT 'src' || (user_id % 20) AS medium_hash, event_id AS ino, event_id % 50 + 1 AS retry_count, ['detected_' || event_type, CASE WHEN event_id % 3 = 0 THEN 'dmesg:beyond_eof' ELSE 'dmesg:clean' END] AS checks,
    CASE event_id % 5 WHEN 0 THEN 'diagnostic_skip' WHEN 1 THEN 'remounted' ELSE 'continuing' END AS action, event_id // 500 AS day, 'worker-' || (event_id % 4) AS worker_id,
    CASE WHEN event_id % 2 = 0 THEN 'OSError' ELSE 'PermissionError' END AS exception_type, {_messages}[event_id % 7 + 1] AS exception_msg, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp FROM events)
"""
