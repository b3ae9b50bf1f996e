"""From raw records to inode and path tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.functions import patterns as patterns_


def typed(raw: DataFrame, medium_hash: str) -> DataFrame:
    """Fields of raw records (see sources.raw) as typed columns of one medium; the path stays byte-exact in ``path``."""
    number = lambda name: F.nullif(F.col(name), F.lit("")).cast("long")
    return raw.select(F.lit(medium_hash).alias("medium_hash"), "fs_type", number("dev").alias("dev"), number("ino").alias("ino"), number("nlink").cast("int").alias("nlink"), number("size").alias("size"), number("mtime").alias("mtime"), F.encode("path", "ISO-8859-1").alias("path"), F.col("path").alias("path_text"))


def inodes(staged: DataFrame, by_dev: bool = False) -> DataFrame:
    """One row per (medium, ino), or (medium, dev, ino): the least of the others, summed map-side."""
    keys = ["medium_hash", "dev", "ino"] if by_dev else ["medium_hash", "ino"]
    rest = [x for x in ("dev", "nlink", "size", "mtime", "fs_type") if x not in keys]
    one = staged.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("first")).select(*keys, "first.*")
    file = F.col("fs_type") == "f"
    return one.select("*", (~file).alias("copied"), F.when(~file, "NON_FILE").alias("claimed_by"))


def mark_excluded(paths: DataFrame, patterns: list[str], column: str = "path") -> DataFrame:
    """Rows without a reason get one where a pattern matches; others keep theirs."""
    return paths.withColumn("exclude_reason", F.coalesce("exclude_reason", c.excluded(F.col(column), patterns)))


def drop_excluded(raw: DataFrame, patterns: list[str], column: str = "path") -> DataFrame:
    live = patterns_.live(patterns)
    return raw.where(~patterns_.matches(F.col(column), live)) if live else raw


def pattern_impact(paths: DataFrame, patterns: list[str], column: str = "path") -> DataFrame:
    """(pattern, n_paths) of each live pattern: one pass over the paths, in which a pattern is tried only where a string that it requires stands."""
    live = list(dict.fromkeys(patterns_.live(patterns)))
    if not live:
        return paths.sparkSession.createDataFrame([], "pattern string, n_paths long")
    counts = paths.agg(*(F.count_if(patterns_.matches(F.col(column), [p])).alias(str(k)) for k, p in enumerate(live)))
    rows = F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(f"`{k}`").alias("n_paths")) for k, p in enumerate(live)))
    return counts.select(F.explode(rows).alias("x")).select("x.*")


def exclude_inodes(inode: DataFrame, path: DataFrame) -> DataFrame:
    """Uncopied inodes all of whose paths are excluded become EXCLUDED, and count as copied."""
    live = path.where("exclude_reason is null").select("medium_hash", "ino").distinct().withColumn("__live", F.lit(True))
    hit = F.col("__live").isNull() & ~F.coalesce(F.col("copied"), F.lit(False))
    out = {"copied": F.when(hit, True).otherwise(F.col("copied")), "claimed_by": F.when(hit, "EXCLUDED").otherwise(F.col("claimed_by"))}
    return inode.join(live, ["medium_hash", "ino"], "left").select(*[out.get(x, F.col(x)).alias(x) for x in inode.columns])


def load(raw: DataFrame, medium_hash: str, patterns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(inode, path, queue_stats) of one medium from its raw records (see sources.raw), as ``sinks.write_media`` takes them."""
    staged = typed(raw, medium_hash).withColumn("exclude_reason", c.excluded(F.col("path_text"), patterns))
    path = staged.select("medium_hash", "dev", "ino", "path", "path_text", "exclude_reason")
    inode = exclude_inodes(inodes(staged), path)
    return inode, path, queue_stats(inode)


def load_counts(inode: DataFrame, path: DataFrame) -> DataFrame:
    """What a load reports of each medium."""
    i = inode.groupBy("medium_hash").agg(F.count("*").alias("inodes"), F.count_if(F.col("claimed_by") == "NON_FILE").alias("non_file"), F.count_if(F.col("claimed_by") == "EXCLUDED").alias("all_excluded"), F.count_if(~F.col("copied") & F.col("claimed_by").isNull()).alias("unclaimed"))
    p = path.groupBy("medium_hash").agg(F.count("*").alias("paths"), F.count("exclude_reason").alias("excluded"))
    return i.join(p, "medium_hash", "left").na.fill(0, ["paths", "excluded"])


def queue_stats(inode: DataFrame) -> DataFrame:
    return inode.groupBy("medium_hash").agg(F.count_if(~F.coalesce("copied", F.lit(False)) & F.col("claimed_by").isNull()).alias("unclaimed_count"), F.count("*").alias("total_count"))


def path_search(paths: DataFrame) -> DataFrame:
    """Unpartitioned search projection; write it sorted by filename for range pruning."""
    return paths.select("medium_hash", "path", c.filename(F.col("path")).alias("filename"), c.parent_name(F.col("path")).alias("parent"))


def media_with_prefix(path: DataFrame, inode: DataFrame, prefix: str) -> DataFrame:
    under = path.where(F.col("path").startswith(prefix.rstrip("/") + "/")).select("medium_hash", "dev", "ino")
    rows = under.join(inode.select("medium_hash", "ino", "size", "copied"), ["medium_hash", "ino"])
    return rows.groupBy("medium_hash").agg(F.count("*").alias("paths"), F.count_distinct(F.struct("dev", "ino")).alias("inodes"), F.sum("size").alias("bytes"), F.count_if("copied").alias("copied"))


def leaf_paths(paths: DataFrame) -> DataFrame:
    """Paths that are no proper ancestor of another path of the same inode: ancestors exploded, then an anti-join."""
    parts = F.split("path", "/")
    ancestors = paths.select("medium_hash", "ino", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("path"))
    return paths.join(ancestors, ["medium_hash", "ino", "path"], "left_anti")
