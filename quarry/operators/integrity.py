"""Reconciliation, selection for verification, and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def reconcile(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Counts ``n`` of both sides by key, absent ones 0."""
    both = old.withColumnRenamed("n", "o").join(new, key, "full")
    zero = F.lit(0).cast("long")
    return both.select(key, F.coalesce("o", zero).alias("old_n"), F.coalesce("n", zero).alias("new_n")).withColumn("same", F.col("old_n") == F.col("new_n"))


def select_blobs(blobs: DataFrame, mode: str, n: int, seed: int = 0, inode: DataFrame | None = None, share: float = 0.25) -> DataFrame:
    """The n blobs to verify (blobid).

    oldest: longest since the last check, never checked ones first; newest: of the latest copied inode (``inode`` is needed); never: never checked;
    random: seeded, out of a sample of ``share`` of the table by hash, filled up with never checked ones if that has too few.
    """
    if mode == "never":
        return blobs.where("last_checked is null").orderBy("blobid").limit(n).select("blobid")
    if mode == "oldest":
        return blobs.orderBy(F.asc_nulls_first("last_checked"), "blobid").limit(n).select("blobid")
    if mode == "newest":
        latest = inode.where("processed is not null and blobid is not null").groupBy("blobid").agg(F.max("processed").alias("latest"))
        return blobs.select("blobid").join(latest, "blobid").orderBy(F.desc("latest"), "blobid").limit(n).select("blobid")
    if mode == "random":
        digest = F.md5(F.concat("blobid", F.lit(str(seed))))
        some = blobs.select("blobid", digest.alias("d")).where(F.substring("d", 1, 2) < f"{int(share * 256):02x}").orderBy("d", "blobid").limit(n).select("blobid", F.lit(0).alias("o"))
        more = blobs.where("last_checked is null").select("blobid").join(some.select("blobid"), "blobid", "left_anti").orderBy("blobid").limit(n).select("blobid", F.lit(1).alias("o"))
        return some.unionByName(more).orderBy("o", "blobid").limit(n).select("blobid")
    raise ValueError(f"unknown mode {mode!r}")


def asked_blobs(blobs: DataFrame, ids: DataFrame) -> DataFrame:
    """The blobs of a list of ids (one line each, blank ones aside), as ``spark.read.text`` gives it."""
    asked = ids.select(F.trim("value").alias("blobid")).where("blobid <> ''").distinct()
    return blobs.join(asked, "blobid", "left_semi")


def verify(paths: DataFrame, found: DataFrame) -> DataFrame:
    """``paths``: (blobid, path), ``found``: (path) of what is there.  (blobid, n_paths, n_missing, ok); a blob without paths is not in it."""
    there = found.select("path").distinct().withColumn("__there", F.lit(True))
    n = paths.join(there, "path", "left").groupBy("blobid").agg(F.count("*").alias("n_paths"), F.count_if(F.col("__there").isNull()).alias("n_missing"))
    return n.withColumn("ok", F.col("n_missing") == 0)


def pending_backup(blobs: DataFrame) -> DataFrame:
    """Blobs that are not backed up and have not failed."""
    return blobs.where(~F.coalesce(F.col("external_copied"), F.lit(False)) & ~F.coalesce(F.col("external_copy_failed"), F.lit(False)))


def not_in(rows: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """The rows whose ``column`` is NOT IN the only column of ``listed``, by a shuffle anti join whatever the list's size.

    As in SQL: a null in the list leaves nothing, a null value is in doubt unless the list is empty.
    """
    key = F.col(listed.columns[0])
    # of one row
    state = listed.agg(F.coalesce(F.bool_or(key.isNull()), F.lit(False)).alias("__null"), F.count("*").alias("__n"))
    left = rows.hint("merge").join(listed.select(key.alias(column)).where(F.col(column).isNotNull()).hint("merge"), column, "left_anti")
    sure = ~F.col("__null") & (F.col(column).isNotNull() | (F.col("__n") == 0))
    return left.crossJoin(F.broadcast(state)).where(sure).select(*(F.col(f"`{x}`") for x in rows.columns))


def orphans(inode: DataFrame, blobs: DataFrame) -> DataFrame:
    """Successful inodes whose blob the table lacks."""
    return inode.where("blobid is not null and status = 'success'").join(blobs.select("blobid"), "blobid", "left_anti")


def full_hashes(short: DataFrame, blobs: DataFrame) -> DataFrame:
    """Whole ids of 12-digit short ones: an equi-join on the prefix."""
    return blobs.withColumn("short", F.substring("blobid", 1, 12)).join(short.select("short").distinct(), "short", "left_semi").select("blobid")


def stratified(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n seeded rows of each stratum; the rank limit leaves n rows a task and stratum before the shuffle."""
    order = W.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), key)
    return rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")


def difference(asked: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return asked.join(done.select(key), key, "left_anti")


def touch_verified(blobs: DataFrame, results: DataFrame, now: int) -> DataFrame:
    """Only blobs with a good result get a new time of check.  ``results``: (blobid, ok)."""
    good = results.where("ok").select("blobid").distinct().withColumn("__ok", F.lit(True))
    return blobs.join(good, "blobid", "left").withColumn("last_checked", F.when(F.col("__ok"), F.lit(now)).otherwise(F.col("last_checked"))).drop("__ok")


def violations(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value is not null and none of the allowed ones."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
