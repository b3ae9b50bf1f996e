"""Sinks: replace by medium, insert if absent, upsert, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources.shared import shared_folder


def write_media(rows: DataFrame, path: str, mode: str = "replace") -> None:
    """Partitioned by medium; 'replace' swaps the media that are in ``rows`` and no others, 'append' adds to them."""
    writer = rows.write.partitionBy("medium_hash")
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "append":
        writer.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to a shared folder and read them from there, so that what asks for them again does not compute them again."""
    at = shared_folder(rows.sparkSession, name)
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def copy_media(rows: DataFrame, path: str) -> DataFrame:
    """Write all media partitioned, read them back, and compare: (medium_hash, old_n, new_n, same)."""
    from quarry.operators.integrity import reconcile

    count = lambda df: df.groupBy("medium_hash").agg(F.count("*").alias("n"))
    write_media(rows, path)
    return reconcile(count(rows), count(rows.sparkSession.read.parquet(path)), "medium_hash")


def refresh_search(paths: DataFrame, path: str) -> None:
    """Rewrite the search projection, sorted by filename in ranges, so that a search reads few files."""
    from quarry.operators.ingest import path_search

    path_search(paths).repartitionByRange(F.col("filename")).sortWithinPartitions("filename").write.mode("overwrite").parquet(path)


def drop_medium(spark, path: str, medium_hash: str) -> None:
    """Delete a medium's partition of a table; an absent one is no error."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/medium_hash={medium_hash}")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def insert_absent(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` and the rows of ``new`` whose key it lacks, each key once."""
    return table.unionByName(new.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(table: DataFrame, new: DataFrame, keys: list[str], add: tuple[str, ...] = ()) -> DataFrame:
    """Full outer join: columns of ``new`` win, those in ``add`` are summed."""
    both = table.alias("t").join(new.alias("n"), keys, "full")
    out = []
    for x in table.columns:
        if x in keys:
            out.append(F.col(x))
        elif x in add:
            out.append((F.coalesce(F.col(f"t.{x}"), F.lit(0)) + F.coalesce(F.col(f"n.{x}"), F.lit(0))).alias(x))
        else:
            out.append(F.coalesce(F.col(f"n.{x}"), F.col(f"t.{x}")).alias(x) if x in new.columns else F.col(f"t.{x}").alias(x))
    return both.select(*out)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def keyed_json(rows: DataFrame, key: str) -> DataFrame:
    """(key, json): one JSON object a row, to be looked up by key."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("json"))
