"""File sources: raw enumeration records, map files, JSON-lines logs, carved trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c

FIELDS = ("fs_type", "dev", "ino", "nlink", "size", "mtime", "path")
SEPARATOR = "\x1c"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """NUL-terminated records of seven fields; bytes are kept as Latin-1, and the path may hold the separator.

    For any file store that Spark knows; a byte 1 ends a path here.  ``readers`` has a source that takes every byte and cuts files.
    """
    lines = spark.read.option("lineSep", "\0").option("sep", "\x01").option("quote", "").option("escape", "").option("encoding", "ISO-8859-1").schema("value string").csv(path)
    part = F.split("value", SEPARATOR, len(FIELDS))
    return lines.where(F.size(part) == len(FIELDS)).select(*[part[i].alias(f) for i, f in enumerate(FIELDS)])


def tail_raw(spark: SparkSession, path: str, n: int = 10) -> list:
    return read_raw(spark, path).tail(n)


def mapfile_rows(lines: DataFrame) -> DataFrame:
    """(pos, size, status) of the block lines of a rescue map; comments and the status line fall out."""
    part = F.split(F.trim("value"), r"\s+")
    block = lines.where(F.col("value").rlike(r"^\s*0x[0-9A-Fa-f]+\s+0x[0-9A-Fa-f]+\s+[-+?*/]\s*$"))
    number = lambda x: F.conv(F.substring(x, 3, 16), 16, 10).cast("long")
    return block.select(number(part[0]).alias("pos"), number(part[1]).alias("size"), part[2].alias("status"))


def read_mapfile(spark: SparkSession, path: str) -> DataFrame:
    return mapfile_rows(spark.read.text(path))


def rescue_summary(rows: DataFrame) -> DataFrame:
    """Rescued and total bytes, their percentage cut to two places, and the health class."""
    n = rows.agg(F.coalesce(F.sum(F.when(F.col("status") == "+", F.col("size"))), F.lit(0)).alias("rescued"), F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    pct = c.rescued_pct(F.col("rescued"), F.col("total"))
    return n.select("rescued", "total", pct.alias("pct"), c.health_class(pct).alias("health"))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; malformed ones are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def last_rows(log: DataFrame, stage: str) -> DataFrame:
    """The ``rows`` of the latest event of a stage, 'unknown' if there is none."""
    return log.where(F.col("stage") == stage).agg(F.coalesce(F.max_by(F.col("rows").cast("string"), "ts"), F.lit("unknown")).alias("rows"))


def missing_blobs(log: DataFrame) -> DataFrame:
    """Distinct short ids of error records of a verification log (text, record{level{name}, extra{type, blob}})."""
    return log.where((F.col("record.level.name") == "ERROR") & F.col("record.extra.blob").isNotNull()).select(F.substring("record.extra.blob", 1, 12).alias("short")).distinct()


def read_patterns(spark: SparkSession, path: str) -> list[str]:
    """Live patterns of an ignore file, without comments and blanks; a hand-written file, read line by line."""
    lines = spark.read.text(path).where("trim(value) <> '' and not trim(value) like '#%'")
    return [r[0].strip() for r in lines.collect()]


def carved(spark: SparkSession, root: str, medium: str) -> DataFrame:
    """Files below a folder as inodes with dev 1, one link and numbers in path order.

    The files are sorted by range; a file's number is its place in its partition and
    the number of files in those before, a small table.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.unix_seconds("modificationTime").alias("mtime"))
    placed = files.orderBy("path").select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("own"))
    placed = placed.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else placed.persist()  # the places stay as they are
    n = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = n.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(before, "part").select(F.lit(medium).alias("medium_hash"), F.lit(1).cast("long").alias("dev"), (F.col("own") + F.col("before") + 1).alias("ino"), F.lit(1).alias("nlink"), F.col("length").alias("size"), "mtime", F.lit("f").alias("fs_type"), "path")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """A file of ids, one a line: (value)."""
    return spark.read.text(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report's table as it was exported: CSV with a header, or JSON lines, by the name."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if path.rstrip("/").endswith(".csv") else reader.json(path)


def enumerated(spark: SparkSession, root: str) -> DataFrame:
    """Files below a folder as raw records (see ``read_raw``): device, inode and links are what a file store does not tell, so 0, a number and 1."""
    own = carved(spark, root, "")
    return own.select("fs_type", F.lit("0").alias("dev"), *(F.col(x).cast("string").alias(x) for x in ("ino", "nlink", "size", "mtime")), "path")
