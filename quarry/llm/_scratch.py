"""Tables in the folder that driver and executors share.

Long plans cut their lineage by writing a table below ``spark.checkpoint.dir``
and reading it back, so that a lost executor costs one stage and not the whole
job.  The setting is read from the session; only where it is unset and the master
is local (tests, a laptop) a folder of this process is used.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: list[tuple[SparkSession, str]] = []


_shipped: set[str] = set()
#: rows are whole texts; Spark's own default of 10000 of them is too much for one batch
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="quarry-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(at))
        _shipped.add(sc.applicationId)


def arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors.  If the session has Spark's default, batches become smaller, for the session."""
    ship(df.sparkSession)
    name, default, rows = BATCH_ROWS
    if df.sparkSession.conf.get(name, default) == default:
        df.sparkSession.conf.set(name, rows)
    return df.mapInArrow(function, schema)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; on one machine, if none is set, a folder of this process."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="quarry-")
        at = _own[app]
    return at.rstrip("/")


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table; absent ones are no error."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables of one operator call.  ``keep`` writes and rereads, ``drop`` frees."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        _made.append((spark, self.base))

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.base}/{name}"
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path) if not partition_by else self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                drop(self.spark, self.paths.pop(name))


def release() -> None:
    """Delete all tables made so far; results that were not written yet are lost.  A process that goes on calls it between jobs."""
    while _made:
        spark, base = _made.pop()
        try:
            drop(spark, base)
        except Exception:  # the JVM may be gone at exit; the cluster sweeps its folder
            pass


atexit.register(release)
