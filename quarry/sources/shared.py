"""Folders that driver and executors share, for stored tables, states and files of a run."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_made: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application; for functions that run in Python there."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="quarry-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(at))
        _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared one (``spark.checkpoint.dir``); on one machine, of this process where none is set.

    It is deleted by ``release`` or when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quarry-")
    at = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, at))
    return at


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file; an absent one is no error."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def release() -> None:
    """Delete all folders made so far; results that were not written yet are lost.  A process that goes on calls it between jobs."""
    while _made:
        spark, at = _made.pop()
        try:
            delete(spark, at)
        except Exception:  # the JVM may be gone at exit; the cluster sweeps its folder
            pass


atexit.register(release)
