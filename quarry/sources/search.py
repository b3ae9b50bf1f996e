"""A stored index over paths: which files may hold a name or a path's end is known before any is opened.

Two projections of the paths, cut into files by ranges: one sorted by filename, one by
the reversed path, in which every path that ends alike stands together.  A small
manifest has the first and the last key of each file, so that a search lists, opens and
reads only files whose range holds what is asked; in them Parquet's page statistics
and the pushed filter leave few pages.  Rebuilding writes a new generation and then
swaps the manifest; searches that run keep to the old one.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.sources.shared import delete, file_system

ROWS_PER_FILE = 2_000_000
_SCHEMA = "medium_hash string, path string, filename string, parent_filename string, ending string"


def projected(paths: DataFrame) -> DataFrame:
    """(medium_hash, path, filename, parent_filename, ending) of (medium_hash, path); ``ending`` is the reversed path."""
    parent = F.regexp_replace("path", "^.*/([^/]+/[^/]+)$", "$1")
    return paths.select("medium_hash", "path", c.filename(F.col("path")).alias("filename"), parent.alias("parent_filename"), F.reverse("path").alias("ending"))


class SearchIndex:
    def __init__(self, spark: SparkSession, at: str):
        self.spark, self.at = spark, at.rstrip("/")

    def build(self, paths: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Write both projections of ``paths`` (medium_hash, path) and swap them in; null paths are left out."""
        rows = projected(paths.where("path is not null"))
        generation = uuid.uuid4().hex
        n = max(1, -(-rows.count() // rows_per_file))
        manifest = {key: self._write(rows, key, n, generation) for key in ("filename", "ending")}
        fs, _ = file_system(self.spark, self.at)
        beside = file_system(self.spark, f"{self.at}/{generation}.json")[1]
        out = fs.create(beside, False)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        self._swap(fs, beside)
        self.refresh()

    def _swap(self, fs, beside) -> None:
        jvm = self.spark.sparkContext._jvm
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kinds, 1)
        how[0] = kinds.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(beside), fs.makeQualified(file_system(self.spark, f"{self.at}/manifest.json")[1]), how)

    def _write(self, rows: DataFrame, key: str, files: int, generation: str) -> list[list[str]]:
        """One file a range; (file, first key, last key), in order."""
        path = f"{self.at}/{generation}/{key}"
        ordered = rows.repartitionByRange(files, key, "medium_hash", "path").sortWithinPartitions(key, "medium_hash", "path")
        ordered.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).option("parquet.page.row.count.limit", 5_000).parquet(path)
        name = F.element_at(F.split(F.input_file_name(), "/"), -1)
        # a row a file; first and last keys by sorted order are the footers' own statistics
        bounds = self.spark.read.schema(_SCHEMA).parquet(path).select(name.alias("file"), key).groupBy("file").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        return sorted(([f"{generation}/{key}/{r.file}", r.lo, r.hi] for r in bounds), key=lambda x: (x[1].encode(), x[2].encode()))

    def vacuum(self) -> None:
        """Delete generations before the current one; not while searches run on them."""
        current = next((x[0].split("/")[0] for own in self.manifest.values() for x in own), None)
        fs, folder = file_system(self.spark, self.at)
        for x in fs.listStatus(folder):
            if x.isDirectory() and x.getPath().getName() != current:
                delete(self.spark, x.getPath().toString())

    @cached_property
    def manifest(self) -> dict[str, list[list[str]]]:
        """Read once; a row a file."""
        fs, at = file_system(self.spark, f"{self.at}/manifest.json")
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def refresh(self) -> None:
        """Look at the newest generation from now on."""
        self.__dict__.pop("manifest", None)

    def files(self, key: str, ranges: list[tuple[str, str]]) -> list[str]:
        """The files that may hold a key in one of the ranges (first, last)."""
        own = self.manifest[key]
        ends = [hi.encode() for *_, hi in own]
        found: set[int] = set()
        for lo, hi in ranges:
            k = bisect_left(ends, lo.encode())
            while k < len(own) and own[k][1].encode() <= hi.encode():
                found.add(k)
                k += 1
        return [own[k][0] for k in sorted(found)]

    def _read(self, key: str, ranges: list[tuple[str, str]]) -> DataFrame:
        files = [f"{self.at}/{x}" for x in self.files(key, ranges)]
        return self.spark.read.schema(_SCHEMA).parquet(*files) if files else self.spark.createDataFrame([], _SCHEMA)

    def by_name(self, *names: str) -> DataFrame:
        """(medium_hash, path, filename, parent_filename) of paths with one of the filenames."""
        names = tuple(dict.fromkeys(names))
        return self._read("filename", [(n, n) for n in names]).where(F.col("filename").isin(*names)).drop("ending")

    def matches(self, *names: str) -> DataFrame:
        """(filename, match_count, found_in) of each filename that is there."""
        return self.by_name(*names).groupBy("filename").agg(F.count("*").alias("match_count"), F.array_sort(F.collect_set("medium_hash")).alias("found_in"))

    def by_ending(self, *endings: str) -> DataFrame:
        """(medium_hash, path, filename, parent_filename) of paths that end so; each path once."""
        turned = [x[::-1] for x in dict.fromkeys(endings) if x]
        if not turned:
            return self.spark.createDataFrame([], _SCHEMA).drop("ending")
        hit = F.lit(False)
        for x in turned:
            hit = hit | F.col("ending").startswith(x)  # pushed down as a range of the sorted column
        return self._read("ending", [(x, x + "\U0010ffff") for x in turned]).where(hit).drop("ending")
