"""Content dedup analytics over (blobid, medium_hash, size): reusable operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import columns as c


def sequence_media(media: DataFrame) -> DataFrame:
    """(medium_hash, seq): order of arrival; ties by name.  One row a medium, so one task is enough."""
    return media.select("medium_hash", F.row_number().over(W.orderBy("added", "medium_hash")).alias("seq"))


def first_seen(matrix: DataFrame, order: DataFrame) -> DataFrame:
    """(blobid, size, first_seq): the earliest medium that holds each blob."""
    return matrix.join(order, "medium_hash").groupBy("blobid", "size").agg(F.min("seq").alias("first_seq"))


def _ranked(media: DataFrame) -> DataFrame:
    """(medium_hash, rank) of the media of health 'ok' in order of arrival."""
    return sequence_media(media.where("health = 'ok'")).withColumnRenamed("seq", "rank")


def healthy_media(matrix: DataFrame, media: DataFrame) -> DataFrame:
    """Media in order of arrival: those of health 'ok' that have a blob."""
    own = media.where("health = 'ok'").join(matrix.select("medium_hash").distinct(), "medium_hash", "left_semi")
    return own.join(sequence_media(own), "medium_hash")


def incremental(matrix: DataFrame, media: DataFrame) -> DataFrame:
    """New and duplicate blobs and bytes of each healthy medium in order of arrival, with running totals.

    One aggregation per blob gives all its media, of which the first one is where it is new; nothing is joined back.
    Media without a blob take no number: the ranks of the others are closed up at the end, over a row a medium.
    """
    on = matrix.join(_ranked(media), "medium_hash").groupBy("blobid", "size").agg(F.collect_list("rank").alias("on"))
    each = on.select("size", F.array_min("on").alias("first"), F.explode("on").alias("rank"))
    new = F.col("rank") == F.col("first")
    rows = each.groupBy("rank").agg(
        F.count("*").alias("total_blobs"), F.count_if(new).alias("new_blobs"), F.count_if(~new).alias("dup_blobs"), F.sum(F.when(new, F.col("size")).otherwise(0)).alias("new_bytes"), F.sum(F.when(~new, F.col("size")).otherwise(0)).alias("dup_bytes"), F.sum("size").alias("total_bytes")
    )
    name = F.coalesce("medium_human", F.concat(F.substring("medium_hash", 1, 12), F.lit("..."))).alias("medium_name")
    named = media.where("health = 'ok'").select("medium_hash", name, "added", F.row_number().over(W.orderBy("added", "medium_hash")).alias("rank"))
    rows = rows.join(named, "rank").withColumn("seq", F.row_number().over(W.orderBy("rank")))
    running = W.orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    return rows.select(
        "seq", "medium_hash", "medium_name", "added", "total_blobs", "new_blobs", "dup_blobs", "new_bytes", "dup_bytes", c.gibibytes(F.col("new_bytes")).alias("new_gb"), c.gibibytes(F.col("dup_bytes")).alias("dup_gb"),
        F.coalesce(c.percent(F.coalesce("dup_bytes", F.lit(0)), F.col("total_bytes"), 1), F.lit(0.0)).alias("dedup_pct"),
        F.sum("new_blobs").over(running).alias("cumulative_blobs"), c.gibibytes(F.sum("new_bytes").over(running)).alias("cumulative_gb"),
    )


def incremental_paths(path: DataFrame, order: DataFrame) -> DataFrame:
    """New and duplicate path strings of each medium of ``order`` (medium_hash, seq), such as ``incremental`` gives; one aggregation per path."""
    own = path.where("exclude_reason is null").select("medium_hash", "path").join(order.select("medium_hash", "seq"), "medium_hash")
    on = own.groupBy("path").agg(F.collect_set("seq").alias("on"))
    each = on.select(F.array_min("on").alias("first"), F.explode("on").alias("seq"))
    new = F.col("seq") == F.col("first")
    return each.groupBy("seq").agg(F.count_if(new).alias("new_paths"), F.count_if(~new).alias("dup_paths"))


def sharing_pairs(matrix: DataFrame, media: DataFrame | None = None) -> DataFrame:
    """(a, b, shared_blobs, shared_bytes) for a < b; with ``media`` also the pairs that share nothing.

    The self-join runs on distinct (blob, media set) signatures, of which there
    are far fewer than blobs, so a blob on many media is expanded once a signature.
    """
    sets = matrix.groupBy("blobid", "size").agg(F.array_sort(F.collect_set("medium_hash")).alias("on"))
    signature = sets.where(F.size("on") > 1).groupBy("on").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    left = signature.select(F.posexplode("on").alias("i", "a"), "on", "n", "bytes")
    pairs = left.select("a", F.explode(F.slice("on", F.col("i") + 2, F.size("on"))).alias("b"), "n", "bytes")
    shared = pairs.groupBy("a", "b").agg(F.sum("n").alias("shared_blobs"), F.sum("bytes").alias("shared_bytes"))
    if media is None:
        return shared
    every = media.select(F.col("medium_hash").alias("a")).join(media.select(F.col("medium_hash").alias("b")), F.col("a") < F.col("b"))
    zero = F.lit(0).cast("long")
    return every.join(shared, ["a", "b"], "left").select("a", "b", F.coalesce("shared_blobs", zero).alias("shared_blobs"), F.coalesce("shared_bytes", zero).alias("shared_bytes"))


def totals(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("medium_hash").agg(F.count("*").alias("blobs"), F.sum("size").alias("bytes"))


def similarity(matrix: DataFrame) -> DataFrame:
    """Jaccard and both containments of the media pairs that share a blob."""
    n = totals(matrix).select("medium_hash", "blobs")
    pairs = sharing_pairs(matrix).join(n.select(F.col("medium_hash").alias("a"), F.col("blobs").alias("na")), "a").join(n.select(F.col("medium_hash").alias("b"), F.col("blobs").alias("nb")), "b")
    union = F.col("na") + F.col("nb") - F.col("shared_blobs")
    return pairs.select("a", "b", "shared_blobs", F.round(c.ratio(F.col("shared_blobs"), union), 4).alias("jaccard"), F.round(F.col("shared_bytes").cast("double") / 1e9, 6).alias("shared_gb"), c.percent(F.col("shared_blobs"), F.col("na")).alias("pct_of_a"), c.percent(F.col("shared_blobs"), F.col("nb")).alias("pct_of_b"))


def patterns(matrix: DataFrame) -> DataFrame:
    """Exclusive intersections: blobs by the exact set of media that hold them."""
    sets = matrix.groupBy("blobid").agg(F.array_join(F.array_sort(F.collect_set("medium_hash")), "+").alias("pattern"), F.count_distinct("medium_hash").alias("n_media"))
    return sets.groupBy("pattern", "n_media").agg(F.count("*").alias("n_blobs"))


def indicator(matrix: DataFrame, media: list[str]) -> DataFrame:
    """One row a blob and a column (0 or 1) for each of ``media``."""
    return matrix.groupBy("blobid").pivot("medium_hash", media).agg(F.max(F.lit(1))).na.fill(0)


def overlapping(sets: DataFrame, column: str) -> DataFrame:
    """(column, others) of distinct sets that share an element, themselves included: an equi join over the elements, never all pairs compared."""
    index = sets.select(F.col(column), F.explode(column).alias("element"))
    other = index.select(F.col(column).alias("others"), "element")
    return index.join(other, "element").select(column, "others").distinct()
