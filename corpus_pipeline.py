"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

``run`` applies STAGES to the documents of ``sf_dir``; each stage's rows are
written as Parquet in the shared folder and read back as the next one's input,
so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, line_dedup, minhash_dedup, packing, quality
from quarry.llm._scratch import Scratch
from quarry.llm._text import free_name

#: near-duplicate groups, decontamination and classification have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant gives class 1 with 0.3 at least; null and empty texts are scored like any other."""
    model = quality.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name("__quality", docs.columns)
    return quality.annotate(docs, model, score_col=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; one that is nothing but boilerplate keeps its text for the next stage.

    A null text stays null, a null source is a source of its own, ``n_chars`` follows the text.
    """
    own = free_name("__lines", docs.columns)
    done = line_dedup.line_dedup(docs, F.col("source"), F.col("text"), out_col=own)
    clean = F.when(F.trim(F.translate(f"{own}.clean", "\n", "")) == "", F.col("text")).otherwise(F.col(f"{own}.clean"))
    done = done.withColumn("text", F.when(F.col(f"{own}.n_dropped") > 0, clean).otherwise(F.col("text"))).drop(own)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group at a similarity of 0.8 over five-word shingles: of least id, then of least hash of the text; of equal rows, one.

    Texts without a word are in no group and stay.
    """
    return minhash_dedup.unique(docs, shingle=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; a null text has none."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their text, its byte offsets, bucket and batch; a null text is one empty piece."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
