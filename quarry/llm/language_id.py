"""Language identification: nearest of several centroids per language.

A text becomes the TF-IDF vector, of length one, of its hashed letter bigrams
and trigrams.  Document frequencies come from all learning documents; the
centroids of a language come from spherical k-means over a sample of its
learning documents (``per_language`` of them about, chosen by a hash of id and text,
a documented bound on what one task holds; the driver gets the centroids).  A text takes the language of the
centroid of largest cosine.  A text further from it than all but ``reject_share``
of that centroid's own members is ``rejected``.

Defined results: a null text, or one without letters (characters of Unicode
category L; \u00b2, \u00bd and \u2167 are none), is ``und`` with score 0
and rejected; without anything to learn from every text is; repeated rows are
each answered; an empty table gives an empty result; rows with a null ``lang``
or id teach nothing.  Equal cosines go to the language first in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

MOST_BROADCAST = 100_000

_MAYBE = re.compile(r"[^\W\d_]")
#: other bytes than letters (ASCII) become a space
_LETTERS = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether a character of Unicode category L is in the text (numbers such as \u00b2, \u00bd or \u2167 are none)."""
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


def codes(text: str, dims: int) -> np.ndarray:
    """Hashed n-grams (n = 2, 3) of the lower-cased letters with word edges."""
    b = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    a = np.frombuffer(b, np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(256) + a[1:]
    three = two[:-1] * np.uint32(256) + a[2:]
    both = np.concatenate([two + np.uint32(1 << 24), three])
    return (both * np.uint32(2654435761)) >> np.uint32(32 - int(dims).bit_length() + 1)


def vectors(texts: list[str], dims: int, idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), dims), np.float32)
    for i, t in enumerate(texts):
        n = np.bincount(codes(t, dims), minlength=dims)
        at = np.flatnonzero(n)
        v = (1 + np.log(n[at])) * idf[at]
        out[i, at] = v / max(np.sqrt((v * v).sum()), 1e-12)
    return out


@dataclass(frozen=True)
class Model:
    dims: int
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # (centroid, dims)
    owner: np.ndarray  # index of the centroid's language
    radius: np.ndarray  # least cosine that is not rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        langs, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        some = [i for i, t in enumerate(texts) if t and has_letter(t)] if len(self.centroids) else []
        for k in range(0, len(some), 128):
            part = some[k : k + 128]
            cos = vectors([texts[i] for i in part], self.dims, self.idf) @ self.centroids.T
            best = cos.argmax(1)
            for i, c, s in zip(part, best, cos.max(1)):
                langs[i], score[i], rejected[i] = self.languages[self.owner[c]], min(1.0, max(0.0, float(s))), s < self.radius[c]
        return langs, score, rejected


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from seeds far apart; (centroids, member's centroid)."""
    seeds = [int((x @ x.sum(0)).argmax())]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds].copy()
    own = np.zeros(len(x), int)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (own == j).any():
                s = x[own == j].sum(0)
                c[j] = s / max(np.linalg.norm(s), 1e-12)
    return c, own


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held_fold: int = 0, dims: int = 16384, per_language: int = 400, k: int = 4, reject_share: float = 0.005) -> Model:
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((F.crc32("id") % folds != held_fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if has_letter(t):
                    total[np.unique(codes(t, dims))] += 1
                    n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int32)), pa.array(np.append(total, n))], names=["dim", "n"])

    found = arrow(rows.select("text"), frequencies, "dim int, n bigint").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(dims + 1)
    for dim, n in found:
        df[dim] = n
    idf = np.log((1 + df[dims]) / (1 + df[:dims])) + 1
    # a sample of about per_language documents each, by the hash of the id
    counts = Scratch(docs.sparkSession, "language").keep(rows.groupBy("lang").agg(F.count("*").alias("n")), "counts")
    if counts.count() <= MOST_BROADCAST:  # a row a language; the texts are not shuffled then
        counts = F.broadcast(counts)
    share = F.least(F.lit(1.0), F.lit(per_language) / F.col("n")) * 2.0**32
    # by row, so that rows of one id are not all in or all out
    h = F.crc32(F.concat(F.lit("sample"), F.col("id"), F.lit(":"), F.xxhash64("text").cast("string")))
    picked = rows.join(counts, "lang").where(h < share).select("lang", "text", h.alias("h"))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, dim, val, order = [], [], [], []
            for lang, t, h in zip(*(b.column(i).to_pylist() for i in range(3))):
                if has_letter(t):
                    v = vectors([t], dims, idf)[0]
                    at = np.flatnonzero(v)
                    langs.append(lang), dim.append(at.astype(np.int32).tobytes()), val.append(v[at].tobytes()), order.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(dim, pa.binary()), pa.array(val, pa.binary()), pa.array(order, pa.int64())], names=["lang", "dim", "val", "h"])

    def clustered(group: pd.DataFrame) -> pd.DataFrame:
        own = sorted(zip(map(bytes, group["dim"]), map(bytes, group["val"])))
        x = np.zeros((len(own), dims), np.float32)
        for j, (dim, val) in enumerate(own):
            x[j, np.frombuffer(dim, np.int32)] = np.frombuffer(val, np.float32)
        c, at = cluster(x, k)
        cos = (x * c[at]).sum(1)
        used = [j for j in range(len(c)) if (at == j).any()]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "j": used, "centroid": [c[j].astype(np.float32).tobytes() for j in used], "radius": [float(np.quantile(cos[at == j], reject_share)) for j in used]})

    # each language's sample is one small group; only the centroids reach the driver
    vectors_of = arrow(picked, sparse, "lang string, dim binary, val binary, h bigint")
    # equal rows still are: twice the sample at most, whatever repeats
    first = F.row_number().over(W.partitionBy("lang").orderBy("h", "dim", "val"))
    found = vectors_of.withColumn("n", first).where(F.col("n") <= 2 * per_language).drop("n", "h").groupBy("lang").applyInPandas(clustered, "lang string, j int, centroid binary, radius double").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["j"]))
    languages = sorted({r["lang"] for r in found})
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in found], np.float32).reshape(-1, dims)
    return Model(dims, idf, languages, centroids, np.array([languages.index(r["lang"]) for r in found], int), np.array([r["radius"] for r in found]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row, without a shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            langs, score, rejected = model.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return arrow(source, run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
