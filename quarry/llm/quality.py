"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the text.  A class
covariance is shrunk twice, towards the pooled one and towards a sphere
(``to_pooled``, ``to_sphere``), so that it stays positive definite with few
labels; the inverse of its Cholesky factor is solved for once and kept in the
model, and a score is the sigmoid of the difference of the two log densities, each
from one product with that triangle.

Defined results: a null or empty text has the statistics of zero words and is
scored like any other; repeated rows are scored each; an empty table gives an
empty result; a null ``doc_id`` is scored, and never used for learning.
Labels that are null, or that contradict each other for one document, teach
nothing.  Without labels of both classes every score is the share of the class
that there is (0.5 without any).  Other columns of the input are carried along
or ignored, whatever their names (one called like the score is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import arrow

NAMES = ("words", "word_length", "distinct", "repeated", "symbols", "symbol_words", "digits", "upper", "high", "stops", "line_words", "lines_repeated")
THRESHOLD = 0.3

_byte = np.arange(256)
_alpha = ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122))
_stop = np.isin(_byte, list(b".,;:!?'\"-()"))
_digit = (_byte >= 48) & (_byte <= 57)
#: byte class sums: letters, digits, upper case, non-ASCII, stops, other symbols
_KINDS = np.stack([_alpha, _digit, (_byte >= 65) & (_byte <= 90), _byte >= 128, _stop, (_byte < 128) & ~_alpha & ~_digit & ~_stop & ~_text.SPACE], 1).astype(np.float64)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text (see NAMES)."""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(NAMES)
    letters, digits, upper, high, stops, symbols = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS
    size = letters + digits + high + stops + symbols
    lines = text.split(b"\n")
    share = lambda k, of: np.sqrt(k / of)  # noqa: E731  variance-stabilising for proportions
    return [
        np.log1p(n), np.log(size / n), len(set(words)) / n, share(sum(map(eq, words, islice(words, 1, None))), n), share(symbols, size),
        share(sum(1 for w in words if len(w) == 1 and not w.isalnum()), n), share(digits, size), share(upper, size), share(high, size), share(stops, size),
        np.log(n / len(lines)), 1 - len(set(lines)) / len(lines),
    ]


@dataclass(frozen=True)
class Model:
    prior: float
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None = None  # class, statistic
    factors: np.ndarray | None = None  # class, inverse of the Cholesky factor
    half_log_det: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        if self.means is None or len(x) == 0:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        density = []
        for k in (0, 1):
            solved = (z - self.means[k]) @ self.factors[k].T
            density.append(-0.5 * (solved**2).sum(1) - self.half_log_det[k])
        logit = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _inverse(lower: np.ndarray) -> np.ndarray:
    """The inverse of a lower triangle, row by row."""
    out = np.zeros_like(lower)
    for i in range(len(lower)):
        out[i] = -lower[i, :i] @ out[:i]
        out[i, i] = 1
        out[i] /= lower[i, i]
    return out


def learn(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float = 0.5, to_sphere: float = 0.05) -> Model:
    """From each class's count, sum and sum of outer products."""
    d = len(NAMES)
    n = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
    total = n[0] + n[1]
    prior = n[1] / total if total else 0.5
    if min(n.values()) < 2:
        return Model(prior, np.zeros(d), np.ones(d))
    means = {k: sums[k][1] / n[k] for k in n}
    own = {k: sums[k][2] / n[k] - np.outer(means[k], means[k]) for k in n}
    pooled = sum(own[k] * n[k] for k in n) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    centre = sum(means[k] * n[k] for k in n) / total
    factors, half = [], []
    for k in (0, 1):
        cov = ((1 - to_pooled) * own[k] + to_pooled * pooled) / np.outer(scale, scale)
        cov = (1 - to_sphere) * cov + to_sphere * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        factors.append(_inverse(factor))
        half.append(np.log(np.diag(factor)).sum())
    return Model(prior, centre, scale, np.stack([(means[k] - centre) / scale for k in (0, 1)]), np.stack(factors), np.array(half))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) of every document, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            flat = pa.array(np.array([statistics(t) for t in _text.texts(b.column(1))], np.float64).ravel())
            offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["id", "stats"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow(source, run, f"id {source.schema['id'].dataType.simpleString()}, stats array<double>")


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id", folds: int = 5, held_fold: int = 0, **shrinkage: float) -> Model:
    """Sums of the labelled statistics, outside the held-out fold, reduced to one small row per class and cell."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").select("id", "label")
    # a shuffle join of small rows, so that the Python workers of the two sides of it never stand in one task
    rows = measured.where(F.crc32(F.col("id").cast("string")) % folds != held_fold).join(known.hint("merge"), "id").select("label", "stats")
    d = len(NAMES)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            if b.num_rows:
                y = b.column(0).to_numpy()
                x = b.column(1).flatten().to_numpy().reshape(-1, d)
                for k in (0, 1):
                    own = x[y == k]
                    total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        for k in (0, 1):
            if total[k, 0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(total.shape[1], k, np.int32)), pa.array(np.arange(total.shape[1], dtype=np.int32)), pa.array(total[k])], names=["label", "cell", "value"])

    summed = arrow(rows, cells, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value")).collect()
    sums: dict[int, np.ndarray] = {}
    for label, cell, value in summed:
        sums.setdefault(label, np.zeros(1 + d + d * d))[cell] = value
    return learn({k: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for k, v in sums.items()}, **shrinkage)


def score_measured(measured: DataFrame, model: Model) -> DataFrame:
    """(id, score) of measured documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["id", "score"])

    return arrow(measured, run, f"id {measured.schema['id'].dataType.simpleString()}, score double")


def annotate(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Every column of ``docs`` and the score, in one pass without a shuffle."""
    columns = [c for c in docs.columns if c != score_col]
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            x = np.array([statistics(t) for t in _text.texts(b.column(1))], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["r", "s"])

    done = arrow(rows, run, rows.select("r", F.lit(0.0).alias("s")).schema)
    return done.select(*(F.col(f"r.`{c}`") for c in columns), F.col("s").alias(score_col))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    return fit(measure(docs), labels)
