"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word (a run of letters; A-Z lower-cased) has up to seven features, itself and its
first 3 to 8 bytes, so that inflected forms share what their stems have.  A feature
is hashed to two of 2^BUCKETS buckets of embeddings; a word's vector is the sum over
its features of both, if both are in use.  Filters of several widths slide over the
words (narrow ones with a weight for each place, wide ones with one weight for all
places, which respond to how densely words stand); each filter's largest response in
the whole text is kept (max pooling, with empty words before and after the text) and
one linear layer gives the log odds.

Learning takes a bounded sample of labelled rows (``sample``, by a hash of the id; rows
of over ``most_bytes`` bytes do not teach).  Buckets come into use for features
whose link with the label is beyond chance among all features tested
(likelihood-ratio test, threshold 2 log of their number) and start from their log odds;
then embeddings, filters and weights are trained together by Adam.  On a part of
the sample that training has not seen a threshold is calibrated for each language; a
score is shifted so that it is ``THRESHOLD`` there.  The language of a text is
guessed from its own commonest words, so that a score depends on the text alone.

Only the used buckets and the filters are broadcast.  A text is scored where it
lies, in one pass: as words without a used bucket are zero vectors, filters are
applied around the others only, which gives the same maxima.

Defined results: a null or empty text is scored like any text without words; repeated rows are scored
each; an empty table gives an empty result; a null id is scored, and never used for
learning; null or contradicting labels teach nothing.  Without labels of both classes
every score is the share of the class that there is (0.5 without any).  Other
columns are carried along (``annotate``), whatever their names; one called like the
score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

THRESHOLD, BUCKETS, DIMS, WIDTHS, WIDE, FILTERS = 0.3, 20, 8, (1, 2, 3), (24, 96), 4
SAMPLE, MOST_BYTES, LEAST_TOXIC = 8192, 1 << 16, 3
PREFIXES = range(3, 9)  # bytes
FEATURES = 1 + len(PREFIXES)

#: frequent words by language (fixed values); a text's language is the one with most of them
COMMON = {
    "de": "der die das und ist nicht den mit von zu auf ein",
    "en": "the and of to in that is was for with this are",
    "es": "el los las del y una por con para que su de",
    "fr": "le les des et une est dans pour du au pas il",
    "it": "il gli che di della per non sono nel alla con lo",
    "nl": "het een van en dat niet op zijn met voor aan er",
    "pt": "os as do da dos em um uma para com por nao",
}
LANGUAGES = sorted(COMMON)

_letters = np.full(256, 32, np.uint8)
_letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = [*range(65, 91), *range(97, 123), *range(128, 256)]


def features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """(word, feature) hashes; 0 where a word is too short to have that prefix."""
    out = np.zeros((len(starts), FEATURES), np.uint64)
    out[:, 0] = whole
    total, n = np.zeros(len(starts), np.uint64), ends - starts
    for k in range(PREFIXES[-1]):
        has = np.flatnonzero(n > k)
        total[has] += _text._AT_PLACE[k * 256 + raw[starts[has] + k].astype(np.int64)]
        if k + 1 in PREFIXES:
            longer = np.flatnonzero(n > k + 1)
            out[longer, PREFIXES.index(k + 1) + 1] = _text.mix(total[longer] + np.uint64(k + 1) * _text.BASE) | np.uint64(1)
    return out


def buckets(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two buckets of each feature."""
    shift = np.uint64(64 - BUCKETS)
    return (hashes >> shift).astype(np.int64), (_text.mix(hashes * _text.MULT) >> shift).astype(np.int64)


@dataclass
class Batch:
    """The words of a buffer of texts: the distinct ones with their features, and where each stands."""

    n: int
    row: np.ndarray  # text of each word
    word: np.ndarray  # number of the distinct word
    hashes: np.ndarray  # (distinct word, feature)

    @classmethod
    def of(cls, raw: np.ndarray, off: np.ndarray) -> Batch:
        raw = _letters[raw]
        starts, ends = _text.word_spans(raw, off)
        whole = _text.word_hashes(raw, starts, ends) | np.uint64(1)
        distinct, first, word = np.unique(whole, return_index=True, return_inverse=True)
        return cls(len(off) - 1, np.searchsorted(off, starts, "right") - 1, word.astype(np.int64), features(raw, starts[first], ends[first], distinct))

    def languages(self) -> np.ndarray:
        """Index in LANGUAGES of each text, -1 without any of their words."""
        hashes, owner = _common()
        at = np.minimum(np.searchsorted(hashes, self.hashes[:, 0]), len(hashes) - 1)
        known = np.where(hashes[at] == self.hashes[:, 0], at, -1)[self.word]
        counts = np.zeros((self.n, len(LANGUAGES)))
        some = np.flatnonzero(known >= 0)
        np.add.at(counts, self.row[some], owner[known[some]])
        return np.where(counts.max(1) > 0, counts.argmax(1), -1) if self.n else np.zeros(0, np.int64)


_common_words: list[tuple[np.ndarray, np.ndarray]] = []


def _common() -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes of the frequent words, word x language 0/1)."""
    if not _common_words:
        words = sorted({w for own in COMMON.values() for w in own.split()})
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        hashes = _text.word_hashes(raw, *_text.word_spans(raw, np.array([0, len(raw)]))) | np.uint64(1)
        owner = np.array([[w in COMMON[x].split() for x in LANGUAGES] for w in words], float)
        order = np.argsort(hashes)
        _common_words.append((hashes[order], owner[order]))
    return _common_words[0]


def windows(row: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, slots) of every stretch of ``width`` places that holds a used word.

    ``row``, ``place``: of the used words, sorted; a slot is the number of a used word plus 1, or 0.
    """
    span = int(place.max(initial=0)) + 2 * width + 1
    key = row * span + place + width
    starts = np.unique((key[:, None] - np.arange(width)).ravel())
    each = starts[:, None] + np.arange(width)
    at = np.minimum(np.searchsorted(key, each), max(0, len(key) - 1))
    return starts // span, np.where(key[at] == each, at + 1, 0) if len(key) else np.zeros((0, width), np.int64)


def stretches(row: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, end) of the stretches of ``width`` places that differ in the used words they hold: those from ``first`` to ``end``."""
    span = int(place.max(initial=0)) + 2 * width + 2
    key = row * span + place + width
    starts = np.unique(np.r_[key - width + 1, key + 1])
    first, end = np.searchsorted(key, starts), np.searchsorted(key, starts + width)
    some = end > first
    return (starts // span)[some], first[some], end[some]


def narrow(vectors: np.ndarray, slots: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """(window, filter) responses, a weight for each place."""
    return np.einsum("nwd,wdf->nf", vectors[slots], filters)


def wide(vectors: np.ndarray, first: np.ndarray, end: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """(window, filter) responses, one weight for all places; ``vectors`` begins with the zero vector."""
    summed = np.cumsum(vectors @ filters, 0)
    return summed[end] - summed[first]


@dataclass
class Model:
    prior: float
    used: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted buckets
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, DIMS)))  # embedding of each, after a row of zeros
    filters: list[np.ndarray] = field(default_factory=list)  # for each width: (place, dim, filter), for each wide one: (dim, filter)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    offset: float = 0.0
    cut: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))  # log odds at the threshold: by language, then of all

    def __post_init__(self) -> None:
        self.place = np.zeros(1 << BUCKETS, np.int32)
        self.place[self.used] = np.arange(1, len(self.used) + 1)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "place"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """(word, 2 * feature) rows of the table, 0 where one of a feature's buckets is not in use."""
        one, two = (self.place[b] for b in buckets(hashes))
        both = (one > 0) & (two > 0) & (hashes > 0)
        return np.concatenate([np.where(both, one, 0), np.where(both, two, 0)], 1)

    def used_words(self, batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place among its words, rows) of the words with a used bucket."""
        rows = self.rows(batch.hashes)
        at = np.flatnonzero((rows > 0).any(1)[batch.word])
        first = np.searchsorted(batch.row, np.arange(batch.n))
        return batch.row[at], at - first[batch.row[at]], rows[batch.word[at]]

    def log_odds(self, n: int, row: np.ndarray, place: np.ndarray, rows: np.ndarray) -> np.ndarray:
        vectors = np.concatenate([np.zeros((1, DIMS)), self.table[rows].sum(1)])
        out = np.full(n, self.offset)
        for k, width in enumerate(WIDTHS + WIDE):
            pooled = np.tile(np.maximum(self.bias[k], 0), (n, 1))
            if k < len(WIDTHS):
                text, slots = windows(row, place, width)
                response = narrow(vectors, slots, self.filters[k]) + self.bias[k]
            else:
                text, first, end = stretches(row, place, width)
                response = wide(vectors, first, end, self.filters[k]) + self.bias[k]
            if len(text):
                edge = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                pooled[text[edge]] = np.maximum(pooled[text[edge]], np.maximum.reduceat(response, edge))
            out += pooled @ self.weights[k * FILTERS : (k + 1) * FILTERS]
        return out

    def score(self, batch: Batch) -> np.ndarray:
        """Probability of class 1 for each text."""
        if not self.filters:
            return np.full(batch.n, self.prior)
        logit = self.log_odds(batch.n, *self.used_words(batch)) - self.cut[batch.languages()]
        return 1 / (1 + np.exp(-np.clip(logit + np.log(THRESHOLD / (1 - THRESHOLD)), -60, 60)))


def train(label: np.ndarray, row: np.ndarray, place: np.ndarray, rows: np.ndarray, model: Model, start: np.ndarray, steps: int = 300, rate: float = 0.02, decay: float = 1e-3, seed: int = 7) -> Model:
    """Adam over all embeddings, filters and weights; ``start``: log odds of the used buckets, the first dimension."""
    r = np.random.default_rng(seed)
    words, word = np.unique(rows, axis=0, return_inverse=True)
    word = np.r_[0, word.ravel() + 1]  # slot 0: no word
    placed = [windows(row, place, w) for w in WIDTHS] + [stretches(row, place, w) for w in WIDE]
    edges = [np.flatnonzero(np.r_[True, p[0][1:] != p[0][:-1]]) if len(p[0]) else np.zeros(0, np.int64) for p in placed]
    n, y = len(label), label.astype(float)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))  # both classes weigh the same
    table = r.normal(0, 0.1, (len(start) + 1, DIMS))
    table[1:, 0] = start / 4
    parts = [table, np.zeros(1), np.full(len(placed) * FILTERS, 0.5)]
    for shape in [(w, DIMS, FILTERS) for w in WIDTHS] + [(DIMS, FILTERS)] * len(WIDE):
        own = r.normal(0, 0.2, shape)
        own[..., 0, :] = np.abs(own[..., 0, :]) + 0.3
        parts += [own, np.full(FILTERS, -0.2)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        table, offset, weights = parts[:3]
        table[0] = 0
        vectors = np.concatenate([np.zeros((1, DIMS)), table[words].sum(1)])[word]
        keep = r.random((len(vectors), 1)) < 0.8  # words are dropped at random
        vectors = vectors * keep
        logit, pooled, chosen = np.full(n, offset[0]), [], []
        for k, (text, *words_of) in enumerate(placed):
            filters, bias = parts[3 + 2 * k : 5 + 2 * k]
            response = (narrow if k < len(WIDTHS) else wide)(vectors, *words_of, filters) + bias
            best = np.tile(bias, (n, 1))
            which = np.full((n, FILTERS), -1)
            if len(text):
                top = np.maximum.reduceat(response, edges[k])
                size = np.diff(np.r_[edges[k], len(text)])
                at = np.where(response == np.repeat(top, size, 0), np.arange(len(text))[:, None], len(text))
                owner = text[edges[k]]
                above = top > best[owner]
                which[owner] = np.where(above, np.minimum.reduceat(at, edges[k]), -1)
                best[owner] = np.maximum(best[owner], top)
            pooled.append(np.maximum(best, 0)), chosen.append(which)
            logit += pooled[-1] @ weights[k * FILTERS : (k + 1) * FILTERS]
        error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * share
        grads = [np.zeros_like(p) for p in parts]
        grads[1][0] = error.sum()
        d_vectors = np.zeros_like(vectors)
        for k, (_, *words_of) in enumerate(placed):
            filters = parts[3 + 2 * k]
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            grads[2][own] = error @ pooled[k]
            back = error[:, None] * weights[own] * (pooled[k] > 0)
            grads[4 + 2 * k] += back.sum(0)
            doc, f = np.nonzero(chosen[k] >= 0)
            at, g = chosen[k][doc, f], back[doc, f]
            if k >= len(WIDTHS):
                first_word, end_word = (w[at] for w in words_of)
                summed = np.cumsum(vectors, 0)
                np.add.at(grads[3 + 2 * k].T, f, g[:, None] * (summed[end_word] - summed[first_word]))
                step_of = np.zeros((len(vectors) + 1, DIMS))  # slots first + 1 to end
                np.add.at(step_of, first_word + 1, g[:, None] * filters.T[f])
                np.add.at(step_of, end_word + 1, -g[:, None] * filters.T[f])
                d_vectors += np.cumsum(step_of, 0)[:-1]
                continue
            slot = words_of[0][at]
            np.add.at(grads[3 + 2 * k].transpose(2, 0, 1), f, g[:, None, None] * vectors[slot])
            np.add.at(d_vectors, slot, g[:, None, None] * filters.transpose(2, 0, 1)[f])
        d_words = np.zeros((len(words) + 1, DIMS))
        np.add.at(d_words, word, d_vectors * keep)
        np.add.at(grads[0], words, d_words[1:, None, :])
        for p, g, m, v in zip(parts, grads, first, second):
            g += decay * p / len(p)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    parts[0][0] = 0
    return Model(model.prior, model.used, parts[0], parts[3::2], parts[4::2], parts[2], float(parts[1][0]))


def best_cut(logit: np.ndarray, label: np.ndarray) -> float:
    """The middle of the gap whose cut has the largest F1."""
    order = np.argsort(-logit, kind="stable")
    x, hit = logit[order], np.cumsum(label[order])
    last = np.flatnonzero(np.r_[x[1:] != x[:-1], True])  # a cut after each distinct value
    f1 = 2 * hit[last] / (last + 1 + label.sum())
    k = last[int(f1.argmax())]
    return float((x[k] + x[k + 1]) / 2 if k + 1 < len(x) else x[k] - 1)


def calibrate(model: Model, logit: np.ndarray, label: np.ndarray, language: np.ndarray, least: int = 8) -> Model:
    """A cut for each language with ``least`` rows of both classes, and one over all rows for the others."""
    cut = np.zeros(len(LANGUAGES) + 1)
    if min(label.sum(), (1 - label).sum()) > 0:
        cut[:] = best_cut(logit, label)
    for k in range(len(LANGUAGES)):
        own = language == k
        if min(label[own].sum(), (1 - label[own]).sum()) >= least:
            cut[k] = best_cut(logit[own], label[own])
    model.cut = cut
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", label_id: str = "doc_id", folds: int = 4, held_fold: int = 2, sample: int = SAMPLE, most_bytes: int = MOST_BYTES) -> Model:
    """Two passes over the texts of at most ``sample`` labelled rows outside the held-out fold."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.select(F.col(label_id).cast("string").alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").where(F.crc32("id") % folds != held_fold)
    known = scratch.keep(known.select("id", "label", F.crc32(F.concat(F.lit("sample"), "id")).alias("h")), "labels")
    n = known.count()
    # twice the share by hash, so that the sort below gets few rows
    taken = known.where(F.col("h") < F.lit(2.0**33 * sample / max(1, n))).orderBy("h", "id").limit(sample)
    taken = F.broadcast(taken)  # ``sample`` ids at most
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where(F.octet_length("text") <= most_bytes)
    rows = rows.join(taken, "id").select("text", "label", (F.crc32(F.concat(F.lit("calibrate"), "id")) % 10 < 3).alias("apart"))
    rows = scratch.keep(rows.repartition(16), "sample")
    size = {(r.label, r.apart): r.n for r in rows.groupBy("label", "apart").agg(F.count("*").alias("n")).collect()}
    toxic, clean = (size.get((k, False), 0) for k in (1, 0))
    total = sum(size.values())
    prior = sum(v for (k, _), v in size.items() if k) / total if total else 0.5
    empty = Model(prior)
    if min(toxic, clean) < 2:
        return empty

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            batch = Batch.of(*_text.buffers(b.column(0)))
            distinct = np.unique(batch.row * len(batch.hashes) + batch.word)
            row, word = np.divmod(distinct, max(1, len(batch.hashes)))
            kinds, at = np.unique(batch.hashes, return_inverse=True)
            both = np.unique((np.repeat(row, FEATURES) * len(kinds) + at.reshape(-1, FEATURES)[word].ravel()))
            row, kind = np.divmod(both, max(1, len(kinds)))
            label = b.column(1).to_numpy()[row]
            counts = [np.bincount(kind[label == k], minlength=len(kinds)) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), *(pa.array(c.astype(np.int32)) for c in counts)], names=["feature", "toxic", "clean"])

    counted = arrow(rows.where("not apart").select("text", "label"), count, "feature bigint, toxic int, clean int").where("feature <> 0")
    counted = counted.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") >= LEAST_TOXIC)
    tested = scratch.keep(counted, "tested")
    chance = 2 * np.log(max(2, tested.count()))
    found = tested.where((F.col("t") / toxic > F.col("c") / clean) & (_likelihood_ratio(F.col("t"), F.col("c"), toxic, clean) >= chance)).toPandas().sort_values("feature")
    if found.empty:
        return empty
    odds = (np.log((found.t + 0.5) / (toxic + 1)) - np.log((found.c + 0.5) / (clean + 1))).to_numpy()
    one, two = buckets(found.feature.to_numpy().view(np.uint64))
    used = np.unique(np.r_[one, two])
    start = np.full(len(used), -np.inf)
    np.maximum.at(start, np.searchsorted(used, np.r_[one, two]), np.r_[odds, odds])
    model = Model(prior, used)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            batch = Batch.of(*_text.buffers(b.column(0)))
            row, place, words = model.used_words(batch)
            offsets = np.searchsorted(row, np.arange(batch.n + 1))
            lists = [pa.ListArray.from_arrays(pa.array((offsets * k).astype(np.int32)), pa.array(x.astype(np.int32).ravel())) for k, x in ((1, place), (2 * FEATURES, words))]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(batch.languages().astype(np.int32)), *lists], names=["label", "apart", "language", "place", "rows"])

    seen = arrow(rows, find, "label int, apart boolean, language int, place array<int>, rows array<int>").toArrow().combine_chunks()
    apart, label, language = (seen.column(c).to_numpy() for c in ("apart", "label", "language"))

    def part(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = seen.filter(pa.array(which))
        n_words = pa.compute.list_value_length(own.column("place")).to_numpy()
        flat = lambda c: pa.compute.list_flatten(own.column(c)).to_numpy().astype(np.int64)
        return np.repeat(np.arange(len(n_words)), n_words), flat("place"), flat("rows").reshape(-1, 2 * FEATURES)

    apart = apart.astype(bool)
    model = train(label[~apart], *part(~apart), model, start)
    logit = model.log_odds(int(apart.sum()), *part(apart))
    return calibrate(model, logit, label[apart], language[apart])


def _likelihood_ratio(t: Column, c: Column, toxic: int, clean: int) -> Column:
    """The statistic of the fourfold table of a feature and the label."""
    total = toxic + clean
    cell = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    held, free = t + c, total - t - c
    return 2 * (cell(t, held * toxic / total) + cell(c, held * clean / total) + cell(toxic - t, free * toxic / total) + cell(clean - c, free * clean / total))


def annotate(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Every column of ``docs`` and the score, in one pass without a shuffle."""
    columns = [c for c in docs.columns if c != score_col]
    held = docs.sparkSession.sparkContext.broadcast(model)
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held.value.score(Batch.of(*_text.buffers(b.column(1)))))], names=["r", "s"])

    done = arrow(rows, run, rows.select("r", F.lit(0.0).alias("s")).schema)
    return done.select(*(F.col(f"r.`{c}`") for c in columns), F.col("s").alias(score_col))
