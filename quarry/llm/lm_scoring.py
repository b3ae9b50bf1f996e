"""Brown class-based bigram scoring with exchange clustering.

Tokens are the lower-cased (A-Z) words of a text and one end.  The model is

    P(w | v) = P(class(w) | class(v)) * P(item(w) | class(w)) * P(w | item(w))

An *item* is a word that the driver holds and that occurs ``least`` times (or is
among the ``items`` most frequent), the end, or one of ``groups`` spelling groups
that all rarer words fall into by their last bytes (seen or unseen, so a new word
has a class as well).  Exchange clustering moves one of the most frequent items or
groups after the other to the
class that raises the likelihood of the class bigrams most, until few move.
Then the exchange goes on with all further items at a time, ``rounds`` times: the
counts of classes to the left and right of each are summed by
shuffle, and it takes the class that makes them likeliest.
Class transitions are Witten-Bell smoothed, emissions of items additively, and
in a group absolute discounting leaves mass for unseen words, which as many as
the counts of counts suggest (Chao; at least an even share of the whole estimate)
share evenly.  So it is a distribution over all seen words, the end and that many
unseen words of each group; a corpus with more of them is given more than one.

Texts are cut into words for the counts, for the items of the learning texts,
which are written once and then read for each round, and for the scores.

Scale: counts of all words are summed per task and then shuffled; what the
driver holds is bounded by parameters (items^2 bigram cells, ``held`` frequent
words as 16 bytes each, which is also all that is sent to the workers).  Tokens
beyond those are joined with the counts table by shuffle, so the vocabulary may
grow with the corpus.

Frequent words are recognised by a 64-bit hash; the join compares whole words.

Defined results: null and empty texts are one end token; a null id is scored
with ``held_out`` false and teaches nothing; repeated rows and ids get a row
each; an empty table gives an empty result; without learning rows the counts are
0.  ``perplexity`` is 10 to the power of minus the score per token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

ITEMS, GROUPS, CLASSES, HELD, LEAST, ROUNDS = 2048, 1024, 64, 1 << 19, 10, 2
END = 0


def group_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, groups: int) -> np.ndarray:
    """Spelling group of each word: a hash of its last three bytes."""
    code = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        code = code * np.uint64(257) + np.where(at >= starts, LOWER64[raw[np.maximum(at, 0)]] + np.uint64(1), np.uint64(0))
    return (_text.mix(code) % np.uint64(groups)).astype(np.int64)


LOWER64 = _text.LOWER.astype(np.uint64)


@dataclass(frozen=True)
class Words:
    """The frequent words: sorted hashes, counts, and the item of each (-1: its group)."""

    hashes: np.ndarray
    counts: np.ndarray
    items: np.ndarray
    n_items: int  # with the end
    groups: int

    def tokens(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """(starts, ends, first word of each text, item, count or 0, known) of all words of a buffer."""
        starts, ends = _text.word_spans(raw, off)
        h = _text.word_hashes(raw, starts, ends)
        k, known = self.find(h)
        item = np.where(known, self.items[k], -1) if len(self.hashes) else np.full(len(h), -1)
        rest = item < 0
        item[rest] = self.n_items + group_of(raw, starts[rest], ends[rest], self.groups)
        return starts, ends, np.searchsorted(starts, off), item, np.where(known, self.counts[k], 0) if len(self.hashes) else np.zeros(len(h), np.int64), known

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the held words, whether it is there) of each hash: by its upper bits, which say where it can stand."""
        shift = np.uint64(64 - self.slots.bit_length() + 1)
        k = self.begins[(h >> shift).astype(np.int32)]
        k = np.minimum(k, max(len(self.hashes) - 1, 0))
        known = self.hashes[k] == h if len(self.hashes) else np.zeros(len(h), bool)
        left = np.flatnonzero(~known)
        for step in range(1, self.longest):
            at = np.minimum(k[left] + step, len(self.hashes) - 1)
            hit = self.hashes[at] == h[left]
            k[left[hit]], known[left[hit]] = at[hit], True
            left = left[~hit & (self.hashes[at] < h[left])]
        return k, known

    @cached_property
    def slots(self) -> int:
        return 1 << 20

    @cached_property
    def begins(self) -> np.ndarray:
        """The first held word of each slot."""
        upper = (self.hashes >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)
        return np.searchsorted(upper, np.arange(self.slots)).astype(np.int32)

    @cached_property
    def longest(self) -> int:
        """The most words of one slot."""
        return int(np.diff(np.append(self.begins, len(self.hashes))).max())

    def with_ends(self, item: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The items of all texts in a row, each text after an end, and one end at last."""
        return np.append(np.insert(item, first[:-1], END), END)


def exchange(n: int, left: np.ndarray, right: np.ndarray, count: np.ndarray, classes: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(class of each item, class bigram counts).  The end keeps class 0 for itself."""
    count = count.astype(np.float64)
    total = np.bincount(left, count, n) + np.bincount(right, count, n)
    cls = np.zeros(n, np.int64)
    order = np.argsort(-total, kind="stable")
    order = order[order != END]
    cls[order] = 1 + np.arange(len(order)) % (classes - 1)
    out_of = np.zeros((n, classes))
    into = np.zeros((n, classes))
    np.add.at(out_of, (left, cls[right]), count)
    np.add.at(into, (right, cls[left]), count)
    m = np.zeros((classes, classes))
    np.add.at(m, (cls[left], cls[right]), count)
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    l_first, r_first = np.searchsorted(left[by_left], np.arange(n + 1)), np.searchsorted(right[by_right], np.arange(n + 1))
    own = np.zeros(n)
    own[left[left == right]] = count[left == right]
    g = lambda x: x * np.log(np.maximum(x, 1e-300))
    diagonal = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for i in order:
            a, self_n = cls[i], own[i]
            r, s = out_of[i].copy(), into[i].copy()
            r[a] -= self_n
            s[a] -= self_n
            m[a] -= r
            m[:, a] -= s
            m[a, a] -= self_n
            rows, cols, gm = m.sum(1), m.sum(0), g(m)
            by_row = g(m + r[None, :]) - gm
            by_col = g(m.T + s[None, :]) - gm.T
            both = g(m[diagonal, diagonal] + r + s + self_n) - gm[diagonal, diagonal]
            gain = by_row.sum(1) - by_row[diagonal, diagonal] + by_col.sum(1) - by_col[diagonal, diagonal] + both
            gain -= g(rows + r.sum() + self_n) - g(rows) + g(cols + s.sum() + self_n) - g(cols)
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            m[b] += r
            m[:, b] += s
            m[b, b] += self_n
            if b != a:
                moved += 1
                cls[i] = b
                e = by_left[l_first[i] : l_first[i + 1]]
                into[right[e], a] -= count[e]
                into[right[e], b] += count[e]
                e = by_right[r_first[i] : r_first[i + 1]]
                out_of[left[e], a] -= count[e]
                out_of[left[e], b] += count[e]
        if moved < max(1, n // 200):
            break
    return cls, np.maximum(m, 0)


@dataclass(frozen=True)
class Model:
    words: Words
    cls: np.ndarray  # of each item
    step: np.ndarray  # log10 P(class | class before)
    emit: np.ndarray  # log10 P(item | class)
    discount: float
    group_n: np.ndarray  # tokens of each spelling group
    unseen: np.ndarray  # log10 of an unseen word's share of its group, times the group's tokens
    total: int  # N
    types: int  # V
    end_count: int

    @property
    def denominator(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.types + 1)))


def _rows(docs: DataFrame, id_col: str, text_col: str, folds: int, held_fold: int) -> DataFrame:
    fold = F.crc32(F.col(id_col).cast("string")) % folds
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"), F.coalesce(fold != held_fold, F.lit(False)).alias("teaches"))


def count_words(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """(word, n) over whole texts; the end is the empty word.  Tasks hold ``most`` words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen: Counter = Counter()
        for b in _text.slices(batches, "text", 1 << 20):
            for t in _text.texts(b.column(0)):
                seen.update(t.lower().split())
            seen[b""] += b.num_rows
            if len(seen) > most:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return arrow(rows.select("text"), run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Sums:
    """Counts of integer keys in a task: summed whenever ``some`` have come, handed on when ``most`` distinct ones are held."""

    def __init__(self, some: int = 1 << 20, most: int = 1 << 21):
        self.some, self.most = some, most
        self.new: list[np.ndarray] = []
        self.size = 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> bool:
        """Whether it is time to ``take`` them."""
        self.new.append(keys)
        self.size += len(keys)
        if self.size >= self.some:
            self._sum()
        return len(self.keys) >= self.most

    def _sum(self) -> None:
        fresh, k = np.unique(np.concatenate([*self.new, np.zeros(0, np.int64)]), return_counts=True)
        both = np.concatenate([self.keys, fresh])
        order = np.argsort(both, kind="stable")
        both, k = both[order], np.concatenate([self.counts, k])[order]
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
        self.keys, self.counts = both[first], np.add.reduceat(k, first) if len(first) else k
        self.new, self.size = [], 0

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self._sum()
        for k in range(0, len(self.keys), 1 << 16):
            yield self.keys[k : k + (1 << 16)], self.counts[k : k + (1 << 16)]
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)


def summed(lines: DataFrame, keys_of) -> DataFrame:
    """(key, k): how often ``keys_of`` yields each key over all lines of items."""
    return counted(lines, keys_of).groupBy("key").agg(F.sum("k").alias("k"))


def counted(lines: DataFrame, keys_of) -> DataFrame:
    """The same of each task by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums()
        rows = lambda: (pa.RecordBatch.from_arrays([pa.array(x), pa.array(k)], names=["key", "k"]) for x, k in held.take())
        for b in batches:
            for line in b.column(0):
                if held.add(keys_of(line.values.to_numpy())):
                    yield from rows()
        yield from rows()

    return arrow(lines, run, "key bigint, k bigint")


def fit(rows: DataFrame, scratch: Scratch, items: int = ITEMS, groups: int = GROUPS, classes: int = CLASSES, held: int = HELD, least: int = LEAST, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and the counts table of the words that it does not hold itself."""
    learning = rows.where("teaches")
    vocabulary = scratch.keep(count_words(learning), "words")
    totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.length("word") == 0, F.col("n"))), F.lit(0))).first()
    by_count = vocabulary.where(F.length("word") > 0).groupBy("n").agg(F.count("*").alias("types")).orderBy(F.desc("n"))

    def floor_of(most: int) -> int:
        """The least count such that at most ``most`` words reach it."""
        summed = 0
        for n, types in counts:
            summed += types
            if summed > most:
                return n + 1
        return 1

    counts = [(r[0], r[1]) for r in by_count.collect()]
    item_floor, held_floor = floor_of(items), floor_of(held)
    floor = min(item_floor, max(least, held_floor))  # of a word that is an item

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = _text.buffers(b.column(0))
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_text.word_hashes(raw, off[:-1], off[1:]).view(np.int64)), b.column(1), pa.array(group_of(raw, off[:-1], off[1:], groups).astype(np.int32))], names=["hash", "n", "g"])

    table = arrow(vocabulary.where((F.col("n") >= held_floor) & (F.length("word") > 0)), frequent, "hash bigint, n bigint, g int").toArrow()
    hashes, n, spelt = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy(), table.column("g").to_numpy()
    order = np.lexsort((n, hashes))
    hashes, n, spelt = hashes[order], n[order].astype(np.int64), spelt[order].astype(np.int64)
    own = np.flatnonzero(n >= floor)
    own = own[np.lexsort((hashes[own], -n[own]))]
    item = np.full(len(n), -1, np.int32)
    item[own] = 1 + np.arange(len(own))
    n_core = 1 + int((n >= item_floor).sum())  # the first items and all groups are clustered one after the other
    words = Words(hashes, n, item, 1 + len(own), groups)

    def group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, groups), np.int64)
        for b in batches:
            raw, off = _text.buffers(b.column(0))
            at, k = group_of(raw, off[:-1], off[1:], groups), b.column(1).to_numpy()
            for row, weight in enumerate((k, np.ones_like(k), k == 1, k == 2)):
                sums[row] += np.bincount(at, weight, groups).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups, dtype=np.int32)), *map(pa.array, sums)], names=["g", "n", "types", "once", "twice"])

    sums = np.zeros((4, groups), np.int64)
    rest = vocabulary.where((F.col("n") < floor) & (F.length("word") > 0))
    for row in arrow(rest, group_sums, "g int, n bigint, types bigint, once bigint, twice bigint").groupBy("g").agg(F.sum("n"), F.sum("types"), F.sum("once"), F.sum("twice")).collect():
        sums[:, row[0]] = row[1:]
    once, twice = sums[2].sum(), sums[3].sum()
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text", 1 << 20):
            raw, off = _text.buffers(b.column(0))
            _, _, first, own, _, _ = words.tokens(raw, off)
            yield pa.RecordBatch.from_arrays([pa.array([words.with_ends(own, first).astype(np.int32)], pa.list_(pa.int32()))], names=["line"])

    lines = scratch.keep(arrow(learning.select("text"), encode, "line array<int>"), "lines")
    # what the exchange one after the other sees: a further word as its spelling group
    seen_as = np.concatenate([np.arange(n_core), n_core + spelt[own[n_core - 1 :]], n_core + np.arange(groups)])
    size = n_core + groups
    pairs = summed(lines, lambda line: seen_as[line[:-1]] * size + seen_as[line[1:]])
    pairs = pairs.select(F.floor(F.col("key") / size).cast("int").alias("left"), (F.col("key") % size).cast("int").alias("right"), "k").orderBy("left", "right").toArrow()
    cls, m = exchange(size, *(pairs.column(x).to_numpy() for x in ("left", "right", "k")), classes)
    del pairs
    cls = cls[seen_as]
    for _ in range(rounds if words.n_items > n_core else 0):
        cls = _further(lines, n_core, words.n_items, cls, m, classes)
        m = _transitions(lines, cls, classes)
    history, seen = m.sum(1), (m > 0).sum(1)
    alone = (m.sum(0) + 0.5) / (m.sum() + 0.5 * classes)
    step = (m + (seen[:, None] + 1) * alone[None, :]) / (history[:, None] + seen[:, None] + 1)
    item_n = np.concatenate([[int(totals[2])], n[own], sums[0]]) + 0.5
    emit = item_n / np.bincount(cls, item_n, classes)[cls]
    # the unseen words of a group, as many as Chao's estimate, share its discounted mass; a group without words is all unseen
    types = np.maximum(1.0, sums[2].astype(float) ** 2 / np.maximum(2 * sums[3], 1))
    types = np.maximum(types, float(once) ** 2 / max(2 * int(twice), 1) / groups)
    unseen = np.log10(np.where(sums[0] > 0, np.maximum(discount * sums[1], 1e-300), 1.0) / types)
    return Model(words, cls, np.log10(step), np.log10(emit), discount, sums[0], unseen, int(totals[0]), int(totals[1]), int(totals[2])), vocabulary.where((F.col("n") < held_floor) & (F.length("word") > 0))


def _further(lines: DataFrame, n_core: int, n_items: int, cls: np.ndarray, m: np.ndarray, classes: int) -> np.ndarray:
    """The classes, with the likeliest one by the classes beside it for each item from ``n_core`` on."""

    def beside(line: np.ndarray) -> np.ndarray:
        c = cls[line]
        at = np.flatnonzero((line >= n_core) & (line < n_items))  # never first or last: those are ends
        word = (line[at].astype(np.int64) - n_core) * (2 * classes)
        return np.concatenate([word + c[at - 1], word + classes + c[at + 1]])

    alone = (m.sum(0) + 0.5) / (m.sum() + 0.5 * classes)
    follow = np.log((m + alone[None, :]) / (m.sum(1)[:, None] + 1))
    size = np.log(m.sum(0) + 1)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where, counts = b.column(1), np.zeros((b.num_rows, 2 * classes))
            row = np.repeat(np.arange(b.num_rows), where.value_lengths().to_numpy())
            flat = where.flatten()
            np.add.at(counts, (row, flat.field("cell").to_numpy()), flat.field("k").to_numpy())
            left, right = counts[:, :classes], counts[:, classes:]
            gain = left @ follow + right @ follow.T - left.sum(1)[:, None] * size
            gain[:, 0] = -np.inf  # the end's own
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gain.argmax(1), pa.int32())], names=["w", "class"])

    width = 2 * classes
    cells = counted(lines, beside).select(F.floor(F.col("key") / width).cast("int").alias("w"), (F.col("key") % width).cast("int").alias("cell"), "k")
    # dealt by word once, for both sums; the tasks have summed their own already
    cells = cells.repartition("w").groupBy("w", "cell").agg(F.sum("k").alias("k"))
    found = arrow(cells.groupBy("w").agg(F.collect_list(F.struct("cell", "k")).alias("cells")), best, "w int, class int").toArrow()
    out = cls.copy()
    out[n_core + found.column("w").to_numpy()] = found.column("class").to_numpy()
    return out


def _transitions(lines: DataFrame, cls: np.ndarray, classes: int) -> np.ndarray:
    """The class bigram counts over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(classes * classes, np.int64)
        for b in batches:
            for line in b.column(0):
                c = cls[line.values.to_numpy()]
                found += np.bincount(c[:-1] * classes + c[1:], minlength=classes * classes)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at])], names=["pair", "k"])

    table = arrow(lines, run, "pair int, k bigint").groupBy("pair").agg(F.sum("k").alias("k")).toArrow()
    m = np.zeros(classes * classes)
    m[table.column("pair").to_numpy()] = table.column("k").to_numpy()
    return m.reshape(classes, classes)


def score(rows: DataFrame, model: Model, other: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "held_out", "word", "unseen", "n_tokens", "n_known", "base", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, log_n = model.words, np.log10(np.maximum(model.group_n, 1))
        for b in _text.slices(batches, "text", 1 << 20):
            raw, off = _text.buffers(b.column(2))
            starts, ends, first, item, count, known = words.tokens(raw, off)
            n = b.num_rows
            texts = np.arange(n)
            line = words.with_ends(item, first)
            c = model.cls[line]
            gain = model.step[c[:-1], c[1:]] + model.emit[line[1:]]  # of each word and end, in order
            owner = np.repeat(texts, np.diff(first) + 1)
            total = np.bincount(owner, gain, n)
            word_of = np.repeat(texts, np.diff(first))
            grouped = item >= words.n_items
            g = np.where(grouped, item - words.n_items, 0)
            inside = np.where(known, np.log10(np.maximum(count - model.discount, 1e-300)), 0.0) - log_n[g]
            total += np.bincount(word_of[grouped], inside[grouped], n)
            base = np.bincount(word_of[known], np.log10(count[known] + 0.5), n) + np.log10(model.end_count + 0.5) - (np.diff(first) + 1) * model.denominator
            n_known = np.bincount(word_of[known], minlength=n) + (model.end_count > 0)
            rows = b.column(0).to_numpy()
            # a head for each text, under a word that no text can hold; then each of its words of the counts table
            head = pa.array([b" %d" % r for r in rows.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), head, pa.array(np.zeros(n)), pa.array(np.diff(first) + 1), pa.array(n_known), pa.array(base), pa.array(total)], names=names)
            far = np.flatnonzero(~known)
            if len(far):
                length = (ends - starts)[far]
                offset = np.concatenate([[0], np.cumsum(length)])
                letters = _text.LOWER[raw[np.arange(offset[-1]) + np.repeat(starts[far] - offset[:-1], length)]]
                word = pa.Array.from_buffers(pa.binary(), len(far), [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(letters)])
                m = len(far)
                nil, none = pa.array(np.zeros(m, np.int64)), pa.array(np.zeros(m))
                yield pa.RecordBatch.from_arrays([pa.array(rows[word_of[far]]), pa.nulls(m, b.schema.field(1).type), pa.nulls(m, pa.bool_()), word, pa.array(model.unseen[g[far]]), nil, nil, none, none], names=names)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
    parts = arrow(numbered, run, f"row bigint, doc_id {kind}, held_out boolean, word binary, unseen double, n_tokens bigint, n_known bigint, base double, score double")
    met = parts.join(other.withColumnRenamed("n", "c"), "word", "left")
    is_far, seen = F.col("n_tokens") == 0, F.col("c").isNotNull()
    met = met.select(
        "row", "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.when(seen, 1).otherwise(0)).alias("n_known"),
        (F.col("base") + F.when(is_far, F.log10(F.coalesce("c", F.lit(0)) + 0.5)).otherwise(0.0)).alias("base"),
        (F.col("score") + F.when(seen, F.log10(F.greatest(F.col("c") - model.discount, F.lit(1e-300)))).otherwise(F.col("unseen"))).alias("score"),
    )
    whole = met.groupBy("row").agg(F.first("doc_id", ignorenulls=True).alias("doc_id"), F.bool_or("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1, **how: int) -> DataFrame:
    rows = _rows(docs, id_col, text_col, folds, held_fold)
    model, other = fit(rows, Scratch(docs.sparkSession, "lm"), **how)
    return score(rows, model, other)
