"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Both sides are compared as bytes with A-Z lower-cased, a run of ASCII whitespace
as one space, and a stretch that repeats one to four bytes over and over (rulers,
padding) as its first five repeats; offsets are those of the text.  So
indented code and tables share grams with a benchmark where they share words, and
not by their blanks.  Every item is cut into segments
of ``segment`` bytes that start every ``stride`` bytes (shorter items are one
segment), so that a verbatim passage of ``segment + stride - 1`` bytes from
anywhere in an item holds a whole segment.  A
segment of m bytes occurs in a text within k = floor(rate * m) edits (m // q - 2 at
most, so that the next bound is above 0) only if a
diagonal band of width 2k holds at least m + 1 - q * (k + 1) of its q-grams
(q-gram lemma); bands overlap by half, so that no occurrence is split between
two.  Regions that hold that many are verified by an alignment restricted to
their band; what passes is a hit.  Items under ``least_item`` bytes have no room
for edits: they are matched exactly, between word bounds.

The benchmark is met in blocks of at most ``block_bytes``: a block's gram table has a
known size, and a task holds one at a time.  With several blocks, texts that
have enough grams of any block are marked first, by a table of fixed size (2^26
bits); a task gathers ``HELD_BYTES`` of those before it goes through the blocks.
Matches of grams are expanded for ranges of segments, ``MOST_PAIRS`` at a time about,
so that memory does not depend on how often a gram stands in the benchmark.

Defined results: a null or empty text has no hit; null items, items of null id
and items shorter than one q-gram match nothing (they would match anywhere);
equal items all hit; repeated rows each get a row; an empty table
gives an empty result; other columns are ignored or carried along, whatever their
names (one called ``__hits`` is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import _text
from quarry.llm._scratch import arrow

Q, SEGMENT, STRIDE, RATE, LEAST_ITEM, BLOCK_BYTES = 8, 48, 8, 0.1, 32, 1 << 22
_FOLD = _text.LOWER.copy()
_FOLD[_text.SPACE] = 32
_BITS, _ALL_BITS = 22, 26
PERIODS, REPEATS, MOST_PAIRS, AT_ONCE, HELD_BYTES = (1, 2, 3, 4), 4, 2_000_000, 4096, 1 << 26
#: bytes of words: letters, digits, and all of a character beyond ASCII
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def folded(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts, where each byte stood) of a buffer of texts as they are compared."""
    raw = _FOLD[raw]
    drop = np.zeros(len(raw), bool)
    first = off[:-1][np.diff(off) > 0]
    for period in PERIODS:
        if len(raw) <= period:
            break
        same = np.zeros(len(raw), bool)
        np.equal(raw[period:], raw[:-period], out=same[period:])
        for k in range(period):
            at = first + k
            same[at[at < len(raw)]] = False  # nothing repeats across two texts
        if period == 1:
            drop |= same & (raw == 32)
        # of a stretch that equals itself ``period`` before, all but the first repeats
        long = period * REPEATS
        breaks = np.flatnonzero(~same)
        size = np.diff(np.append(breaks, len(raw))) - 1
        for a, n in zip(breaks[size > long].tolist(), size[size > long].tolist()):
            drop[a + 1 + long : a + 1 + n] = True
    keep = np.flatnonzero(~drop)
    return raw[keep], np.searchsorted(keep, off), keep


def fold(text: bytes) -> bytes:
    return folded(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tobytes()


def grams(raw: np.ndarray) -> np.ndarray:
    """The 8-byte windows of a buffer as exact integers."""
    two = raw[:-1].astype(np.uint64) | raw[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    return four[:-4] | four[4:] << np.uint64(32)


def _slot(g: np.ndarray, bits: int = _BITS) -> np.ndarray:
    return (g * _text.MULT) >> np.uint64(64 - bits)


def _dense(at: np.ndarray, least: int, span: int) -> np.ndarray:
    """Which of the sorted places are among ``least`` that lie within ``span``."""
    thick = np.zeros(len(at) + 1, np.int64)
    begins = np.flatnonzero(at[least - 1 :] - at[: max(0, len(at) - least + 1)] <= span)
    np.add.at(thick, begins, 1), np.add.at(thick, begins + least, -1)
    return np.cumsum(thick[:-1]) > 0


def aligned(pattern: bytes, text: bytes, shift: int, most: int) -> int:
    """Least edits of ``pattern`` against any substring of ``text``, on diagonals 0..2*shift; most + 1 if above."""
    m, width = len(pattern), 2 * shift + 1
    p, t = np.frombuffer(pattern, np.uint8), np.frombuffer(text[: m + width].ljust(m + width, b"\0"), np.uint8)
    return int(aligned_all(p[None], t[None], np.array([len(text)]), shift, most)[0])


def aligned_all(patterns: np.ndarray, texts: np.ndarray, sizes: np.ndarray, shift: int, most: int) -> np.ndarray:
    """``aligned`` of each row of patterns against its row of texts, of which the first ``sizes`` bytes count."""
    out = np.full(len(patterns), most + 1, np.int64)
    ids, m, width = np.arange(len(patterns)), patterns.shape[1], 2 * shift + 1
    p, t = np.ascontiguousarray(patterns.T), np.ascontiguousarray(texts.T)
    inside = np.arange(m + width)[:, None] < sizes
    row = np.zeros((width, len(ids)), np.int8)  # row[d]: pattern[:i] ends at text[i + d]; it may start on any diagonal
    for i in range(m):
        same = (t[i : i + width] == p[i]) & inside[i : i + width]
        new = row + ~same  # (mis)match keeps the diagonal
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # a pattern byte more: one diagonal down
        for up in (1, 2, 4, 8)[: int(most).bit_length()]:  # text bytes more: diagonals up, ``most`` at most
            new[up:] = np.minimum(new[up:], new[:-up] + up)
        row = np.minimum(new, most + 1, out=new)
        if i % 8 == 7:
            some = row.min(0) <= most
            if not some.all():
                ids, p, t, inside, row = ids[some], p[:, some], t[:, some], inside[:, some], row[:, some]
                if not len(ids):
                    break
    if len(ids):
        out[ids] = row.min(0)
    return out


def bounded(raw: np.ndarray, start: int, end: int, first: int, last: int) -> bool:
    """Whether ``start`` to ``end`` cuts no word of the text that lies from ``first`` to ``last``."""
    before = start > first and _WORD[raw[start - 1]] and _WORD[raw[start]]
    after = end < last and _WORD[raw[end - 1]] and _WORD[raw[end]]
    return not (before or after)


class Index:
    """The q-grams of the segments of one block of items.

    A gram is held once for each place in the items; the segments that cover the
    place are a range of the segments' numbers.
    """

    def __init__(self, items: list[tuple[int, bytes]], segment: int = SEGMENT, rate: float = RATE, least_item: int = LEAST_ITEM, stride: int = STRIDE):
        owner, lengths, begins, exact, parts, base = [], [], [], [], [], 0
        for item, text in items:
            text = fold(text)
            short = len(text) < least_item
            if short:
                text = text.strip()
                if len(text) < Q:
                    continue
            cuts = [0] if short else sorted({*range(0, max(1, len(text) - segment + 1), stride), max(0, len(text) - segment)})
            owner += [item] * len(cuts)
            lengths += [min(segment, len(text))] * len(cuts)
            begins += [base + c for c in cuts]
            exact += [short] * len(cuts)
            parts.append((base, text))
            base += len(text) + segment  # no segment reaches into the next item
        self.owner, self.lengths, self.begins, self.exact = (np.array(x, t) for x, t in ((owner, np.int64), (lengths, np.int64), (begins, np.int64), (exact, bool)))
        self.text = np.zeros(base, np.uint8)
        for at, text in parts:
            self.text[at : at + len(text)] = np.frombuffer(text, np.uint8)
        self.edits = np.minimum((rate * self.lengths).astype(np.int64), np.maximum(self.lengths // Q - 2, 0))
        self.edits[self.exact] = 0
        self.needed = self.lengths + 1 - Q * (self.edits + 1)
        place = np.concatenate([*(np.arange(at, at + len(t) - Q + 1) for at, t in parts), np.zeros(0, np.int64)])
        g = grams(self.text)[place] if len(place) else np.zeros(0, np.uint64)
        order = np.argsort(g, kind="stable")
        place = place[order]
        self.grams, first = np.unique(g[order], return_index=True)
        self.first = np.append(first, len(g))
        # segments that hold the whole gram: they begin at it or before, and end after it
        self.place = place.astype(np.int32)
        self.seg_from = np.searchsorted(self.begins, place - segment + Q).astype(np.int32)
        self.seg_to = np.searchsorted(self.begins, place, "right").astype(np.int32)
        # by gram and then place, to find the places of a gram in a range of segments
        self.key = np.repeat(np.arange(len(self.grams)), np.diff(self.first)) * (base + 1) + place
        self.base, self.segment = base, segment
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[_slot(self.grams)] = True

    @property
    def least(self) -> tuple[int, int]:
        """(grams, bytes): an occurrence has that many grams within that length."""
        return int(self.needed.min()), int((self.edits + self.lengths - Q).max())

    def hits(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits) of every verified region of a buffer of texts."""
        raw, off, source = folded(raw, off)
        if len(raw) < Q or len(self.grams) == 0:
            return []
        g = grams(raw)
        at = np.flatnonzero(self.seen[_slot(g)])
        k = np.searchsorted(self.grams, g[at])
        k[k == len(self.grams)] = 0
        true = self.grams[k] == g[at]
        at, k = at[true], k[true]
        row = np.searchsorted(off, at, "right") - 1
        whole = at + Q <= off[row + 1]  # a gram never crosses two texts
        at, k, row = at[whole], k[whole], row[whole]
        # what stands too thin is in no occurrence
        dense = _dense(at, *self.least)
        at, k, row = at[dense], k[dense], row[dense]
        found: list[tuple[int, int, int, int, int]] = []
        ranges = [(0, len(self.begins))] if len(at) else []
        while ranges:
            lo, hi = ranges.pop()
            # places that segments of this range may cover
            low, high = self.begins[lo], self.begins[hi - 1] + self.segment
            first, end = (np.searchsorted(self.key, k * (self.base + 1) + min(int(x), self.base)) for x in (low, high))
            some = np.flatnonzero(end > first)
            if len(some) == 0:
                continue
            total = int((end - first).sum()) * (1 + self.segment // STRIDE)
            if total > MOST_PAIRS and hi - lo > 1:
                ranges += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
                continue
            found += self._regions(raw, off, at[some], row[some], first[some], end[some] - first[some], lo, hi)
        last = np.append(source, 0)
        begins = source[np.minimum(off[:-1], max(0, len(source) - 1))]
        return [(i, item, int(last[off[i] + a] - begins[i]), int(last[off[i] + z - 1] + 1 - begins[i]), edits) for i, item, a, z, edits in found]

    def _regions(self, raw: np.ndarray, off: np.ndarray, at: np.ndarray, row: np.ndarray, first: np.ndarray, n: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int, int, int]]:
        """Verified regions of the segments from ``lo`` to ``hi``; ``first``, ``n``: the places of each gram of the text."""
        spread = lambda n, from_: np.repeat(from_ - (np.cumsum(n) - n), n) + np.arange(n.sum())  # noqa: E731  from_, from_ + 1, ... n of each
        flat = spread(n, first)
        at, row = np.repeat(at, n), np.repeat(row, n)
        seg_from = np.maximum(self.seg_from[flat], lo)
        n = np.maximum(np.minimum(self.seg_to[flat], hi) - seg_from, 0)
        seg = spread(n, seg_from)
        pos = np.repeat(self.place[flat], n) - self.begins[seg]
        at, row = np.repeat(at, n), np.repeat(row, n)
        lead = int(self.lengths.max())
        diagonal = at - pos + lead  # of the buffer; texts never share one region as rows differ
        width = np.maximum(2 * self.edits[seg], 1)
        regions = []
        for half in (0, 1):
            band = (diagonal + half * (width // 2)) // width
            order = np.argsort((row * len(self.begins) + seg) * (int(band.max(initial=0)) + 1) + band, kind="stable")
            r, s, b = row[order], seg[order], band[order]
            edge = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1]) | (b[1:] != b[:-1])]) if len(r) else np.zeros(0, np.int64)
            edge = edge[np.diff(np.r_[edge, len(r)]) >= self.needed[s[edge]]]
            wide = width[order[edge]]
            regions.append(np.stack([r[edge], s[edge], b[edge] * wide - half * (wide // 2) - lead]))
        i, j, low = np.concatenate(regions, 1)
        span = len(raw) + 4 * lead
        once = np.unique((i * len(self.begins) + j) * span + low + 2 * lead, return_index=True)[1]
        i, j, low = i[once], j[once], low[once]
        edits, lengths, exact = self.edits[j], self.lengths[j], self.exact[j]
        wide = np.maximum(2 * edits, 1)
        begin = np.maximum(off[i], low - edits)
        lack = begin - (low - edits)  # diagonals before the text: a pattern may lose its first bytes
        end = np.where(exact, begin + lengths, np.minimum(off[i + 1], low + wide + lengths + edits))
        good = ~exact
        for x in np.flatnonzero(exact & (lack == 0) & (end <= off[i + 1])).tolist():
            good[x] = bounded(raw, int(begin[x]), int(end[x]), int(off[i[x]]), int(off[i[x] + 1]))
        found: list[tuple[int, int, int, int, int]] = []
        for m, most in sorted({*zip(lengths[good].tolist(), edits[good].tolist())}):
            own = np.flatnonzero(good & (lengths == m) & (edits == most))
            shift = max(1, 2 * most) // 2 + 2 * most + 1
            across = np.arange(m + 2 * shift + 1)
            for k in range(0, len(own), AT_ONCE):
                x = own[k : k + AT_ONCE]
                at = (begin - lack)[x, None] + across
                texts = np.where((across >= lack[x, None]) & (at < end[x, None]), raw[np.clip(at, 0, len(raw) - 1)], np.uint8(255))
                patterns = self.text[self.begins[j[x], None] + np.arange(m)]
                d = aligned_all(patterns, texts, lack[x] + end[x] - begin[x], shift, most)
                hit = x[d <= most]
                found += zip(i[hit].tolist(), self.owner[j[hit]].tolist(), (begin - off[i])[hit].tolist(), (end - off[i])[hit].tolist(), d[d <= most].tolist())
        return found


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The items, read in lists of at most ``block_bytes`` (one item at least)."""
    held, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null").distinct()
    for item, text in rows.toLocalIterator():
        b = text.encode("utf-8", "replace")
        if held and size + len(b) > block_bytes:
            yield sorted(held)
            held, size = [], 0
        held.append((item, b))
        size += len(b)
    if held:
        yield sorted(held)


def _gathered(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches of ``most_bytes`` about, one batch at least."""
    part, size = [], 0
    for b in batches:
        part.append(b)
        size += b.nbytes
        if size >= most_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES, hits_col: str = "__hits", **how: float) -> DataFrame:
    """Every row of ``docs`` and ``hits_col``: array of (item, start, end, edits), byte offsets of the verified regions."""
    sc = docs.sparkSession.sparkContext
    hit = T.ArrayType(T.StructType([T.StructField("item", T.LongType()), *(T.StructField(c, T.IntegerType()) for c in ("start", "end", "edits"))]))
    kind = pa.list_(pa.struct([("item", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))
    columns = [c for c in docs.columns if c != hits_col]
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"), F.lit(True).alias("maybe"), F.array().cast(hit).alias("hits"))
    held, least, any_of = [], None, np.zeros(1 << _ALL_BITS >> 3, np.uint8)
    for items in blocks(benchmark, block_bytes=block_bytes):
        index = Index(items, **how)
        if len(index.grams):
            slot = _slot(index.grams, _ALL_BITS)
            np.bitwise_or.at(any_of, (slot >> np.uint64(3)).astype(np.int64), (1 << (slot & np.uint64(7))).astype(np.uint8))
            n, span = index.least
            least = (n, span) if least is None else (min(least[0], n), max(least[1], span))
            held.append(sc.broadcast(items))  # each of a known size
    if len(held) > 1:
        bits = sc.broadcast(any_of)

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _text.slices(batches, "text", 1 << 18):
                raw, off = _text.buffers(b.column(1))
                maybe = np.zeros(b.num_rows, bool)
                raw, off, _ = folded(raw, off)
                if len(raw) >= Q:
                    slot = _slot(grams(raw), _ALL_BITS)
                    at = np.flatnonzero(bits.value[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    at = at[at + Q <= off[np.searchsorted(off, at, "right")]]
                    maybe[np.searchsorted(off, at[_dense(at, *least)], "right") - 1] = True
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(maybe), b.column(3)], names=b.schema.names)

        out = arrow(out, mark, out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = Index(held[0].value, **how) if len(held) == 1 else None
        for part in _gathered(_text.slices(batches, "text", 1 << 18), 0 if single else HELD_BYTES):
            own: list[list[list[dict]]] = [b.column(3).to_pylist() for b in part]
            marked = [np.flatnonzero(b.column(2).to_numpy(zero_copy_only=False)) for b in part]
            for items in held if any(len(who) for who in marked) else []:
                index = single or Index(items.value, **how)
                for b, lists, who in zip(part, own, marked):
                    for i, item, start, end, edits in index.hits(*_text.buffers(b.column(1).take(pa.array(who)))) if len(who) else []:
                        lists[who[i]].append({"item": item, "start": start, "end": end, "edits": edits})
            for b, lists in zip(part, own):
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(lists, kind)], names=b.schema.names)

    if held:
        out = arrow(out, run, out.schema)
    return out.select(*(F.col(f"r.`{c}`") for c in columns), F.col("hits").alias(hits_col))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how: float) -> DataFrame:
    """The rows of ``docs`` without a hit, with their own columns."""
    hits = _text.free_name("__hits", docs.columns)
    return contaminated(docs, benchmark, hits_col=hits, **how).where(F.size(hits) == 0).drop(hits)
