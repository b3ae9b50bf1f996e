"""Repeated substrings by column-wise construction of a collection's BWT.

Wanted: every byte covered by a string of ``length`` bytes that starts at two
places or more of the whole corpus.  All of a length-200 string's occurrences
have the same anchor at the same place (see ``anchors``), so suffixes need only
be ordered inside a bucket of anchors and among suffixes at one distance from
the anchor.  The transform of a bucket's segments is built as multi-document
construction does it: columns go from right to left, every document inserts one
symbol a round, the new order is the old one dealt stably by that symbol, and
the common prefix of two neighbours is one more than the least of the common
prefixes between them in the old order (0 if the symbols differ).  Where a
neighbour shares ``length`` bytes, the string that starts in this column
repeats.  That decides every byte; hashes only deal segments to buckets and
tell copies of one segment, of which two go into the construction.

Around that core, sequential tables in the shared folder:

* ``runs``: anchors of the texts, without those whose slot in a table of fixed
  size (2^27 bits) holds one occurrence only,
* ``segments``: distinct (anchor, segment) with their number; copies of a
  segment, and so of a document, are one row from here on,
* ``decided``: the repeated window starts.

Nothing is capped.  An anchor with over ``most`` distinct segments is dealt to
many tasks: its windows go by ranges of their distance to the anchor, and inside
a range by the bytes that all its windows cover, which equal windows share; what
is still too large goes by single distances.  Each of those parts is constructed
like an anchor's.  Texts
are shuffled only where a fixed-size filter of row keys says that they are
asked for; a saturated filter costs shuffle, never results.  Segments and rows are
identified by 128 bits of hashes.

Defined results: null and empty texts have 0 bytes, texts under ``length`` lose
nothing; rows with equal id and text are occurrences each and get equal rows; a
null id is allowed; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow
from quarry.llm.anchors import GRAM, runs

LENGTH, MOST, PER_BUCKET = 200, 2_000, 8_000
WIDTHS = (16, 1)  # distances to the anchor that a part of a hot anchor takes
SLOTS, ROWS = 27, 24  # log2 of the bits of the tables of anchors and of row keys


def repeated_starts(segments: list[bytes], places: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """(segment, column of the start) -> True where the string of ``length`` bytes there is also in another segment.

    ``places``: where the anchor is in each segment; ``windows``: its number of window starts.
    """
    left = int(places.max())
    width = left + max(len(s) - int(p) for s, p in zip(segments, places))
    text = np.zeros((len(segments), width), np.uint8)  # 0: no symbol; a byte b is b + 1
    for i, (s, p) in enumerate(zip(segments, places)):
        text[i, left - p : left - p + len(s)] = np.frombuffer(s, np.uint8) + 1
    first = left - places  # column of each segment's first window
    found = np.zeros((len(segments), int((first + windows).max())), bool)
    order = np.arange(len(segments))
    common = np.zeros(len(segments), np.uint8)  # common[i]: of the documents at i - 1 and i, at most 255
    for column in range(width - 1, -1, -1):
        symbol = text[order, column]
        new = np.empty_like(common)
        deal = np.argsort(symbol, kind="stable")
        at = 0
        for c, n in zip(*np.unique(symbol, return_counts=True)):
            own = deal[at : at + n]
            new[at] = 0
            if n > 1:
                if c == 0:
                    new[at + 1 : at + n] = 0
                else:
                    least = np.minimum.reduceat(common[: own[-1] + 1], own[:-1] + 1)
                    new[at + 1 : at + n] = np.minimum(least, 254) + 1
            at += n
        order, common = order[deal], new
        if column < found.shape[1]:
            far = common >= length
            far[:-1] |= far[1:]
            who = order[far]
            who = who[(column >= first[who]) & (column < first[who] + windows[who])]
            found[who, column] = True
    return found


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _bits(table: DataFrame, column: str, log_bits: int) -> np.ndarray:
    """A table of 2^log_bits bits with those of the hashes of ``column`` set."""
    slot = F.shiftrightunsigned(F.col(column), 64 - log_bits)
    words = table.select(F.shiftright(slot, 5).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned({column}, {64 - log_bits}), 32) as int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (log_bits - 5), np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def _has(bits: np.ndarray, hashes: np.ndarray, log_bits: int) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - log_bits)).astype(np.int64)
    return (bits[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1) > 0


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most: int = MOST, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.xxhash64(F.lit(1), "text", "doc_id").alias("row2"), "text")
    gram = min(GRAM, max(8, length // 3))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            a = runs(*_text.buffers(b.column(0)), length, gram)["anchor"]
            slot, n = np.unique((a >> np.uint64(64 - SLOTS)).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.minimum(n, 2).astype(np.int8))], names=["slot", "n"])

    # a slot seen twice may hold an anchor seen twice; one seen once does not
    seen = arrow(source.select("text"), count, "slot int, n tinyint").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1")
    twice = _bits(seen.select((F.shiftleft(F.col("slot").cast("long"), 64 - SLOTS)).alias("hash")), "hash", SLOTS)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            r = runs(*_text.buffers(b.column(2)), length, gram)
            own = _has(twice, r["anchor"], SLOTS)
            at = pa.array(r["row"][own])
            values = [b.column(0).take(at), b.column(1).take(at), pa.array(r["start"][own].astype(np.int32)), pa.array(r["n"][own].astype(np.int16)), pa.array((r["place"] - r["start"])[own].astype(np.int16)), pa.array(r["anchor"][own].view(np.int64)), pa.array(r["segment"][own].view(np.int64))]
            yield pa.RecordBatch.from_arrays(values, names=["row", "row2", "start", "windows", "place", "anchor", "segment"])

    found = scratch.keep(arrow(source.select("row", "row2", "text"), collect, "row bigint, row2 bigint, start int, windows smallint, place smallint, anchor bigint, segment bigint"), "runs")
    segments = found.groupBy("anchor", "segment").agg(F.count("*").alias("copies"), F.min(F.struct("row", "row2", "start", "windows", "place")).alias("at"))
    segments = scratch.keep(segments.select("anchor", "segment", "copies", "at.*"), "segments")
    # written, so that the join reads two exchanges and adaptive execution can split a hot anchor
    anchors = scratch.keep(segments.groupBy("anchor").agg(F.sum("copies").alias("all")).where(F.col("all") > 1).select("anchor"), "anchors")
    asked = scratch.keep(segments.join(anchors, "anchor"), "asked")

    text_of = _asked_for(source, asked.select("row").distinct())
    fields = ["start", "windows", "place", "anchor", "segment", "copies"]
    wanted = asked.groupBy("row", "row2").agg(F.collect_list(F.struct(*fields)).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text", 1 << 20):
            texts, lists = _text.texts(b.column(0)), b.column(1)
            flat, n = lists.flatten(), lists.value_lengths().to_numpy()
            start, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
            piece = [texts[i][a:z] for i, a, z in zip(np.repeat(np.arange(len(n)), n).tolist(), start.tolist(), (start + windows + length - 1).tolist())]
            yield pa.RecordBatch.from_arrays([flat.field(c) for c in ("anchor", "segment", "copies", "windows", "place")] + [pa.array(piece, pa.binary())], names=["g", "s", "copies", "windows", "place", "bytes"])

    # a shuffle join, so that the Python workers of the two sides of it never stand in one task
    pieces = arrow(text_of.select("row", "row2", "text").join(wanted.hint("merge"), ["row", "row2"]).select("text", "wanted"), cut, PIECE)
    pieces = scratch.keep(pieces.dropDuplicates(["g", "s"]), "pieces")  # equal rows cut the same ones
    scratch.drop("asked")

    spans = _decide(pieces, scratch, length, most, per_bucket, WIDTHS).select(F.col("g").alias("anchor"), F.col("s").alias("segment"), "lo", "hi")
    # written, so that the join below reads two exchanges and adaptive execution can split a segment of many copies
    several = scratch.keep(segments.select("anchor", "segment", "copies", "row", "row2", "start").join(spans, ["anchor", "segment"]), "spans")
    scratch.drop("pieces")
    place = lambda of: of.select("row", "row2", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    # a segment without a copy is in the row that it was cut from
    copied = found.join(several.where("copies > 1").select("anchor", "segment", "lo", "hi"), ["anchor", "segment"])
    decided = place(several.where("copies = 1")).unionByName(place(copied)).groupBy("row", "row2").agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))  # equal rows have equal ones
    decided = scratch.keep(decided, "decided")
    scratch.drop("runs", "segments", "spans")

    touched = _asked_for(source, decided.select("row"), keep_rest=True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text", 1 << 20):
            n, removed, spans, digest = [], [], [], []
            for text, starts in zip(_text.texts(b.column(1)), b.column(2).to_pylist()):
                edge = np.zeros(len(text) + 1, np.int64)
                for s in starts or ():
                    edge[s["lo"]] += 1
                    edge[s["hi"] + length - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                n.append(len(text)), removed.append(int(gone.sum())), spans.append(len(_spans(gone)[0]))
                digest.append(hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = touched.where("maybe").select("doc_id", "row", "row2", "text").join(decided.hint("merge"), ["row", "row2"], "left").select("doc_id", "text", "starts")
    done = arrow(joined, remove, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    zero = F.lit(0).cast("long")
    rest = touched.where("not maybe").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    return done.unionByName(rest)


PIECE = "g bigint, s bigint, copies bigint, windows smallint, place smallint, bytes binary"


def _decide(pieces: DataFrame, scratch: Scratch, length: int, most: int, per_bucket: int, widths: tuple[int, ...]) -> DataFrame:
    """(g, s, lo, hi): the repeated window starts of each piece ``s`` of a group ``g``; equal windows are in one group at one distance from ``place``."""
    sizes = pieces.groupBy("g").agg(F.count("*").alias("distinct"), F.sum("copies").alias("all")).where(F.col("all") > 1)
    sizes = scratch.keep(sizes.select("g", "distinct"), f"sizes-{len(widths)}")
    n, hottest = sizes.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.max("distinct"), F.lit(0))).first()
    if not widths:
        most = hottest
    buckets = max(1, -(-n // per_bucket))

    def construct(group: pd.DataFrame) -> pd.DataFrame:
        twice = np.repeat(np.arange(len(group)), np.minimum(group["copies"].to_numpy(), 2))
        parts = group["bytes"].to_list()
        place, windows = (group[c].to_numpy().astype(np.int64) for c in ("place", "windows"))
        flags = repeated_starts([parts[i] for i in twice], place[twice], windows[twice], length)
        first = place[twice].max() - place[twice]
        who, lo, hi = [], [], []
        for k in np.flatnonzero(np.r_[True, twice[1:] != twice[:-1]] & flags.any(1)):
            a, z = _spans(flags[k])
            who += [twice[k]] * len(a)
            lo += (a - first[k]).tolist()
            hi += (z - first[k]).tolist()
        return pd.DataFrame({"g": group["g"].to_numpy()[who], "s": group["s"].to_numpy()[who], "lo": np.array(lo, np.int32), "hi": np.array(hi, np.int32)})

    few = pieces.join(sizes.where(F.col("distinct") <= most).select("g"), "g").withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets)))
    out = few.groupBy("bucket").applyInPandas(construct, "g bigint, s bigint, lo int, hi int")
    if hottest <= most:
        return out

    width = widths[0]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("g0", pa.int64()), ("s0", pa.int64()), ("from", pa.int16()), ("g", pa.int64()), ("s", pa.int64()), ("copies", pa.int64()), ("windows", pa.int16()), ("place", pa.int16()), ("bytes", pa.binary())])
        for b in batches:
            rows = []
            for g, s, copies, windows, place, text in zip(*(b.column(i).to_pylist() for i in range(6))):
                for q in range((place - windows + 1) // width, place // width + 1):
                    # the windows at a distance of q * width to (q + 1) * width - 1
                    a, z = max(0, place - (q + 1) * width + 1), min(windows, place - q * width + 1)
                    own = text[a : z + length - 1]
                    common = text[max(0, place - q * width) : place - (q + 1) * width + 1 + length]
                    key = hashlib.blake2b(common, digest_size=8, salt=(g & (2**64 - 1)).to_bytes(8, "little") + q.to_bytes(4, "little", signed=True)).digest()
                    rows.append((g, s, a, int.from_bytes(key, "little", signed=True), int.from_bytes(hashlib.blake2b(own, digest_size=8, salt=(z - a).to_bytes(2, "little")).digest(), "little", signed=True), copies, z - a, place - a, own))
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 4096]), schema.types)], schema=schema)

    hot = pieces.join(sizes.where(F.col("distinct") > most).select("g"), "g").select("g", "s", "copies", "windows", "place", "bytes")
    parts = scratch.keep(arrow(hot, part, f"g0 bigint, s0 bigint, from smallint, {PIECE}"), f"parts-{len(widths)}")
    distinct = parts.groupBy("g", "s").agg(F.sum("copies").alias("copies"), F.first("windows").alias("windows"), F.first("place").alias("place"), F.first("bytes").alias("bytes"))
    inner = _decide(scratch.keep(distinct, f"distinct-{len(widths)}"), scratch, length, most, per_bucket, widths[1:])
    back = parts.drop("copies", "windows", "place", "bytes").join(inner, ["g", "s"])
    return out.unionByName(back.select(F.col("g0").alias("g"), F.col("s0").alias("s"), (F.col("from") + F.col("lo")).cast("int").alias("lo"), (F.col("from") + F.col("hi")).cast("int").alias("hi")))


def _asked_for(source: DataFrame, rows: DataFrame, keep_rest: bool = False) -> DataFrame:
    """The rows of ``source`` that may have one of the keys ``rows``: those, or all with a flag ``maybe``."""
    bits = _bits(rows, "row", ROWS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maybe = pa.array(_has(bits, b.column(1).to_numpy().view(np.uint64), ROWS))
            out = pa.RecordBatch.from_arrays([*b.columns, maybe], names=[*b.schema.names, "maybe"])
            yield out if keep_rest else out.filter(maybe)

    return arrow(source, mark, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, row bigint, row2 bigint, text string, maybe boolean")
