"""Packing: optimal length buckets, and token-budget batches inside each.

Tokens are the words between ASCII whitespace.
Texts over ``max_length`` tokens become consecutive pieces, each with the
whitespace after its words, so that the pieces of a text in order are the text,
byte for byte.  So the global
histogram has at most ``max_length + 1`` rows whatever the corpus; that is what
the driver gets.  Dynamic programming over it picks the bucket boundaries with
the least padding in all (ties: the smaller boundary).  In a bucket with
boundary b, a batch holds budget // b pieces (one at least).

Pieces are numbered inside their bucket without a global sort: each task counts
its own, and the small table of (task, bucket) counts turns those into offsets.

Defined results: null and empty texts, and texts of whitespace alone, are one
piece of 0 tokens (a null's text is empty) and go to the
first bucket; ties between lengths are packed in the order that they are read; repeated rows are packed each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

MAX_LENGTH, BUCKETS, BUDGET = 2048, 8, 65536
MOST_BROADCAST = 1_000_000  # rows of 16 bytes


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> tuple[list[int], int]:
    """Boundaries (largest lengths) of at most ``buckets`` buckets, and their padding in tokens."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n), np.int64)
    if len(lengths) == 0:
        return [], 0
    count = np.concatenate([[0], np.cumsum([histogram[int(k)] for k in lengths])]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum([histogram[int(k)] * int(k) for k in lengths])]).astype(np.int64)
    m, far = len(lengths), np.int64(2**62)
    best = np.full(m + 1, far)  # best[j]: least padding of the first j lengths
    best[0] = 0
    choice = []
    for _ in range(min(buckets, m)):
        new, came = np.full(m + 1, far), np.zeros(m + 1, np.int64)
        new[0] = 0
        for j in range(1, m + 1):
            i = np.arange(j)
            cost = np.where(best[:j] < far, best[:j] + lengths[j - 1] * (count[j] - count[i]) - (total[j] - total[i]), far)
            came[j] = cost.argmin()
            new[j] = cost[came[j]]
        best = new
        choice.append(came)
    out, j = [], m
    for came in reversed(choice):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(came[j])
    return sorted(out), int(best[m])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, piece, n_tokens, start, end, text): consecutive pieces of ``max_length`` tokens, the last one shorter; byte offsets."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            raw, off = _text.buffers(b.column(1))
            starts, _ = _text.word_spans(raw, off)
            first = np.searchsorted(starts, off)
            words = np.diff(first)
            n = np.maximum(-(-words // max_length), 1)
            text = np.repeat(np.arange(len(n)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            word = first[text] + piece * max_length
            begin = np.where(piece == 0, off[text], starts[np.minimum(word, max(len(starts) - 1, 0))] if len(starts) else 0)
            edge = np.append(begin, off[-1])
            size = np.minimum(max_length, words[text] - piece * max_length)
            whole = pa.Array.from_buffers(pa.string(), len(text), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])
            own = off[text]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text)), pa.array(piece.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(edge[:-1] - own), pa.array(edge[1:] - own), whole], names=["doc_id", "piece", "n_tokens", "start", "end", "text"])

    return arrow(source, cut, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, piece int, n_tokens int, start bigint, end bigint, text string")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, piece, n_tokens, start, end, text, bucket, batch, padding) of every piece; bucket: its boundary."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.keep(pieces(docs, id_col, text_col, max_length), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}
    bounds, _ = optimal_boundaries(histogram, buckets)
    edges = np.array(bounds or [max_length], np.int32)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen, task = np.zeros(len(edges), np.int64), TaskContext.get().partitionId()
        for b in batches:
            at = np.searchsorted(edges, b.column(2).to_numpy())
            rank = np.zeros(len(at), np.int64)
            for k in np.unique(at):
                own = np.flatnonzero(at == k)
                rank[own] = seen[k] + np.arange(len(own))
                seen[k] += len(own)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edges[at]), pa.array(np.full(len(at), task, np.int32)), pa.array(rank)], names=[*b.schema.names, "bucket", "task", "rank"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    # written, so that a task's numbers are fixed
    ranked = scratch.keep(arrow(cut, number, f"doc_id {kind}, piece int, n_tokens int, start bigint, end bigint, text string, bucket int, task int, rank bigint"), "ranked")
    scratch.drop("pieces")
    counts = ranked.groupBy("task", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("bucket").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = scratch.keep(counts.select("task", "bucket", before.alias("before")), "offsets")
    if offsets.count() <= MOST_BROADCAST:  # a row for each task and bucket; the texts are not shuffled then
        offsets = F.broadcast(offsets)
    placed = ranked.join(offsets, ["task", "bucket"])
    each = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket"), F.lit(1))))
    return placed.select("doc_id", "piece", "n_tokens", "start", "end", "text", "bucket", F.floor((F.col("before") + F.col("rank")) / each).cast("long").alias("batch"), (F.col("bucket") - F.col("n_tokens")).alias("padding"))
