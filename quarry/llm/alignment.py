"""Alignment of the tokens of two tokenizers by byte owners.

Both tokenizers cut the same bytes (a space and the text).  ``np.repeat`` of the
token numbers over their lengths gives the owner of every byte, once for each
tokenizer: where either owner changes, a new pair of tokens overlaps (a link);
where both change, both have a cut there and a group of tokens ends.

Every text is encoded once; its groups, and its distinct pairs of ids with how
often they are linked, are rows.  How many documents hold a pair corpus-wide is
a grouped count, summed per task before it is shuffled.  The counts come back to
the documents as a broadcast while they are ``most_broadcast`` at most (they
are bounded by the vocabularies, not by the corpus, but the product of two is
large), else by a shuffle join on pairs dealt by a salt, so that a pair that
every document holds is spread over tasks.

The byte-level encoder takes its vocabulary from the JSON file.  Where its merges
are in the order of the ids, tiktoken applies them (the same ids at a quarter of
the time); texts with over ``LONG_SPACE`` characters of white space in a row, which
that library can't cut, and other vocabularies go through tokenizers.

Defined results: a null or empty text, and one that either tokenizer's tokens do not
spell byte by byte (U+2581, say, or what a normaliser rewrites), has no tokens and no
groups; strings of special tokens are plain text; repeated rows are documents each;
an empty table gives an empty result; other columns are carried along, whatever their
names (``align``; those called like its own are replaced).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
MOST_BROADCAST, SALT, LONG_SPACE = 2_000_000, 16, 1_000
#: the pattern of byte-level pre-tokenization (a fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACES = re.compile(rf"\s{{{LONG_SPACE}}}")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, every other one as the next character from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids of texts (``encode``) and the bytes of each id (``spelled``)."""

    spelled: list[bytes]

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids' bytes in one buffer, and where each begins."""
        return np.frombuffer(b"".join(self.spelled), np.uint8), np.cumsum([0, *map(len, self.spelled)])


class ByteLevel(Encoder):
    """Byte-level BPE of a tokenizers JSON file; with ``fast``, by tiktoken where the merges allow."""

    def __init__(self, path: str, fast: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        made = json.loads(Path(path).read_text("utf-8"))
        byte = byte_of_character()
        vocabulary = {bytes(byte[c] for c in word): i for word, i in made["model"]["vocab"].items() if all(c in byte for c in word)}
        self.spelled = [b""] * (max(self.whole.get_vocab_size(), max(vocabulary.values()) + 1))
        for word, i in vocabulary.items():
            self.spelled[i] = word
        merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        spell = lambda word: bytes(byte[c] for c in word)
        joined = [vocabulary.get(spell(a) + spell(b)) for a, b in merges]
        plain = made.get("normalizer") is None and made["pre_tokenizer"]["type"] == "ByteLevel" and made["pre_tokenizer"]["use_regex"] and not made["pre_tokenizer"]["add_prefix_space"]
        self.by_rank = None
        if fast and plain and joined == list(range(256, 256 + len(merges))):
            import tiktoken

            self.by_rank = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks={w: i for w, i in vocabulary.items() if i < 256 + len(merges)}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.by_rank is None:
            return [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.whole.encode(t, add_special_tokens=False).ids if _SPACES.search(t) else self.by_rank.encode_ordinary(t) for t in texts]


class Pieces(Encoder):
    """A sentencepiece model that puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def _spell(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all tokens one after the other, length of each)."""
    raw, begins = table
    n = begins[ids + 1] - begins[ids]
    return raw[np.repeat((begins[ids] - (np.cumsum(n) - n)).astype(np.int32), n) + np.arange(int(n.sum()), dtype=np.int32)], n


def _written(ids: np.ndarray, after: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """(decimal ids, each with the byte ``after`` it, as one buffer; the length of each)."""
    cells = np.empty((len(ids), digits + 1), np.uint8)
    rest = ids.copy()
    for k in range(digits - 1, -1, -1):
        rest, cells[:, k] = np.divmod(rest, 10)
    width = np.searchsorted(10 ** np.arange(1, digits), ids, "right") + 1
    keep = np.arange(digits + 1) >= digits - width[:, None]
    cells[:, :-1] += 48
    cells[:, -1] = after
    return cells[keep], width + 1


class Aligner:
    """Aligns batches of texts; made once in a task."""

    def __init__(self, first: Encoder, second: Encoder):
        self.encoders, self.tables = (first, second), (first.table(), second.table())
        self.n_second = len(second.spelled)
        self.digits = max(len(str(len(e.spelled))) for e in self.encoders)

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids and lengths, and the number of bytes of each text that both spell (0 for the others)."""
        spaced = [" " + t if t else "" for t in texts]
        raw = [t.encode("utf-8", "replace") for t in spaced]
        ids = [e.encode(spaced) for e in self.encoders]
        flat = [np.array([i for own in side for i in own], np.int64) for side in ids]
        n = [np.array([len(own) for own in side], np.int64) for side in ids]
        spelled = [_spell(f, t) for f, t in zip(flat, self.tables)]
        good = np.ones(len(texts), bool)
        for (letters, lengths), count in zip(spelled, n):
            end = np.r_[0, np.cumsum(lengths)][np.cumsum(count)]
            whole = letters.tobytes()
            good &= np.array([whole[a:z] == r for a, z, r in zip(np.r_[0, end[:-1]].tolist(), end.tolist(), raw)], bool)
        keep = [np.repeat(good, count) for count in n]
        return [f[k] for f, k in zip(flat, keep)], [s[1][k] for s, k in zip(spelled, keep)], np.where(good, [len(r) for r in raw], 0)

    def __call__(self, texts: list[str | None]) -> dict[str, pa.Array]:
        (a, b), lengths, size = self.tokens(texts)
        row_end = np.cumsum(size)
        # who owns each byte
        owner_a, owner_b = (np.repeat(np.arange(len(n), dtype=np.int32), n) for n in lengths)
        new_a, new_b = (np.r_[True, o[1:] != o[:-1]] if len(o) else np.zeros(0, bool) for o in (owner_a, owner_b))
        link = np.flatnonzero(new_a | new_b)
        cut = np.flatnonzero(new_a & new_b)  # a group begins; so does every text
        row_of = lambda at: np.searchsorted(row_end, at, "right")
        count = lambda at: np.bincount(row_of(at), minlength=len(texts)).astype(np.int32)

        pair = a[owner_a[link]] * self.n_second + b[owner_b[link]]
        bits = int(len(self.encoders[0].spelled) * self.n_second).bit_length()
        distinct, times = np.unique(row_of(link).astype(np.int64) << bits | pair, return_counts=True)
        offsets = pa.array(np.searchsorted(distinct >> bits, np.arange(len(texts) + 1)).astype(np.int32))

        # the groups as text: tokens by group, A before B
        begin_a, begin_b = np.flatnonzero(new_a), np.flatnonzero(new_b)
        group = np.r_[np.searchsorted(cut, begin_a, "right"), np.searchsorted(cut, begin_b, "right")]
        order = np.argsort(2 * group + np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)], kind="stable")
        group, side, ids = group[order], order >= len(a), np.r_[a, b][order]
        after = np.full(len(ids), ord(","), np.uint8)
        if len(ids):
            after[:-1][~side[:-1] & side[1:]] = ord("|")
            after[:-1][group[1:] != group[:-1]] = ord(";")
        written, width = _written(ids, after, self.digits)
        begin = np.r_[begin_a, begin_b][order]
        end = np.r_[0, np.cumsum(width)][np.searchsorted(row_of(begin), np.arange(len(texts)), "right")]
        whole = written.tobytes().decode("ascii")
        groups = [whole[x : max(x, z - 1)] for x, z in zip(np.r_[0, end[:-1]].tolist(), end.tolist())]
        return {
            "n_a": pa.array(count(begin_a)),
            "n_b": pa.array(count(begin_b)),
            "n_groups": pa.array(count(cut)),
            "groups": pa.array(groups, pa.string()),
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(distinct & ((1 << bits) - 1))),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
        }


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(first: str, second: str) -> Aligner:
    """This task's aligner of two files that the driver has sent to the executors."""
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(ByteLevel(SparkFiles.get(first)), Pieces(SparkFiles.get(second)))
    return _aligners[first, second]


_sent: set[tuple[str, str]] = set()


def _send(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to the executors, once for an application; its name there."""
    sc = spark.sparkContext
    if (sc.applicationId, path) not in _sent:
        sc.addFile(path)
        _sent.add((sc.applicationId, path))
    return Path(path).name


OWN = ("n_a", "n_b", "n_groups", "groups", "pairs", "times")


def align(docs: DataFrame, text_col: str = "text", byte_level: str = f"{TOKENIZERS}/{BYTE_LEVEL}", pieces: str = f"{TOKENIZERS}/{PIECES}") -> DataFrame:
    """Every column of ``docs`` and

    ``n_a``, ``n_b``, ``n_groups``; ``groups``: the ids as 'a1,a2|b1;a3|b2,b3', a group after the other;
    ``pairs``: the distinct linked pairs as (id of A) * (ids of B) + (id of B); ``times``: the links of each.
    """
    spark = docs.sparkSession
    first, second = _send(spark, byte_level), _send(spark, pieces)
    columns = [c for c in docs.columns if c.lower() not in OWN]
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in columns if c != text_col)).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text", 1 << 19):
            texts = [t.decode("utf-8", "replace") for t in _text.texts(b.column(1))]
            made = _aligner(first, second)(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made.values()], names=["r", "text", *made])

    zero, none = F.lit(0), F.array().cast("array<bigint>")
    kind = rows.select("r", "text", zero.alias("n_a"), zero.alias("n_b"), zero.alias("n_groups"), F.lit("").alias("groups"), none.alias("pairs"), F.array().cast("array<int>").alias("times")).schema
    done = arrow(rows, run, kind)
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col(f"r.`{c}`") for c in columns), *OWN)


def pair_counts(aligned: DataFrame, n_second: int) -> DataFrame:
    """(pair, n, best): how many rows hold the pair, and whether none of its A id is held by more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    most = counts.groupBy(F.expr(f"pair div {n_second}").alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", F.expr(f"pair div {n_second}")).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh(aligned: DataFrame, pieces: str = f"{TOKENIZERS}/{PIECES}", most_broadcast: int = MOST_BROADCAST, salt: int = SALT) -> DataFrame:
    """Rows of ``align``, the arrays of pairs replaced by ``n_links``, ``n_best`` and ``count_sum``, from the pairs' counts over all rows."""
    scratch = Scratch(aligned.sparkSession, "alignment")
    names = [_text.free_name("row", aligned.columns), *(c for c in aligned.columns if c not in ("pairs", "times", "n_links", "n_best", "count_sum"))]
    row = names[0]
    # written, so that texts are encoded once and the rows' numbers are fixed
    aligned = scratch.keep(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = scratch.keep(pair_counts(aligned, len(Pieces(pieces).spelled)), "counts")
    links = F.aggregate("times", F.lit(0).cast("long"), lambda s, x: s + x).alias("n_links")
    base = aligned.select(*(F.col(f"`{c}`") for c in names), links)
    if counts.count() <= most_broadcast:
        sums = _by_broadcast(aligned.select(F.col(row).alias("row"), "pairs", "times"), counts)
    else:
        sums = _by_join(aligned.select(F.col(row).alias("row"), "pairs", "times"), counts, salt)
    sums = scratch.keep(sums, "sums")
    scratch.drop("counts")
    done = base.join(sums.withColumnRenamed("row", row), row, "left")
    return done.select(*(F.col(f"`{c}`") for c in names[1:]), "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"))


def _by_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.toArrow().sort_by("pair")
    held = rows.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = held.value
        for b in batches:
            at = np.searchsorted(pair, b.column(1).flatten().to_numpy())
            times = b.column(2).flatten().to_numpy().astype(np.int64)
            end = np.cumsum(b.column(1).value_lengths().to_numpy().astype(np.int64))
            sums = [np.diff(np.r_[0, np.cumsum(times * of[at])][np.r_[0, end]]) for of in (best, n)]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, sums)], names=["row", "n_best", "count_sum"])

    return arrow(rows, run, "row bigint, n_best bigint, count_sum bigint")


def _by_join(rows: DataFrame, counts: DataFrame, salt: int) -> DataFrame:
    each = rows.select("row", F.pmod(F.xxhash64("row"), F.lit(salt)).alias("salt"), F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "salt", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    spread = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    joined = each.join(spread.hint("merge"), ["pair", "salt"])
    return joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
