"""Spelling variants: words within one edit of each other, by merging light subtrees of an errata trie.

The trie of the words is a table of steps: for every word and depth, the hash of
the prefix there and the next character (none at the word's end).  Of a
branching prefix, the child with most words below it is the heavy one; all other
children are light, and a word is below at most log2(words) light children
(heavy-path decomposition).  Only words below light children move, small to
large, with the character at the branching depth

* skipped: where that gives another word, the two differ by one deletion,
* replaced by the heavy child's character: that word differs by one replacement,
* preceded by the heavy child's character: that word differs by one insertion,
* replaced by a wildcard: words of light children that coincide then differ by
  one replacement.

Two words within one edit part at exactly one prefix, so that each pair is
found exactly once (a character is not skipped before an equal one: that pair
parts further on).  Prefix hashes only choose which child is called heavy: two
prefixes of one hash would cost work, never a pair.

The words and their steps are shuffled by prefix, moved words by what they have
become; no task holds a subtree, and a wildcard's group has a word for each
character of the alphabet at most.  A word's variants are reduced to a count and
the best one before they are shuffled by word.  A prefix that all words share
(the root) is a hot key of a join of two exchanges, which adaptive execution
splits.

Defined results: a null or empty text has no words; repeated rows count each; a
null id hashes nothing, so its runs stay as they are; an empty table gives an
empty result; words may have any length; equal counts go to the word first in
code-point order; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow

LEAST_LENGTH, LEAST_COUNT, TIMES, DAMAGE = 7, 2, 10, 31
#: A-Z, a-z and U+00C0 to U+00FF
LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _cut(word: Column, at: Column, put: Column, skip: int) -> Column:
    """``word`` with ``skip`` characters from the 0-based place ``at`` replaced by ``put``."""
    return F.concat(F.substring(word, F.lit(1), at), put, F.substring(word, at + 1 + skip, F.length(word)))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased, each with one character deleted where ``damage`` divides crc32('id:run')."""
    text = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    # shorter runs cannot become a word
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("run"))
    run, h = F.col("run"), F.crc32(F.concat("id", F.lit(":"), "run"))
    word = F.when(h % damage == 0, _cut(run, (h % F.length("run")).cast("int"), F.lit(""), 1)).otherwise(run)
    return runs.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _steps(words: DataFrame) -> DataFrame:
    """(id, depth, prefix, next) of every word and every depth from 0 to its length; ``next`` is empty at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "word", 1 << 18):
            points = [np.append(np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32), np.uint32(0)) for w in b.column(1).to_pylist()]
            size = np.array([len(p) for p in points])
            first = np.cumsum(size) - size
            flat = np.concatenate(points)
            depth = np.arange(len(flat)) - np.repeat(first, size)
            summed = np.cumsum(_text.mix(flat.astype(np.uint64) * _text.MULT) * _text.powers(int(size.max()))[depth])
            before = np.r_[np.uint64(0), summed[:-1]]
            prefix = _text.mix(before - np.repeat(before[first], size) + depth.astype(np.uint64) * _text.MULT)
            kinds, at = np.unique(flat, return_inverse=True)
            following = pa.DictionaryArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(["" if k == 0 else chr(k) for k in kinds.tolist()])).cast(pa.string())
            ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), size)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(depth.astype(np.int32)), pa.array(prefix.view(np.int64)), following], names=["id", "depth", "prefix", "next"])

    return arrow(words.select("id", "word"), run, "id bigint, depth int, prefix bigint, next string")


def _near(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, n_near, best): how many words are one edit away, and the one of largest count as (-n, word)."""
    children = _steps(words).groupBy("prefix", "next").agg(F.count("*").alias("size"))
    heavy = children.groupBy("prefix").agg(F.max(F.struct("size", "next")).alias("top"), F.count("*").alias("children")).where("children > 1")
    # written, so that the join reads two exchanges and adaptive execution can split the root
    heavy = scratch.keep(heavy.select("prefix", F.col("top.next").alias("heavy")), "heavy")
    light = _steps(words).join(heavy, "prefix").where("next <> heavy").select("id", "depth", "next", "heavy")
    light = scratch.keep(light, "light").join(words, "id")

    word, at, inside, below = F.col("word"), F.col("depth"), F.col("next") != "", F.col("heavy") != ""
    moved = F.array(
        F.when(inside & (F.substring(word, at + 2, F.lit(1)) != F.col("next")), F.struct(F.lit(False).alias("wild"), _cut(word, at, F.lit(""), 1).alias("key"))),
        F.when(inside & below, F.struct(F.lit(False).alias("wild"), _cut(word, at, F.col("heavy"), 1).alias("key"))),
        F.when(below, F.struct(F.lit(False).alias("wild"), _cut(word, at, F.col("heavy"), 0).alias("key"))),
        F.when(inside, F.struct(F.lit(True).alias("wild"), _cut(word, at, F.lit("\u0000"), 1).alias("key"))),
    )
    moved = scratch.keep(light.select("id", "word", "n", F.explode(F.filter(moved, lambda m: m.isNotNull())).alias("m")).select("id", "word", "n", "m.*"), "moved")

    met = moved.where("not wild").alias("x").join(words.alias("y"), F.col("x.key") == F.col("y.word"))
    side = lambda a, b: F.struct(F.col(f"{a}.id").alias("id"), F.lit(1).cast("long").alias("n_near"), F.struct((-F.col(f"{b}.n")).alias("n"), F.col(f"{b}.word").alias("word")).alias("best"))
    pairs = met.select(F.explode(F.array(side("x", "y"), side("y", "x"))).alias("s")).select("s.*")

    # one word a character at most
    groups = moved.where("wild").groupBy("key").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "word", "id"))).alias("own")).where(F.size("own") > 1)
    each = groups.select((F.size("own") - 1).cast("long").alias("n_near"), F.posexplode("own").alias("at", "x"), F.col("own")[0].alias("first"), F.col("own")[1].alias("second"))
    other = F.when(F.col("at") == 0, F.col("second")).otherwise(F.col("first"))
    grouped = each.select(F.col("x.id").alias("id"), "n_near", F.struct(other["n"].alias("n"), other["word"].alias("word")).alias("best"))
    return pairs.unionByName(grouped).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    ``form``: the one-edit neighbour of largest count, if that is ``times`` the
    word's at least; ``root``: where the forms of forms end.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.keep(words.select("word", "n", F.monotonically_increasing_id().alias("id")), "words")  # once written, the numbers are fixed
    near = _near(words, scratch)
    is_form = -F.col("best.n") >= times * F.col("n")
    found = words.join(near, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"))
    found = scratch.keep(found, "forms")
    scratch.drop("heavy", "light", "moved")

    # counts grow with every form, so that chains end; each round doubles what a root has jumped
    roots = scratch.keep(found.where("form is not null").select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        step += 1
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = scratch.keep(roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{step}")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    done = found.join(roots.select("word", "root"), "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
