"""Near-duplicate groups: inverted join over the coordinates of MinHash signatures.

A document's set is its distinct word shingles.  Equal sets are one
representative from the start, so exact copies never meet in a join.  Every
representative is posted under each (coordinate, value) pair of its signature.
Two sets at the wanted similarity agree in at least ``t`` of the H coordinates
but for a chance of ``miss``; so

* a representative with fewer than ``t`` values that anybody else has leaves,
* of the rest, each keeps its rarest (values - t + 1) postings: by the pigeonhole
  principle two that agree t times meet in these prefixes, and only the short
  lists are merged,
* the long lists are skipped: how often a pair that has met collides in all
  coordinates is counted from its two signatures, and pairs under ``t`` go,
* in each posting list all members first meet only the list's most central
  member (a star); confirmed links are merged into components,
* then only pairs of *different* components in a list meet; members that are
  already connected are skipped, and so are those whose sizes are too far apart
  (a list is dealt by classes of size).  A parity bitmap (a lower bound of
  the symmetric difference) filters inside the join, so a hot list of m near
  copies never emits its m*m pairs.

What is left above the count is confirmed on the full sets.  Nothing is capped:
a hot list is dealt in blocks, and every pair of different components that meets
is decided.  The worst case is a list of m members of one size that all
share t values and yet are no links: its pairs are compared, m/BLOCK rows each.

Defined results: null or empty texts, and texts without a word, have an empty
set, are their own component and kept; a text with fewer words than a shingle
is one shingle as a whole; repeated rows share a component and each gets a row;
rows with one id and different texts are sets each, so that their id is in two
components if these are not linked; a row with a null id links with nothing and
is kept with a null component; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import _text
from quarry.llm._scratch import Scratch, arrow
from quarry.llm.components import components

COORDINATES = 64
WORDS = 16  # 64-bit words of the parity bitmap
BLOCK = 512  # members of a posting list that are dealt together


def least_matches(similarity: float, coordinates: int = COORDINATES, miss: float = 1e-7) -> int:
    """The most agreements t such that a pair at ``similarity`` has fewer with a chance of ``miss`` at most."""
    tail, t = 0.0, 0
    while t < coordinates:
        tail += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if tail > miss:
            return max(1, t)
        t += 1
    return coordinates


def shingle_sets(raw: np.ndarray, off: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a buffer."""
    starts, ends = _text.word_spans(raw, off)
    words = _text.word_hashes(raw, starts, ends)
    first = np.searchsorted(starts, off)
    odd = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(shingle)]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n == 0:
            yield np.zeros(0, np.uint64)
        else:
            k = min(shingle, n)
            total = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                total += words[a + j : b - k + 1 + j] * odd[j]
            yield np.unique(_text.mix(total + np.uint64(k)))


_seeds = _text.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _text.MULT) | np.uint64(1)


def signature(s: np.ndarray) -> np.ndarray:
    """One key per coordinate: its number in the upper 6 bits, its least value below."""
    low = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(s), 2048):
        h = s[k : k + 2048, None] * _seeds[None, :]
        h ^= h >> np.uint64(29)
        h *= _text.MIX1
        np.minimum(low, h.min(0), out=low)
    return (low >> np.uint64(6)) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58))


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = s.sum(dtype=np.uint64), _text.mix(s * _text.MIX2).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _parity(s: np.ndarray) -> np.ndarray:
    odd = np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _source(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)


def _signatures(source: DataFrame, shingle: int, carry: tuple[str, ...] = ()) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text"):
            raw, off = _text.buffers(b.column(1))
            sizes, one, two, keys = [], [], [], []
            for s in shingle_sets(raw, off, shingle):
                h = _set_hash(s)
                sizes.append(len(s)), one.append(h[0]), two.append(h[1])
                keys.append(signature(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *b.columns[2:]], names=["doc_id", "n", "h1", "h2", "keys", *carry])

    return arrow(source, run, "doc_id bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>" + "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in carry))


def _sets(source: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _text.slices(batches, "text", 1 << 20):
            raw, off = _text.buffers(b.column(1))
            one, two, sets, bits = [], [], [], []
            for s in shingle_sets(raw, off, shingle):
                h = _set_hash(s)
                one.append(h[0]), two.append(h[1]), sets.append(s.view(np.int64)), bits.append(_parity(s))
            words = np.array(bits).reshape(-1, WORDS)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sets, pa.list_(pa.int64())), *(pa.array(words[:, k]) for k in range(WORDS))], names=["h1", "h2", "members", *(f"w{k}" for k in range(WORDS))])

    return arrow(source, run, "h1 bigint, h2 bigint, members array<bigint>, " + ", ".join(f"w{k} bigint" for k in range(WORDS)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; linked: 100 * intersection >= percent * union."""
    rows = components_of(docs, id_col, text_col, shingle, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: of those with the least id, the least by the hash of the text; of equal ones, one.

    A null id counts as the largest.  Rows with an empty set all stay.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(f"`{text_col}`").cast("string")
    key = [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1)).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"), F.xxhash64(F.lit(1), F.coalesce(text, F.lit(""))).alias("k2")]
    scratch = Scratch(docs.sparkSession, "unique")
    found = scratch.keep(components_of(docs.select(*key, text.alias("text")), "id", "text", shingle, percent, carry=("k1", "k2")).where("n > 0"), "components")
    # both written, so that the join below reads two exchanges and adaptive execution can split a large group
    first = scratch.keep(found.groupBy("group").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("first")), "first")
    rows = scratch.keep(found.groupBy("group", F.col("doc_id").alias("id"), "k1", "k2").agg(F.count("*").alias("n")), "rows")
    state = rows.join(first, "group").select("id", "k1", "k2", (F.struct("id", "k1", "k2") != F.struct("first.*")).alias("gone"), (F.col("n") > 1).alias("several")).where("gone or several")
    marked = docs.select(F.struct(*columns).alias("r"), *key).join(state, ["id", "k1", "k2"], "left")
    one = marked.where("several and not gone").dropDuplicates(["id", "k1", "k2"]).select("r")
    return marked.where("gone is null").select("r").unionByName(one).select(*(F.col(f"r.`{c}`") for c in docs.columns))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n, h1, h2, group, component) of every row and its columns ``carry``.

    (h1, h2) names its set, ``group`` (null for an empty set) what it is linked with; ids that repeat can make two groups one ``component``.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    source, t = _source(docs, id_col, text_col), least_matches(percent / 100)
    signed = scratch.keep(_signatures(_source(docs, id_col, text_col, carry), shingle, carry), "signatures")
    reps = signed.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    reps = scratch.keep(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")  # once written, the numbers are fixed

    posted = reps.select("rep", F.explode("keys").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    own = posted.join(shared, "key").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("c", "key"))).alias("found")).where(F.size("found") >= t)
    own = own.select("rep", F.aggregate("found", F.lit(0).cast("bigint"), lambda s, x: s + x["c"]).alias("weight"), F.expr(f"slice(found, 1, size(found) - {t - 1}).key").alias("prefix"))
    prefix = scratch.keep(own.select("rep", "weight", F.explode("prefix").alias("key")), "prefixes")

    lists = prefix.groupBy("key").agg(F.count("*").alias("c"), F.max(F.struct("weight", (-F.col("rep")).alias("r"))).alias("top")).where("c > 1").select("key", (-F.col("top.r")).alias("centre"))
    star = prefix.join(lists, "key").where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    star = scratch.keep(star, "star")

    asked = star.select(F.col("a").alias("rep")).unionByName(star.select(F.col("b").alias("rep"))).distinct()
    asked = reps.join(asked, "rep").select("rep", "n", "h1", "h2", "doc_id", "keys")
    near = source.join(asked.select("doc_id"), "doc_id", "left_semi")
    full = _sets(near, shingle).join(asked.drop("doc_id"), ["h1", "h2"]).drop("h1", "h2").dropDuplicates(["rep"])
    full = scratch.keep(full, "sets")

    confirmed = scratch.keep(_confirm(star, full, percent, t), "links-1")
    scratch.drop("star")
    joined = components(scratch, confirmed, "first")
    # what is left: pairs of different components in one posting list
    member = prefix.join(lists.select("key"), "key").join(full.drop("members", "keys"), "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    # sets of two neighbouring classes of size, or of one, may be links; others are too far apart (a class is a trifle wider than the bound)
    width = max(-math.log(percent / 100), 1e-6) * (1 + 1e-9)
    member = scratch.keep(member.withColumn("component", F.coalesce("component", "rep")).withColumn("class", F.floor(F.log("n") / width).cast("int")), "members")
    scratch.drop("prefixes")
    open_lists = member.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    member = member.join(open_lists, "key", "left_semi")
    blocks = member.groupBy("key", "class").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    left = member.join(blocks, ["key", "class"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    right = member.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") - 1))).join(blocks, ["key", "class"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    far = sum((F.bit_count(F.col(f"x.w{k}").bitwiseXOR(F.col(f"y.w{k}"))) for k in range(1, WORDS)), F.bit_count(F.col("x.w0").bitwiseXOR(F.col("y.w0"))))
    most = F.col("x.n") + F.col("y.n")
    meets = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") == F.col("y.class")) & (F.col("x.block") == F.col("y.block")) & ((F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.rep") < F.col("y.rep"))) & (F.col("x.component") != F.col("y.component"))
    # |A xor B| <= (100 - p) / (100 + p) * (|A| + |B|) for every link
    meets = meets & (100 * F.col("x.n") >= percent * F.col("y.n")) & ((100 + percent) * far <= (100 - percent) * most)
    rest = left.alias("x").join(right.alias("y"), meets).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    later = scratch.keep(_confirm(rest, full, percent, t), "links-2")
    if not later.isEmpty():
        edges = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(later)
        joined = components(scratch, edges, "second")

    group = reps.select("h1", "h2", "doc_id", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("h1", "h2", "doc_id", F.coalesce("component", "rep").alias("group"))
    group = scratch.keep(group, "groups")  # both written, so that the join below reads two exchanges and can split a large group
    least = scratch.keep(group.groupBy("group").agg(F.min("doc_id").alias("component")), "least")
    group = group.drop("doc_id").join(least, "group")
    alone = signed.where("n = 0 or doc_id is null").select("doc_id", "n", "h1", "h2", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component"), *carry)
    scratch.drop("sets", "members", "links-1", "links-2")
    return signed.where("n > 0 and doc_id is not null").join(group, ["h1", "h2"]).select("doc_id", "n", "h1", "h2", "group", "component", *carry).unionByName(alone)


def _confirm(pairs: DataFrame, full: DataFrame, percent: int, t: int) -> DataFrame:
    """The pairs that collide in ``t`` coordinates and are links on their full sets."""
    side = lambda x: full.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("keys").alias(f"k{x}"), F.col("members").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    both = both.where(F.size(F.array_intersect("ka", "kb")) >= t).withColumn("same", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("same") >= percent * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b")
