"""Exact top-k inner-product search with a ball tree per shard.

Vectors are quantised to integers.  Every shard of the candidates is one ball
tree: nodes hold the mean of their members and the radius around it, so
<q, centre> + |q| * radius bounds every score below a node.  A query keeps a
frontier of nodes, opens the one of largest bound next (its children are bounded
only then), and stops when that bound is under its current kth score.

Shards are cells of space, so that their balls are small: splits are fitted on a
sample of at most ``sample`` vectors, then every vector goes down them; a cell of
many vectors (one very common vector, say) is dealt into several shards by hash.
Each shard's tree is built once and written.  Of all trees only the roots travel
to the queries, in lists of at most ``roots`` of them.  In waves a query visits
its best shard, then the next ``second`` ones, then all that are left; before each
wave its kth score so far is shared with all shards, and a shard whose root's bound
is under it is not visited.  So what is shuffled is the pairs of a query and a shard
that survive, each once, and each tree once for every ``block`` queries that visit it.

Scores are integers, exact in float64 while below 2^53 (as are components after
scaling); the best k have ties to the smaller id.

Defined results: vectors that are null, empty or hold a null or a non-finite
component take no part, as queries or candidates; vectors of another length
than a query are no candidates of it; repeated ids are candidates each (a
query's own id never is); equal rows ask once, and the scores of different vectors of one
query id are ranked together; fewer than k candidates give all of them; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm._scratch import Scratch, arrow, ship

LEAF, BLOCK, SHARD_ROWS, SAMPLE, ROOTS, SECOND, BALLS = 256, 4096, 8192, 65536, 4096, 8, 16


def halves(x: np.ndarray) -> np.ndarray:
    """The order of the rows along the line through two far ones; half of them are on each side."""
    away = ((x - x.mean(0)) ** 2).sum(1)
    p = x[away.argmax()]
    q = x[((x - p) ** 2).sum(1).argmax()]
    return (x @ (q - p)).argsort(kind="stable")


class BallTree:
    """Nodes in preorder: centre, radius, the span of their rows and the child on the right (0: a leaf)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        self.centres, self.radii, self.spans, self.right = [], [], [], []
        x = x.astype(np.float64)
        stack = [(0, len(x), -1)]
        while stack:
            a, b, parent = stack.pop()
            me = len(self.radii)
            if parent >= 0:
                self.right[parent] = me
            own = x[self.order[a:b]]
            centre = own.mean(0)
            away = ((own - centre) ** 2).sum(1)
            self.centres.append(centre), self.radii.append(np.sqrt(away.max()) * (1 + 1e-12)), self.spans.append((a, b)), self.right.append(0)
            if b - a > leaf and away.max() > 0:
                self.order[a:b] = self.order[a:b][halves(own)]
                mid = (a + b) // 2
                stack.append((mid, b, me))
                stack.append((a, mid, -1))
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.x, self.ids = x[self.order], ids[self.order]

    def bound(self, q: np.ndarray, size: np.ndarray, node: int) -> np.ndarray:
        """What no score of ``q`` (of length ``size``) below the node exceeds."""
        return q @ self.centres[node] + size * self.radii[node] + 1e-6

    def cover(self, most: int) -> list[int]:
        """Nodes, ``most`` at the most, that hold every row once: the widest is opened first."""
        nodes = [0]
        while len(nodes) < most:
            wide = max((n for n in nodes if self.right[n]), key=lambda n: self.radii[n], default=None)
            if wide is None:
                break
            nodes.remove(wide)
            nodes += [wide + 1, self.right[wide]]
        return sorted(nodes)

    def search(self, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores), up to k per query (score -inf: none), of all candidates that may be among its best given a score to beat."""
        size = np.sqrt((q**2).sum(1))
        frontier = np.full((len(q), len(self.radii)), -np.inf)
        frontier[:, 0] = self.bound(q, size, 0)
        ids = np.full((len(q), k), np.iinfo(np.int64).max)
        scores = np.full((len(q), k), -np.inf)
        least = floor.astype(np.float64).copy()
        active = np.arange(len(q))
        while len(active):  # each query opens its best node, those at the same node together
            at = frontier[active].argmax(1)
            best = frontier[active, at]
            open_ = (best > -np.inf) & (best >= least[active])
            active, at, best = active[open_], at[open_], best[open_]
            for n in np.unique(at):
                who = active[at == n]
                above = best[at == n]
                frontier[who, n] = -np.inf
                if self.right[n]:
                    for child in (n + 1, self.right[n]):
                        b = np.minimum(self.bound(q[who], size[who], child), above)
                        frontier[who, child] = np.where(b >= least[who], b, -np.inf)
                    continue
                a, z = self.spans[n]
                s = q[who] @ self.x[a:z].T
                s[(self.ids[a:z][None, :] == own[who][:, None]) | (s < least[who][:, None])] = -np.inf
                some = (s > -np.inf).any(1)
                if some.any():
                    who = who[some]
                    all_s = np.concatenate([scores[who], s[some]], 1)
                    all_i = np.concatenate([ids[who], np.broadcast_to(self.ids[a:z], s[some].shape)], 1)
                    top = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                    scores[who], ids[who] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)
                    least[who] = np.maximum(least[who], scores[who, k - 1])
        return ids, scores


class Cells:
    """Binary splits of space, fitted on a sample: a row of (normal, threshold) each, children below."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.normals, self.thresholds, self.below = [], [], []
        self.n = 0
        self._split(sample, cells)

    def _split(self, x: np.ndarray, cells: int) -> int:
        """The node's number; a negative one is a cell."""
        if cells > 1 and len(x) > 1 and (x != x[0]).any():
            order = halves(x)
            mid = len(x) * (cells // 2) // cells or 1
            a, b = x[order[mid - 1]], x[order[mid]]
            far = x[order[-1]] - x[order[0]]
            if far @ a < far @ b:
                me = len(self.normals)
                self.normals.append(far), self.thresholds.append(far @ b), self.below.append([0, 0])
                self.below[me] = [self._split(x[x @ far < far @ b], cells // 2), self._split(x[x @ far >= far @ b], cells - cells // 2)]
                return me
        self.n += 1
        return -self.n

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        out = np.zeros(len(x), np.int64)
        stack = [(0 if self.normals else -1, np.arange(len(x)))]
        while stack:
            node, who = stack.pop()
            if node < 0:
                out[who] = -node - 1
            elif len(who):
                left = x[who] @ self.normals[node] < self.thresholds[node]
                stack += [(self.below[node][0], who[left]), (self.below[node][1], who[~left])]
        return out


def quantise(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    x = vector.cast("array<double>")
    bad = x.isNull() | (F.size(x) == 0) | F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("double")))


def _cells(rows: DataFrame, total: int, cells: int, sample: int) -> DataFrame:
    """``rows`` and the cell of each; vectors of each length have splits of their own."""
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().collect()]
    if cells > 1:
        h, share = F.crc32(F.col("id").cast("string")), 2.0**33 * sample / max(1, total)  # twice the share, so that few rows are sorted
        some = rows.where(h < share).orderBy(h, "id").limit(sample).select("v").toArrow().column("v").to_pylist()
    fitted = {}
    for size in sorted(lengths):
        own = [v for v in some if len(v) == size] if cells > 1 else []
        fitted[size] = (Cells(np.array(own or [[0.0] * size]), max(1, cells * len(own) // max(len(some), 1)) if own else 1), sum(c.n for c, _ in fitted.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, n = b.column(1), b.column(1).value_lengths().to_numpy()
            cell = np.zeros(len(n), np.int64)
            for size in np.unique(n):
                who = np.flatnonzero(n == size)
                splits, first = fitted[size]
                cell[who] = first + splits.of(v.take(pa.array(who)).flatten().to_numpy().reshape(-1, size))
            yield pa.RecordBatch.from_arrays([b.column(0), v, pa.array(cell)], names=["id", "v", "cell"])

    return arrow(rows.select("id", "v"), run, "id bigint, v array<double>, cell bigint")


def _trees(placed: DataFrame, shard_rows: int, balls: int) -> DataFrame:
    """(shard, size, centre, radius, tree): one row a shard; ``size``: of its vectors; centres and radii of ``balls`` inner nodes that cover it."""
    counts = placed.groupBy("cell").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    # by place in the written table as well, so that equal rows are dealt like others
    dealt = placed.withColumn("at", F.monotonically_increasing_id()).join(counts, "cell").withColumn("part", F.pmod(F.xxhash64("id", "v", "at"), F.col("parts"))).drop("at")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["v"].to_list())
        t = BallTree(x, group["id"].to_numpy())
        cell, part = int(group["cell"].iloc[0]), int(group["part"].iloc[0])
        nodes = t.cover(balls)
        return pd.DataFrame({"shard": [cell << 24 | part], "size": [x.shape[1]], "centre": [t.centres[nodes].ravel()], "radius": [t.radii[nodes]], "tree": [pickle.dumps(t, protocol=5)]})

    return dealt.groupBy("cell", "part").applyInPandas(build, "shard bigint, size int, centre array<double>, radius array<double>, tree binary")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shard_rows: int = SHARD_ROWS, block: int = BLOCK, sample: int = SAMPLE, roots: int = ROOTS, second: int = SECOND, balls: int = BALLS) -> DataFrame:
    """(query_id, rank, vec_id, score); ``queries``: condition that picks the query rows."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = scratch.keep(rows.where("id is not null and v is not null"), "vectors")
    n = rows.count()
    placed = scratch.keep(_cells(rows, n, max(1, -(-2 * n // shard_rows)), sample), "placed")
    trees = scratch.keep(_trees(placed, shard_rows, balls), "trees")
    scratch.drop("placed")
    asked = rows.where("asks").select(F.col("id").alias("query"), F.col("v").alias("q")).distinct().withColumn("no", F.monotonically_increasing_id())
    asked = scratch.keep(asked.withColumn("floor", F.lit(float("-inf"))), "queries")

    def bounded(state: DataFrame, most: int | None) -> DataFrame:
        """(no, shard, bound) of the shards that may still hold one of a query's best: of all, or the ``most`` best of each list of roots."""
        out = None
        for part in _root_lists(trees, roots):
            # each list is one pass over the queries
            def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    v, lengths = b.column(1), b.column(1).value_lengths().to_numpy()
                    no, floor = b.column(0).to_numpy(), b.column(2).to_numpy()
                    for d, (shard, first, centre, radius) in part.items():
                        own = np.flatnonzero(lengths == d)
                        for who in np.array_split(own, max(1, len(own) * len(radius) >> 20)):
                            if not len(who):
                                continue
                            q = v.take(pa.array(who)).flatten().to_numpy().reshape(-1, d)
                            inner = q @ centre.T + np.sqrt((q**2).sum(1))[:, None] * radius + 1e-6
                            bound = np.maximum.reduceat(inner, first, axis=1)
                            if most is not None and most < len(shard):
                                j = np.argpartition(-bound, most - 1, axis=1)[:, :most].ravel()
                                i = np.repeat(np.arange(len(who)), most)
                                i, j = (x[bound[i, j] >= floor[who[i]]] for x in (i, j))
                            else:
                                i, j = np.nonzero(bound >= floor[who][:, None])
                            yield pa.RecordBatch.from_arrays([pa.array(no[who[i]]), pa.array(shard[j]), pa.array(bound[i, j])], names=["no", "shard", "bound"])

            found = arrow(state.select("no", "q", "floor"), run, "no bigint, shard bigint, bound double")
            out = found if out is None else out.unionByName(found)
        return out if out is not None else spark.createDataFrame([], "no bigint, shard bigint, bound double")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(left) and len(right):
            tree = pickle.loads(left["tree"].iloc[0])
            for a in range(0, len(right), 1024):
                some = right.iloc[a : a + 1024]
                ids, scores = tree.search(np.stack(some["q"].to_list()), some["query"].to_numpy(), k, some["floor"].to_numpy())
                at, j = np.nonzero(scores > -np.inf)
                parts.append(pd.DataFrame({"no": some["no"].to_numpy()[at], "query": some["query"].to_numpy()[at], "id": ids[at, j], "score": scores[at, j].astype(np.int64)}))
        return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("no", "query", "id", "score")})

    def wave(name: str, state: DataFrame, pairs: DataFrame) -> DataFrame:
        pairs = scratch.keep(pairs, f"pairs-{name}")
        need = pairs.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        left = trees.select("shard", "tree").join(need, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree")
        right = state.join(pairs, "no").join(need, "shard").select("shard", F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int").alias("block"), "no", "query", "q", "floor")
        visits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
        return scratch.keep(visits.applyInPandas(run, "no bigint, query bigint, id bigint, score bigint"), f"found-{name}")

    # the best shard; the next ones; all others whose bound still reaches the kth score
    state, found, visited = asked, None, None
    for name, upto in (("best", 1), ("next", second), ("rest", None)):
        # the one that was visited may be among the best
        open_ = bounded(state, None if upto is None else upto + (visited is not None))
        if visited is not None:
            open_ = open_.join(visited, ["no", "shard"], "left_anti")
        if upto is not None:
            open_ = open_.withColumn("rank", F.row_number().over(W.partitionBy("no").orderBy(F.desc("bound"), "shard"))).where(F.col("rank") <= upto)
        new = wave(name, state, open_.select("no", "shard"))
        found = new if found is None else found.unionByName(new)
        if upto is not None:
            own = spark.read.parquet(scratch.paths[f"pairs-{name}"])
            visited = own if visited is None else visited.unionByName(own)
            state = scratch.keep(asked.drop("floor").join(kth(found, k), "no", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), f"queries-{name}")
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def _root_lists(trees: DataFrame, most: int) -> Iterator[dict[int, tuple[np.ndarray, ...]]]:
    """By length of the vectors, (shard, first ball of each, centres, radii) of the trees, at most ``most`` shards at a time."""
    held: list = []
    for r in trees.select("shard", "size", "centre", "radius").toLocalIterator():
        held.append(r)
        if len(held) == most:
            yield _as_arrays(held)
            held = []
    if held:
        yield _as_arrays(held)


def _as_arrays(rows: list) -> dict[int, tuple[np.ndarray, ...]]:
    out = {}
    for d in sorted({r["size"] for r in rows}):
        own = [r for r in rows if r["size"] == d]
        n = np.array([len(r["radius"]) for r in own])
        out[d] = (np.array([r["shard"] for r in own]), np.cumsum(n) - n, np.concatenate([np.array(r["centre"]).reshape(-1, d) for r in own]), np.concatenate([np.array(r["radius"]) for r in own]))
    return out


def kth(found: DataFrame, k: int) -> DataFrame:
    """(no, floor): the kth score so far of each query, where k were found."""
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("no").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") == k).select("no", F.col("score").cast("double").alias("floor"))
