"""Approximate nearest neighbours by a hierarchical k-means tree (operator 10).

The tree is fitted on a bounded sample (at most SAMPLE_MOST vectors) and broadcast;
every row is put into the leaf it descends to. A query walks the tree best bin
first: a priority queue of nodes by distance to their centres, whose nearest is
taken next, gives the leaves in the order to visit. How many it visits is
calibrated: for CALIBRATION queries the true neighbours are found by brute force,
distributed, and the visits are widened until TARGET of them lie in visited leaves.
Neighbouring leaves share a bucket of bounded size. A query goes to each bucket that
has leaves to visit, once, with the list of them; the bucket returns its nearest by
exact distance in double precision, and the buckets' results are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut

#: Neighbours; recall to reach on the calibration queries; their number.
K, TARGET, CALIBRATION = 10, 0.94, 200
#: Vectors of the sample (one in SAMPLE_SHARE of all, within bounds), children of a
#: node, most sample vectors of a leaf, rounds of k-means.
SAMPLE_LEAST, SAMPLE_MOST, SAMPLE_SHARE, BRANCH, LEAF, ROUNDS = 20_000, 500_000, 20, 16, 40, 8
#: Vectors that one bucket of neighbouring leaves holds; a larger leaf is split.
BUCKET = 4096


@dataclass
class Tree:
    """centres: one row a node; children: node -> its children, none for a leaf;
    leaf: node -> number of the leaf, -1 for inner nodes."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def descend(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the child with the nearest centre at every node."""
        out = np.empty(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = self.children[node]
            nearest = _nearest(vectors[rows], self.centres[below])
            todo += [(int(c), rows[nearest == i]) for i, c in enumerate(below)]
        return out

    def visits(self, vector: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            below = self.children[node]
            for d, c in zip(((self.centres[below] - vector) ** 2).sum(axis=1).tolist(), below.tolist(), strict=True):
                heapq.heappush(queue, (d, c))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * (vectors @ centres.T)).argmin(axis=1)


def grow(sample: np.ndarray, seed: int = 0) -> Tree:
    """Hierarchical k-means over the distinct vectors of a sample."""
    rng = np.random.default_rng(seed)
    points = np.unique(sample, axis=0)
    centres, children, leaf, n_leaves = [points.mean(axis=0)], [np.zeros(0, dtype=np.int64)], [-1], 0
    todo = [(0, points)]
    while todo:
        node, own = todo.pop()
        if len(own) <= LEAF:
            leaf[node], n_leaves = n_leaves, n_leaves + 1
            continue
        means = own[rng.choice(len(own), BRANCH, replace=False)]
        for _ in range(ROUNDS):
            nearest = _nearest(own, means)
            sums = np.zeros_like(means)
            np.add.at(sums, nearest, own)
            sizes = np.bincount(nearest, minlength=BRANCH)
            means = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], means)
        nearest = _nearest(own, means)
        used = np.unique(nearest)
        if len(used) == 1:
            leaf[node], n_leaves = n_leaves, n_leaves + 1
            continue
        children[node] = np.arange(len(centres), len(centres) + len(used))
        for k in used:
            todo.append((len(centres), own[nearest == k]))
            centres.append(means[k])
            children.append(np.zeros(0, dtype=np.int64))
            leaf.append(-1)
    return Tree(np.array(centres), children, np.array(leaf))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec array<double>) of the vectors that take part: not null, not zero,
    without null or non-finite components, and of the most frequent length (the
    smallest such, if several)."""
    vec = F.col(vector_col).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    length = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.filter(F.size("vec") == (length["n"] if length else 0))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    """Equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _best(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest but `own`, ties to the smaller id."""
    apart = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        limit = np.partition(apart[at], k - 1)[k - 1]
        at = at[apart[at] <= limit]
    at = at[np.lexsort((ids[at], apart[at]))][:k]
    return ids[at], apart[at]


def _true_leaves(indexed: DataFrame, queries: list, k: int) -> dict[int, list[int]]:
    """Per calibration query the leaves of its true neighbours, by brute force over all rows."""
    shared = indexed.sparkSession.sparkContext.broadcast([(r["vec_id"], np.array(r["vec"])) for r in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)) for q, _ in shared.value}
        for batch in batches:
            ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            vectors = _matrix(batch.column("vec"), len(ids))
            for q, x in shared.value:
                apart = np.sqrt(((vectors - x) ** 2).sum(axis=1))
                at = np.flatnonzero(ids != q)
                if len(at) > k:
                    at = at[apart[at] <= np.partition(apart[at], k - 1)[k - 1]]
                found = tuple(np.concatenate(p) for p in zip(best[q], (ids[at], apart[at], leaf[at]), strict=True))
                order = np.lexsort((found[0], found[1]))[:k]
                best[q] = tuple(x[order] for x in found)
        for q, (ids, apart, leaf) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([q] * len(ids), pa.int64()), pa.array(ids), pa.array(apart), pa.array(leaf)],
                                             names=["query_id", "vec_id", "score", "leaf"])

    nearest = indexed.select("vec_id", "vec", "leaf").mapInArrow(run, "query_id long, vec_id long, score double, leaf long")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out: dict[int, list[int]] = {}
    for r in nearest.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).collect():  # CALIBRATION * k rows
        out.setdefault(r["query_id"], []).append(r["leaf"])
    return out


def calibrated_visits(tree: Tree, queries: list, true_leaves: dict[int, list[int]], target: float) -> int:
    """Leaves to visit, widened until `target` of the true neighbours are reached."""
    orders = {r["vec_id"]: {leaf: i for i, leaf in enumerate(tree.visits(np.array(r["vec"])))} for r in queries if r["vec_id"] in true_leaves}
    ranks = np.array([orders[q][leaf] for q, leaves in true_leaves.items() if q in orders for leaf in leaves])
    visits = 1
    while len(ranks) and (ranks < visits).mean() < target:
        visits += 1
    return visits


def _buckets(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf its first bucket and the number of buckets it is spread over: leaves in
    order of their numbers share one up to BUCKET vectors, larger ones have their own."""
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    at, filled = 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if filled and filled + size > BUCKET:
            at, filled = at + 1, 0
        first[leaf], parts[leaf] = at, max(1, -(-size // BUCKET))
        if size > BUCKET:
            at, filled = at + int(parts[leaf]), 0
        else:
            filled += size
    return first, parts


def search(rows: DataFrame, is_query: Column | None = None, k: int = K, target: float = TARGET, seed: int = 0,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): per query its k nearest found, rank from 1,
    score the Euclidean distance, ties to the smaller vec_id.

    Queries are the rows of `is_query` (default: id divisible by 100); candidates are
    all rows with another id. Vectors that are null, zero, hold null or non-finite
    components or have an unusual length, and null ids, take no part. A query id that
    repeats is answered once (for its least vector); candidates that repeat an id each
    count. Fewer candidates than k are all returned; without a usable vector there are
    no rows. Columns other than the two named are ignored, whatever their names.
    """
    spark = rows.sparkSession
    asked = (F.col("vec_id") % 100 == 0) if is_query is None else is_query
    vectors = cut(usable(rows, id_col, vector_col))
    n = vectors.count()
    queries = vectors.filter(asked).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = min(SAMPLE_MOST, max(SAMPLE_LEAST, n // SAMPLE_SHARE))
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(size).select("vec")
    tree = grow(np.array([r["vec"] for r in sample.collect()]), seed)  # SAMPLE_MOST rows at most
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.descend(_matrix(batch.column("vec"), len(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vec"), pa.array(leaf)], names=["vec_id", "vec", "leaf"])

    indexed = cut(vectors.mapInArrow(place, "vec_id long, vec array<double>, leaf long"))
    sizes = np.zeros(tree.n_leaves, dtype=np.int64)
    for r in indexed.groupBy("leaf").count().collect():  # one row a leaf
        sizes[r["leaf"]] = r["count"]
    tuned = queries.orderBy(F.xxhash64("vec_id", F.lit(seed + 1)), "vec_id").limit(CALIBRATION).collect()
    visits = calibrated_visits(tree, tuned, _true_leaves(indexed, tuned, k), target)

    bucket, parts = _buckets(sizes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, list[int]]] = []
            for i, x in enumerate(_matrix(batch.column("vec"), len(batch))):
                reached, here = 0, {}
                for seen, leaf in enumerate(shared.value.visits(x)):
                    if seen >= visits and reached > k:  # more than k, as the query itself may be among them
                        break
                    reached += int(sizes[leaf])
                    for b in range(bucket[leaf], bucket[leaf] + parts[leaf]):
                        here.setdefault(b, []).append(leaf)
                out += [(i, b, leaves) for b, leaves in sorted(here.items())]
            at = pa.array([i for i, _, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("vec").take(at), pa.array([b for _, b, _ in out], pa.int64()),
                                              pa.array([x for _, _, x in out], pa.list_(pa.int64()))], names=["query_id", "query", "bucket", "leaves"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, spread = (batch.column(c).to_numpy() for c in ("leaf", "spread"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "vec", "leaf")), pa.array(bucket[leaf] + spread % parts[leaf])],
                                             names=["vec_id", "vec", "leaf", "bucket"])

    tasks = max(1, min(n // 1000, spark.sparkContext.defaultParallelism))
    left = queries.select("vec_id", "vec").repartition(tasks, "vec_id").mapInArrow(
        walk, "query_id long, query array<double>, bucket long, leaves array<long>")
    right = indexed.withColumn("spread", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 31))).mapInArrow(
        deal, "vec_id long, vec array<double>, leaf long, bucket long")

    def nearest(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(own):
            ids, leaf, vectors = own["vec_id"].to_numpy(), own["leaf"].to_numpy(), np.stack(own["vec"].to_numpy())
            for q, x, leaves in zip(asked["query_id"], asked["query"], asked["leaves"], strict=True):
                at = np.flatnonzero(np.isin(leaf, leaves))
                found, apart = _best(ids[at], vectors[at], x, q, k)
                out.append(pd.DataFrame({"query_id": q, "vec_id": found, "score": apart}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInPandas(nearest, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
