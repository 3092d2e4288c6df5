"""Exact k-nearest neighbours with a tree of balls.

A sample of rows makes up to PIVOTS pivots, which are grouped around some of them: a
tree of two levels and of bounded size, broadcast once. A training row goes down it to a
pivot near it; a pivot's ball reaches to the farthest of its rows, a group's ball to the
farthest of its pivots' balls. Each query first searches the rows of its own pivot, which
bounds the distance of its k-th neighbour; by the triangle inequality only balls that
reach within that bound can hold a nearer row. The descent with this bound happens in
the task that holds the query: only the pivots that are left become rows, or, where
most pivots are within reach (vectors without structure), only their groups. Rows meet in
(pivot, part, slice) groups of bounded size: a pivot with many rows is split, a query is sent
to each part; many queries are dealt over slices, each with a copy of the rows. Exact for any k; nothing is compared that the bounds exclude.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import checkpoint_root

#: Pivots at most (their vectors come to the driver), rows wanted of a pivot, and rows and
#: queries of a (pivot, part, slice) group.
PIVOTS, PIVOT_ROWS, PART_ROWS, SLICE_QUERIES = 16_384, 256, 4096, 8192
#: Pivots within reach of a query, on average, from which on it is sent to groups of pivots, and rows of such a group's part.
FEW_PIVOTS, GROUP_ROWS = 16, 16_384
#: Numbers that a step of a distance matrix holds, and rows that a task hands on together.
HELD_NUMBERS, HELD_ROWS = 1 << 20, 4096


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Dealt evenly over at least as many partitions as there are cores: a few large file splits leave most cores idle in every later pass."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))


def _distance(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distances of every row of a to every row of b, a few rows at a time."""
    out = np.empty((len(a), len(b)))
    step = int(min(64, max(1, HELD_NUMBERS // max(1, b.size))))
    for s in range(0, len(a), step):
        diff = np.abs(a[s:s + step, None, :] - b[None, :, :])
        if p == 1:
            out[s:s + step] = diff.sum(axis=2)
        elif p == 2:
            out[s:s + step] = np.sqrt((diff * diff).sum(axis=2))
        else:
            out[s:s + step] = (diff ** p).sum(axis=2) ** (1.0 / p)
    return out


@dataclass
class Balls:
    """Pivots in groups: `heads` are the groups' centres, `members[g]` the pivots of group g.
    `radius` and `reach` (pivots' and groups' balls) are known once rows have been placed."""

    pivots: np.ndarray
    heads: np.ndarray
    members: list[np.ndarray]
    radius: np.ndarray | None = None
    reach: np.ndarray | None = None

    @classmethod
    def around(cls, pivots: np.ndarray, p: float) -> "Balls":
        heads = pivots[:max(1, int(np.sqrt(len(pivots))))]
        group = np.concatenate([_distance(pivots[i:i + 256], heads, p).argmin(axis=1) for i in range(0, len(pivots), 256)])
        return cls(pivots, heads, [np.flatnonzero(group == g) for g in range(len(heads))])

    def place(self, x: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray]:
        """A pivot near each row (the nearest one of the nearest group) and its distance."""
        group = _distance(x, self.heads, p).argmin(axis=1)
        pivot, far = np.empty(len(x), dtype=np.int64), np.empty(len(x))
        for g in np.unique(group):
            at, some = np.flatnonzero(group == g), self.members[g]
            d = _distance(x[at], self.pivots[some], p)
            pivot[at], far[at] = some[d.argmin(axis=1)], d.min(axis=1)
        return pivot, far

    def with_radius(self, radius: np.ndarray, p: float) -> "Balls":
        """Pivots without rows have radius -1 and are never reached."""
        reach = np.full(len(self.heads), -np.inf)
        for g, some in enumerate(self.members):
            used = some[radius[some] >= 0]
            if len(used):
                reach[g] = (_distance(self.heads[g][None, :], self.pivots[used], p)[0] + radius[used]).max()
        return Balls(self.pivots, self.heads, self.members, radius, reach)

    def within(self, x: np.ndarray, bound: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pivot, distance) of the pivots whose ball comes within a row's bound."""
        limit = bound * (1 + 1e-12)
        rows, pivots, dists = [], [], []
        to_heads = _distance(x, self.heads, p)
        for g, some in enumerate(self.members):
            near = np.flatnonzero(to_heads[:, g] - self.reach[g] <= limit + 1e-9 * np.abs(to_heads[:, g]))
            if len(near) and np.isfinite(self.reach[g]):
                d = _distance(x[near], self.pivots[some], p)
                r, c = np.nonzero((d - self.radius[some] <= limit[near, None]) & (self.radius[some] >= 0))
                rows.append(near[r])
                pivots.append(some[c])
                dists.append(d[r, c])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return np.concatenate(rows), np.concatenate(pivots), np.concatenate(dists)


def _placed(rows: DataFrame, shared, p: float) -> DataFrame:
    """Columns pivot and far, the distance to it, added to (id, vec, grp) rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                pivot, far = shared.value.place(np.stack(b["vec"].to_numpy()), p)
                yield b.assign(pivot=pivot, far=far)

    return rows.mapInPandas(run, "id long, vec array<double>, grp string, pivot long, far double")


def _search(asked: DataFrame, own: DataFrame, k: int, p: float, exclude_self: bool, slices: int = 1) -> DataFrame:
    """(id, tid, dist): per query and group of rows the k nearest, by distance and id. Queries
    of a group are dealt over `slices`, each with a copy of its rows."""
    def run(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        ids, near, dist = [], [], []
        if len(q) and len(t):
            tid, vec = t["id"].to_numpy(), np.stack(t["vec"].to_numpy())
            for s in range(0, len(q), 256):
                d = _distance(np.stack(q["vec"].to_numpy()[s:s + 256]), vec, p)
                for row, i in zip(d, q["id"].to_numpy()[s:s + 256], strict=True):
                    at = np.flatnonzero(tid != i) if exclude_self else np.arange(len(tid))
                    if len(at) > k:
                        at = at[row[at] <= np.partition(row[at], k - 1)[k - 1]]
                    at = at[np.lexsort((tid[at], row[at]))][:k]
                    ids.append(np.full(len(at), i))
                    near.append(tid[at])
                    dist.append(row[at])
        return pd.DataFrame({"id": np.concatenate(ids), "tid": np.concatenate(near), "dist": np.concatenate(dist)}) if ids else pd.DataFrame({"id": [], "tid": [], "dist": []})

    keys = ["grp", "pivot", "part"]
    if slices > 1:
        keys.append("slice")
        asked = asked.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices)).cast("int"))
        own = own.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return (asked.select("id", "vec", *keys).groupBy(*keys).cogroup(own.select("id", "vec", *keys).groupBy(*keys))
            .applyInPandas(run, "id long, tid long, dist double"))


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy("dist", "tid")
    return found.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)


def nearest(queries: DataFrame, train: DataFrame, qid: str, tid: str, qvec: str, tvec: str, k: int,
            p: float = 2, group_col: str | None = None, exclude_self: bool = False, seed: int = 7) -> DataFrame:
    """(qid, tid, dist, nn_rank) for the k nearest training rows of each query (ties by
    training id). `group_col` restricts neighbours to the same group (e.g. class);
    `exclude_self` drops tid == qid. `p` is at least 1 (the triangle inequality)."""
    if p < 1:
        raise ValueError("p must be at least 1")
    group = F.col(group_col).cast("string") if group_col else F.lit("")
    asked = queries.select(F.col(qid).cast("bigint").alias("id"), F.col(qvec).cast("array<double>").alias("vec"), group.alias("grp"))
    rows = train.select(F.col(tid).cast("bigint").alias("id"), F.col(tvec).cast("array<double>").alias("vec"), group.alias("grp"))
    n = rows.count()
    # no pivot meets more queries than there are
    slices = -(-asked.count() // SLICE_QUERIES)
    want = max(1, min(PIVOTS, n // PIVOT_ROWS))
    out_tid = f"nn_{tid}" if tid == qid else tid
    if not n:
        return asked.select(F.col("id").alias(qid)).limit(0).select(qid, F.lit(0).cast("bigint").alias(out_tid), F.lit(0.0).alias("dist"), F.lit(0).alias("nn_rank"))
    pivots = np.array([r["vec"] for r in rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(want).collect()]).reshape(min(want, n), -1)
    sc = rows.sparkSession.sparkContext
    balls = Balls.around(pivots, p)
    shared = sc.broadcast(balls)
    placed = stored(_placed(rows, shared, p))
    # One row per pivot and group of rows that has any.
    cells = stored(placed.groupBy("grp", "pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
                   .withColumn("parts", F.ceil(F.col("n") / F.lit(PART_ROWS)).cast("int")))
    own = placed.join(cells.select("grp", "pivot", "parts"), ["grp", "pivot"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def sent(to: DataFrame) -> DataFrame:
        return to.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    home = _placed(asked, shared, p).drop("far")
    first = stored(_search(sent(home.join(cells.select("grp", "pivot", "parts"), ["grp", "pivot"])), own, k, p, exclude_self, slices))
    bound = _best(first, k).groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = home.join(bound, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    radius = np.full(len(pivots), -1.0)
    for r in cells.groupBy("pivot").agg(F.max("radius").alias("radius")).collect():  # at most PIVOTS rows
        radius[r["pivot"]] = r["radius"]
    reaching = sc.broadcast(balls.with_radius(radius, p))

    def descended(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
        for b in batches:
            for s in range(0, len(b), 512):
                part = b.iloc[s:s + 512]
                yield part, *reaching.value.within(np.stack(part["vec"].to_numpy()), part["bound"].to_numpy(), p)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, row, _, _ in descended(batches):
            yield pd.DataFrame({"n": [len(row)]})

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, row, pivot, apart in descended(batches):
            away = np.flatnonzero(pivot != part["pivot"].to_numpy()[row])
            for s in range(0, len(away), HELD_ROWS):  # a query may be within reach of every pivot
                some = away[s:s + HELD_ROWS]
                yield part.iloc[row[some]].assign(pivot=pivot[some], apart=apart[some])

    group_of = np.empty(len(pivots), dtype=np.int64)
    for g, some in enumerate(balls.members):
        group_of[some] = g

    def reached_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, row, pivot, _ in descended(batches):
            home = part["pivot"].to_numpy()
            pairs = np.unique(np.stack([np.append(row, np.arange(len(part))), group_of[np.append(pivot, home)]], axis=1), axis=0)  # its own in any case
            for s in range(0, len(pairs), HELD_ROWS):
                some = pairs[s:s + HELD_ROWS]
                yield part.iloc[some[:, 0]][["id", "vec", "grp"]].assign(pivot=some[:, 1])

    bounded = stored(bounded.select("id", "vec", "grp", "pivot", "bound"))
    pairs = bounded.mapInPandas(counted, "n long").agg(F.sum("n")).first()[0] or 0
    if pairs <= FEW_PIVOTS * bounded.count():
        reach = bounded.mapInPandas(reached, "id long, vec array<double>, grp string, pivot long, bound double, apart double")
        others = reach.join(cells, ["grp", "pivot"]).where(F.col("apart") - F.col("radius") <= F.col("bound") * (1 + 1e-12))
        found = first.unionByName(_search(sent(others), own, k, p, exclude_self, slices))
    else:
        # the rows of a query's own pivot are among those of its group, so `first` has only given the bound
        groups = rows.sparkSession.createDataFrame(pd.DataFrame({"pivot": np.arange(len(pivots)), "g": group_of}), "pivot long, g long")
        of = placed.join(F.broadcast(groups), "pivot").select("id", "vec", "grp", F.col("g").alias("pivot"))
        sizes = stored(of.groupBy("grp", "pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP_ROWS)).cast("int").alias("parts")))
        own = of.join(F.broadcast(sizes), ["grp", "pivot"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        reach = bounded.mapInPandas(reached_groups, "id long, vec array<double>, grp string, pivot long")
        found = _search(sent(reach.join(F.broadcast(sizes), ["grp", "pivot"])), own, k, p, exclude_self, slices)
    return _best(found, k).select(F.col("id").alias(qid), F.col("tid").alias(out_tid), "dist", "nn_rank")


def knn_regress(neigh: DataFrame, train_y: DataFrame, qid: str, tid: str, y: str,
                weights: str = "uniform") -> DataFrame:
    """Mean of neighbour targets; 'distance' weights 1/d, where a zero distance
    takes all the weight (shared among zero-distance neighbours)."""
    ncol = f"nn_{tid}" if f"nn_{tid}" in neigh.columns else tid
    j = neigh.join(train_y.select(F.col(tid).alias("_t"), F.col(y).alias("_y")), F.col(ncol) == F.col("_t"))
    if weights == "uniform":
        return j.groupBy(qid).agg(F.avg("_y").alias("prediction"))
    zero = F.col("dist") == 0
    weight = F.when(~zero, F.lit(1.0) / F.col("dist"))
    return j.groupBy(qid).agg(F.coalesce(F.avg(F.when(zero, F.col("_y"))), F.sum(weight * F.col("_y")) / F.sum(weight)).alias("prediction"))
