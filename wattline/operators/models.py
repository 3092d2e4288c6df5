"""Model fitting and scoring (M1, M3-M10) on rows with a `features` vector.

Every fit is a distributed job over the training rows; the driver holds model sized
tables only (coefficients, tree nodes, normal equations).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators import forest, knn
from wattline.operators import rules as rules_of
from wattline.operators.grams import Gram, grams, held_grams


# -- M1 --------------------------------------------------------------------------------------

def fit_ols(train: DataFrame, label: str, fit_intercept: bool = True):
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0,
                            elasticNetParam=0.0, fitIntercept=fit_intercept, standardization=False).fit(train)


def _size(df: DataFrame) -> int:
    row = df.select(F.size("x").alias("n")).first()
    if row is None:
        raise ValueError("no rows to fit")
    return row["n"]


def _arrays(df: DataFrame) -> DataFrame:
    return df.withColumn("x", vector_to_array("features"))


# -- M5 committees of rule sets --------------------------------------------------------------------

@dataclass
class Member:
    """Of one committee member, a rule set per rule setting."""

    sets: list[rules_of.RuleSet]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.stack([s.predict(x) for s in self.sets], axis=1)


def _udf(kind: str, fn):
    """Column from fn(X), X being the rows' features in `x`; arrays a row if `kind` is an array."""
    @F.pandas_udf(kind)
    def apply(x: pd.Series) -> pd.Series:
        return pd.Series(list(fn(np.stack(x.to_numpy()))))
    return apply("x")


def fit_committees(train: DataFrame, label: str, committees: int, rules: list[int]) -> list[Member]:
    """Committees of rule sets for several rule settings together: each member's rules come
    from a tree pruned to at most so many leaves (of at least two rows a coefficient),
    fitted to 2 y - (the member before). What is kept is bounded: `committees` *
    sum(`rules`) rules. Members follow each other, settings don't: where the training rows
    fit into a task, each setting's members are fitted one after the other in a task of its own."""
    held = forest.packed_rows(train, label)
    if held is not None and np.isfinite(held.y).all():
        return _held_committees(held, committees, rules, train.sparkSession)
    y = F.col(label).cast("double")
    tr = _arrays(train).select("x", y.alias("y"), F.array(*[y] * len(rules)).alias("t"))
    k = _size(tr)
    cuts = [forest.Cut(max_depth=int(np.ceil(np.log2(max(r, 2)))) + 1, max_leaves=r) for r in rules]
    members = []
    for m in range(committees):
        rows = tr.select("x", F.posexplode("t").alias("tree", "y")).select("tree", F.lit(1.0).alias("w"), "y", "x")
        nodes = forest.grow(rows, max(c.max_depth for c in cuts), min_leaf=2 * (k + 1))
        found = forest.variants(nodes, cuts).toPandas()  # len(rules) trees of the depth above
        trees = forest.Applied(found)
        leaves = lambda x, trees=trees: np.stack([leaf[at][:, j] for j, (at, leaf, _) in enumerate(trees.ends(x))], axis=1)
        at = tr.withColumn("_leaf", _udf("array<int>", leaves))
        flat = at.select("x", F.posexplode(F.arrays_zip("t", "_leaf")).alias("j", "z")).select("x", F.col("z.t").alias("y"), (F.col("j") * (1 << 20) + F.col("z._leaf")).alias("_by"))
        sums: list[dict[int, Gram]] = [{} for _ in rules]
        for g, s in grams(flat, "_by").items():
            sums[g >> 20][g & ((1 << 20) - 1)] = s
        sets = [rules_of.tree_rules(feature, threshold, left, right, leaf[:, j], sums[j]) for j, (feature, threshold, left, right, leaf, _) in enumerate(trees.trees)]
        members.append(Member(rules_of.with_fewer_conditions(sets, tr)))
        if m + 1 < committees:
            # stored, or each member would compute all those before it anew in every pass
            tr = knn.stored(tr.withColumn("_p", _udf("array<double>", members[-1].predict)).withColumn("t", F.transform("_p", lambda p: 2 * F.col("y") - p)).drop("_p"))
    return members


def _held_committees(held: forest.PackedRows, committees: int, rules: list[int], spark) -> list[Member]:
    """`fit_committees` on rows that a task holds."""
    shared = spark.sparkContext.broadcast(held)
    cuts = [forest.Cut(max_depth=int(np.ceil(np.log2(max(r, 2)))) + 1, max_leaves=r) for r in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for j in b["j"]:
                for m, found in enumerate(_committee(shared.value, committees, cuts[j])):
                    yield pd.DataFrame([(j, m, pickle.dumps(found))], columns=["j", "m", "rules"])

    ordered = sorted(range(len(rules)), key=lambda j: -rules[j])  # the longest first
    tasks = spark.createDataFrame([(j,) for j in ordered], "j int").repartitionByRange(len(rules), "j")
    got = {(r["m"], r["j"]): pickle.loads(r["rules"]) for r in tasks.mapInPandas(run, "j int, m int, rules binary").collect()}
    shared.destroy()
    return [Member([got[m, j] for j in range(len(rules))]) for m in range(committees)]


def _committee(held: forest.PackedRows, committees: int, cut: forest.Cut) -> Iterator[rules_of.RuleSet]:
    columns = held.columns()
    x = np.ascontiguousarray(columns.T)
    k, t = len(columns), held.y
    for _ in range(committees):
        nodes = forest._subtree(0, 1, columns, held.values, held.ranks, np.ones(len(t)), t, cut.max_depth, k, 2 * (k + 1), 42)
        feature, threshold, left, right, leaf, _ = tree = forest._cut_tree(nodes, [cut])
        at = next(forest.Applied.of([(len(feature), forest._blob(*tree))]).ends(x))[0]
        found = rules_of.tree_rules(feature, threshold, left, right, leaf[:, 0], held_grams(x, t, leaf[at, 0]))
        found = rules_of.held_with_fewer_conditions(found, x, t)
        yield found
        t = 2 * held.y - rules_of.held_predictions(found, x)


def committee_predictions(members: list[Member], sizes: list[tuple[int, int]], x: np.ndarray) -> np.ndarray:
    """Per row and (setting, committees): the mean of the first members' predictions."""
    each = np.stack([m.predict(x) for m in members])
    sums = np.cumsum(each, axis=0)
    return np.stack([sums[n - 1][:, j] / n for j, n in sizes], axis=1)


def committee_column(members: list[Member], sizes: list[tuple[int, int]], df: DataFrame, out: str = "predictions") -> DataFrame:
    """`df` with array column `out`: the prediction for each (setting, committees)."""
    return _arrays(df).withColumn(out, _udf("array<double>", lambda x: committee_predictions(members, sizes, x))).drop("x")


# -- M6 epsilon-insensitive regression -----------------------------------------------------------

#: Rows that the RBF kernel is expanded around, and the constant feature that stands for
#: the intercept (so large that its share of the penalty is slight).
LANDMARKS, CONSTANT = 64, 10.0
#: Largest duality gap, as a share of the objective, at which a fit ends; most rounds.
GAP, ROUNDS = 1e-3, 100
#: Step lengths that are tried together.
STEPS = np.array([4.0, 2.0, 1.0, 0.6, 0.3, 0.1, 0.03, 0.01, 3e-3, 1e-3, 3e-4, 1e-4, 1e-5])


@dataclass
class FeatureMap:
    """Standardised features, or the Nystroem features of an RBF kernel at some landmarks;
    a constant one first."""

    mean: np.ndarray
    spread: np.ndarray
    gamma: float | None = None
    landmarks: np.ndarray | None = None
    root: np.ndarray | None = None

    def _kernel(self, x: np.ndarray) -> np.ndarray:
        square = (x * x).sum(axis=1)[:, None] - 2 * x @ self.landmarks.T + (self.landmarks ** 2).sum(axis=1)
        return np.exp(-self.gamma * np.maximum(square, 0))

    def with_kernel(self, gamma: float, rows: np.ndarray) -> "FeatureMap":
        out = FeatureMap(self.mean, self.spread, gamma, (rows - self.mean) / self.spread)
        values, vectors = np.linalg.eigh(out._kernel(out.landmarks))
        kept = values > 1e-8 * values.max()
        out.root = vectors[:, kept] / np.sqrt(values[kept])
        return out

    def z(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.spread
        z = x if self.gamma is None else self._kernel(x) @ self.root
        return np.column_stack([np.full(len(x), CONSTANT), z])

    def size(self) -> int:
        return 1 + (len(self.mean) if self.gamma is None else self.root.shape[1])


@dataclass
class SVR:
    """Prediction: shift + scale * z(x) . w. `gap` is the relative duality gap of the fit."""

    features: FeatureMap
    w: np.ndarray
    shift: float
    scale: float
    gap: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.shift + self.scale * (self.features.z(x) @ self.w)


@dataclass
class _Problem:
    """min 1/2 |w|^2 + C sum(loss), followed along a smoothed loss whose corner has the width
    `mu`. A classifier's problem is between the two classes of `pair`."""

    C: float
    features: int
    w: np.ndarray
    mu: float = 1.0
    step: np.ndarray | None = None
    gap: float = np.inf
    pair: tuple[int, int] | None = None
    wide: bool = False
    band: float = 0.0


def _blocks(rows: DataFrame) -> DataFrame:
    """(x binary, y binary): some rows of (x array, y) together as bytes, stored, as many passes read them; dealt evenly over the cores."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"x": [np.stack(b["x"].to_numpy()).astype(float).tobytes()], "y": [b["y"].to_numpy(dtype=float).tobytes()]})

    return knn.stored(knn.spread(rows.select("x", "y")).mapInPandas(run, "x binary, y binary"))


def _sums(rows: DataFrame, per_batch) -> dict[int, np.ndarray]:
    """The sums over all rows, or `_blocks` of them, of per_batch(X, y) -> {kind: vector}: partial sums in each
    task, added up by Spark in two steps so that no task adds up all others'."""
    packed = dict(rows.dtypes)["x"] == "binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            if packed:
                some = [(np.frombuffer(x).reshape(len(y) // 8, -1), np.frombuffer(y)) for x, y in zip(b["x"], b["y"])]
            else:
                some = [(np.stack(b["x"].to_numpy()), b["y"].to_numpy(dtype=float))] if len(b) else []
            for x, y in some:
                for kind, v in per_batch(x, y).items():
                    total[kind] = total.get(kind, 0) + v
        if total:  # an empty frame's column has no list type
            yield pd.DataFrame({"kind": list(total), "v": list(total.values())})

    parts = rows.mapInPandas(run, "kind int, v array<double>").select("kind", (F.spark_partition_id() % 256).alias("part"), array_to_vector("v").alias("v"))
    once = parts.groupBy("kind", "part").agg(Summarizer.sum(F.col("v")).alias("v"))
    return {r["kind"]: r["v"].toArray() for r in once.groupBy("kind").agg(Summarizer.sum(F.col("v")).alias("v")).collect()}


def _newton(total, maps: list[FeatureMap], problems: list[_Problem], side) -> None:
    """Minimises 1/2 |w|^2 + C sum(max(0, t)) for all problems together, where
    t = c - s * (z . w) and `side(q, f, y) -> (s, c)` per value f of z . w (rows x columns).
    Newton steps on a smoothed loss, whose corner is narrowed until the duality gap is below
    GAP; their curvature is that of the rows in a band around the corner. The slopes of the smoothed loss are a feasible point of the dual, so the gap bounds
    the distance from the optimum. A round is one aggregate of gradients and curvatures and
    one of the loss at several step lengths: `total(per_batch)` as `_sums` of the rows."""
    lengths = np.append(0.0, STEPS)

    def parts(q, f, y):
        s, c = side(q, f, y)
        t = c - s * f
        return t, np.clip(t / q.mu, 0, 1), s, c

    for _ in range(ROUNDS):
        todo = [(i, q) for i, q in enumerate(problems) if q.gap > GAP]
        if not todo:
            break
        for _, q in todo:
            q.band = min(max(q.band, q.mu), 10 * q.mu)

        def slopes(x, y, todo=todo):
            z, out = {j: maps[j].z(x) for j in {q.features for _, q in todo}}, {}
            for i, q in todo:
                zq = z[q.features]
                t, slope, s, c = (np.broadcast_to(v, (len(x), 1))[:, 0] for v in parts(q, (zq @ q.w)[:, None], y))
                bent = zq[s != 0] if q.wide else zq[(s != 0) & (np.abs(t - q.mu / 2) < q.band / 2)]
                out[i] = np.concatenate([[np.maximum(t, 0).sum(), (slope * c).sum()], (slope * s) @ zq, (bent.T @ bent).reshape(-1)])
            return out

        got = total(slopes)
        for i, q in todo:
            m = len(q.w)
            az, curve = q.C * got[i][2:2 + m], got[i][2 + m:].reshape(m, m)
            primal = 0.5 * q.w @ q.w + q.C * got[i][0]
            rise, square = q.C * got[i][1], az @ az
            share = min(max(rise / square, 0.0), 1.0) if square else 0.0  # a part of a feasible point is one
            dual = share * rise - 0.5 * share ** 2 * square
            q.gap = (primal - dual) / max(primal, 1e-12)
            gradient = q.w - az
            # the gap of the whole point is half the gradient's square and, for the rest, the corner's
            if 0.5 * gradient @ gradient <= 0.2 * (primal - rise + 0.5 * square):
                q.mu, q.step = 0.1 * q.mu, None
            else:
                q.step = -np.linalg.solve(np.eye(m) + q.C / (q.mu if q.wide else q.band) * curve, gradient)
        todo = [(i, q) for i, q in todo if q.gap > GAP and q.step is not None]
        if not todo:
            continue

        def along(x, y, todo=todo):
            z, out = {j: maps[j].z(x) for j in {q.features for _, q in todo}}, {}
            for i, q in todo:
                zq = z[q.features]
                t, slope, _, _ = parts(q, (zq @ q.w)[:, None] + (zq @ q.step)[:, None] * lengths, y)
                out[i] = np.where(t < q.mu, slope * t / 2, t - q.mu / 2).sum(axis=0)
            return out

        got = total(along)
        for i, q in todo:
            value = [0.5 * (q.w + s * q.step) @ (q.w + s * q.step) + q.C * v for s, v in zip(lengths, got[i], strict=True)]
            best = int(np.argmin(value))
            if best == 0 and q.wide:  # only rounding is left
                q.mu *= 0.3
            # no row's curvature is above that of the corner: a step by all rows' descends
            q.wide = best == 0 and not q.wide
            q.w = q.w + lengths[best] * q.step
            # a corner that few rows lie in now tells little of those that the step moves into it: a short step widens the band
            q.band = 3 * q.band if lengths[best] <= 0.1 else max(q.mu, 0.3 * q.band) if lengths[best] >= 1 else q.band


def _standard(rows: DataFrame, k: int) -> tuple[FeatureMap, np.ndarray, dict[str, float]]:
    """(standardising map, [count, sum and squares of y], RBF width by its name)."""
    first = _sums(rows, lambda x, y: {0: np.concatenate([[len(y), y.sum(), (y * y).sum()], x.sum(axis=0), (x * x).sum(axis=0)])})[0]
    n = first[0]
    mean = first[3:3 + k] / n
    variance = np.maximum(first[3 + k:] / n - mean ** 2, 0)
    spread = np.where(variance > 1e-12 * np.maximum(1, mean ** 2), np.sqrt(variance), 1.0)
    total = (variance / spread ** 2).mean() or 1.0
    return FeatureMap(mean, spread), first[:3], {"scale": 1 / (k * total), "auto": 1 / k}


def _landmarks(rows: DataFrame, number: int, seed: int) -> np.ndarray:
    """Distinct feature vectors of `number` rows (at most) drawn by a hash."""
    return np.unique(np.stack([r["x"] for r in rows.orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(number).collect()]), axis=0)


def fit_svrs(train: DataFrame, label: str, configs: list[dict], epsilon: float = 0.1, seed: int = 42) -> list[SVR]:
    """The epsilon-insensitive loss for all configurations (C, kernel, gamma) together, on
    standardised rows (see `_newton`). The RBF kernel is expanded around LANDMARKS rows
    (Nystroem), drawn by a hash."""
    rows = _arrays(train).select("x", F.col(label).cast("double").alias("y"))
    plain, first, width = _standard(rows, _size(rows))
    shift = first[1] / first[0]
    scale = float(np.sqrt(max(first[2] / first[0] - shift ** 2, 0))) or 1.0
    some = _landmarks(rows, LANDMARKS, seed)
    maps: list[FeatureMap] = []
    places: dict[float | None, int] = {}
    problems: dict[tuple, _Problem] = {}
    order = []
    for c in configs:
        gamma = width[c["gamma"]] if c["kernel"] == "rbf" else None
        if gamma not in places:
            places[gamma] = len(maps)
            maps.append(plain if gamma is None else plain.with_kernel(gamma, some))
        at = places[gamma]
        order.append((float(c["C"]), at))
        problems.setdefault(order[-1], _Problem(float(c["C"]), at, np.zeros(maps[at].size())))

    def side(q, f, y):
        scaled = ((y - shift) / scale)[:, None]
        s = np.sign(scaled - f)
        return s, s * scaled - epsilon

    blocks = _blocks(rows)
    _newton(lambda per_batch: _sums(blocks, per_batch), maps, list(problems.values()), side)
    return [SVR(maps[q.features], q.w, float(shift), scale, float(q.gap)) for q in (problems[o] for o in order)]


# -- M7 classification -----------------------------------------------------------------------

def fit_svc(train: DataFrame, label: str, kernel: str = "linear", reg: float = 0.01, max_iter: int = 20, components: int = 128, seed: int = 42):
    """(label index, one-against-rest linear SVMs, feature map); the RBF kernel by random Fourier features."""
    rows = _arrays(train)
    k = _size(rows)
    index = StringIndexer(inputCol=label, outputCol="_index", stringOrderType="alphabetAsc").fit(rows)
    rng = np.random.default_rng(seed)
    waves, phase = rng.normal(size=(k, components)) * np.sqrt(2 / k), rng.uniform(0, 2 * np.pi, components)

    @F.pandas_udf("array<double>")
    def fourier(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.sqrt(2 / components) * np.cos(np.stack(x.to_numpy()) @ waves + phase)))

    def mapped(df: DataFrame) -> DataFrame:
        return df if kernel == "linear" else _arrays(df).withColumn("features", array_to_vector(fourier("x"))).drop("x")

    svm = LinearSVC(maxIter=max_iter, regParam=reg)
    return index, OneVsRest(classifier=svm, labelCol="_index", featuresCol="features").fit(index.transform(mapped(train))), mapped


def predict_class(fitted, df: DataFrame, out: str = "predicted_label") -> DataFrame:
    index, model, mapped = fitted
    names = F.array(*[F.lit(x) for x in index.labels])
    return model.transform(mapped(df)).withColumn(out, F.element_at(names, (F.col("prediction") + 1).cast("int"))).drop("prediction", "rawPrediction")


@dataclass
class KernelSVC:
    """Soft-margin classifiers between every two classes; `w[j]` and `gaps[j]` belong to
    `pairs[j]`, a positive value speaks for the first of the two."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    features: FeatureMap
    w: list[np.ndarray]
    gaps: list[float]

    def votes(self, x: np.ndarray) -> np.ndarray:
        z, out = self.features.z(x), np.zeros((len(x), len(self.classes)), dtype=np.int64)
        for (a, b), w in zip(self.pairs, self.w, strict=True):
            first = z @ w > 0
            out[:, a] += first
            out[:, b] += ~first
        return out

    def predict(self, df: DataFrame, out: str = "predicted_label") -> DataFrame:
        """`df` with the class of most votes, ties to the first in order."""
        names = F.array(*[F.lit(c) for c in self.classes])
        place = _udf("int", lambda x: self.votes(x).argmax(axis=1))
        return _arrays(df).withColumn(out, F.element_at(names, place + 1)).drop("x")


def fit_kernel_svc(train: DataFrame, label: str, C: float = 1.0, kernel: str = "rbf", gamma: str = "scale", landmarks: int = LANDMARKS, seed: int = 42) -> KernelSVC:
    """The hinge loss between every two classes, all pairs together (see `_newton`), on
    standardised rows. The RBF kernel is expanded around `landmarks` rows of each class
    (Nystroem): on overlapping classes the support vectors grow with the rows, so they are
    never gathered. Rows whose label is null take no part; a single class is always predicted."""
    classes = sorted(r[0] for r in train.select(F.col(label).cast("string")).where(F.col(label).isNotNull()).distinct().collect())
    if not classes:
        raise ValueError("no rows to fit")
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("string")) - 1
    rows = _arrays(train).where(F.col(label).isNotNull()).select("x", place.cast("double").alias("y"))
    plain, _, width = _standard(rows, _size(rows))
    features = plain
    if kernel == "rbf":
        some = np.unique(np.concatenate([_landmarks(rows.where(F.col("y") == i), landmarks, seed) for i in range(len(classes))]), axis=0)
        features = plain.with_kernel(width[gamma], some)
    # at first every row lies in the corner, which is then narrowed
    problems = [_Problem(float(C), 0, np.zeros(features.size()), mu=2.0, pair=(a, b)) for b in range(len(classes)) for a in range(b)]

    def side(q, f, y):
        s = ((y == q.pair[0]).astype(float) - (y == q.pair[1]))[:, None]
        return s, np.abs(s)

    blocks = _blocks(rows)
    _newton(lambda per_batch: _sums(blocks, per_batch), [features], problems, side)
    return KernelSVC(classes, [q.pair for q in problems], features, [q.w for q in problems], [float(q.gap) for q in problems])


# -- M8-M10 --------------------------------------------------------------------------------------

def _long(test: DataFrame, arrays: DataFrame, column: str) -> DataFrame:
    """One row per test row and configuration from an array of predictions."""
    return arrays.select(*test.columns, F.posexplode(column).alias("config", "prediction"))


def _united(frames: list[DataFrame], test: DataFrame) -> DataFrame:
    out = None
    for i, f in enumerate(frames):
        f = f.select(*test.columns, F.lit(i).alias("config"), "prediction")
        out = f if out is None else out.unionByName(f)
    return out


def predict_long(name: str, configs: list[dict], train: DataFrame, test: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """`test` with `config` (place in `configs`) and `prediction`: a row per test row and
    configuration of one family. Configurations that share a fit share it: tree rules cut
    one grown forest, neighbours are found once for the largest number, committees are
    prefixes."""
    if name == "LinearRegression":
        return _united([fit_ols(train, label, c["fit_intercept"]).transform(test) for c in configs], test)
    if name == "KNN":
        found, out = {}, []
        most = max(c["n_neighbors"] for c in configs)
        tr, te = _arrays(train), _arrays(test)
        for c in configs:
            if c["p"] not in found:
                found[c["p"]] = knn.stored(knn.nearest(te, tr, key, key, "x", "x", k=most, p=c["p"]))
            near = found[c["p"]].where(F.col("nn_rank") <= c["n_neighbors"])
            out.append(test.join(knn.knn_regress(near, train, key, key, label, c["weights"]), key))
        return _united(out, test)
    if name in ("CART", "RandomForest"):
        k = _size(_arrays(train))
        out, held = [], forest.packed_rows(train, label, key)
        shared = None if held is None else train.sparkSession.sparkContext.broadcast(held)
        kinds = sorted({(c["min_samples_leaf"], c.get("max_features", "sqrt")) for c in configs})
        for leaf, features in kinds:
            some = [(i, c) for i, c in enumerate(configs) if (c["min_samples_leaf"], c.get("max_features", "sqrt")) == (leaf, features)]
            numbers = sorted({c.get("n_estimators", 1) for _, c in some})
            rule = lambda c: (c["max_depth"], c.get("min_samples_split", 2), c.get("ccp_alpha", 0.0))
            rules = sorted({rule(c) for _, c in some})
            cuts = [forest.Cut(*r) for r in rules]
            depth, number = max(c["max_depth"] for _, c in some), max(1, int(np.sqrt(k))) if features == "sqrt" else None
            bootstrap = name == "RandomForest"
            if shared is not None and (shared.value.key is not None or not bootstrap):
                cut = forest.grow_packed(shared, numbers[-1], depth, leaf, number, seed, bootstrap, cuts, train.sparkSession)
            else:
                nodes = forest.grow(forest.bootstrap_rows(train, label, key, numbers[-1], seed, bootstrap=bootstrap), depth, leaf, number, seed)
                cut = knn.stored(forest.variants(nodes, cuts))
            place = {rules.index(rule(c)) * len(numbers) + numbers.index(c.get("n_estimators", 1)): i for i, c in some}
            rows = _long(test, forest.predictions(cut, test, numbers), "predictions")
            config = F.element_at(F.array(*[F.lit(place.get(j, -1)) for j in range(len(rules) * len(numbers))]), F.col("config") + 1)
            out.append(rows.withColumn("config", config).where("config >= 0"))
        whole = out[0]
        for f in out[1:]:
            whole = whole.unionByName(f)
        return whole
    if name == "Cubist":
        rules = sorted({c["n_rules"] for c in configs})
        members = fit_committees(train, label, max(c["n_committees"] for c in configs), rules)
        sizes = [(rules.index(c["n_rules"]), c["n_committees"]) for c in configs]
        return _long(test, committee_column(members, sizes, test), "predictions")
    if name == "SVM":
        fitted = fit_svrs(train, label, configs, seed=seed)
        return _long(test, _arrays(test).withColumn("_p", _udf("array<double>", lambda x: np.stack([m.predict(x) for m in fitted], axis=1))), "_p")
    raise ValueError(f"no model family {name!r}")


def predict_grid(name: str, configs: list[dict], train: DataFrame, test: DataFrame, label: str, key: str) -> list[DataFrame]:
    """`test` with `prediction`, per configuration of one family."""
    rows = knn.stored(predict_long(name, configs, train, test, label, key))
    return [rows.where(F.col("config") == i).drop("config") for i in range(len(configs))]
