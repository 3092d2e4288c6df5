"""Kernel classifiers against the definition of their loss, and synthetic oversampling."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wattline.operators import knn
from wattline.operators import models as md
from wattline.operators.smote import oversampled


@pytest.fixture(scope="module")
def rings(spark):
    """Three classes, two of them a disc within a ring, which no line can tell apart."""
    rng = np.random.default_rng(4)
    angle, far = rng.uniform(0, 2 * np.pi, 240), np.repeat([0.4, 2.0, 0.4], [100, 100, 40]) + rng.normal(size=240) * 0.1
    x = np.column_stack([far * np.cos(angle), far * np.sin(angle) * 50, np.full(240, 3.0)])
    x[200:, 0] += 6
    y = ["disc"] * 100 + ["ring"] * 100 + ["away"] * 40
    df = spark.createDataFrame([(i, c, [float(v) for v in r]) for i, (c, r) in enumerate(zip(y, x))], "id long, label string, x array<double>")
    return x, np.array(y), knn.stored(df.withColumn("features", array_to_vector("x")).coalesce(2))


@pytest.mark.parametrize("kernel", ["rbf", "linear"])
def test_svc_is_optimal_for_its_loss(rings, kernel):
    x, y, df = rings
    m = md.fit_kernel_svc(df, "label", C=0.5, kernel=kernel)
    assert m.classes == ["away", "disc", "ring"] and m.pairs == [(0, 1), (0, 2), (1, 2)]
    z, place = m.features.z(x), np.array([m.classes.index(c) for c in y])
    rng = np.random.default_rng(0)
    for (a, b), w, gap in zip(m.pairs, m.w, m.gaps, strict=True):
        assert -1e-9 <= gap <= md.GAP
        at = (place == a) | (place == b)
        s = np.where(place[at] == a, 1.0, -1.0)
        value = lambda v: 0.5 * v @ v + 0.5 * np.maximum(1 - s * (z[at] @ v), 0).sum()
        assert all(value(w) <= value(w + rng.normal(size=len(w)) * d) * (1 + md.GAP) for d in (1e-3, 1e-2, 0.1) for _ in range(20))
    got = {r["id"]: r["predicted_label"] for r in m.predict(df, "predicted_label").collect()}
    right = np.mean([got[i] == c for i, c in enumerate(y)])
    assert right > 0.97 if kernel == "rbf" else right < 0.9
    assert [got[i] for i in range(240)] == [m.classes[j] for j in m.votes(x).argmax(axis=1)]


def test_svc_of_one_class_null_labels_and_no_rows(rings):
    _, _, df = rings
    one = df.withColumn("label", F.when(F.col("label") == "ring", "ring"))
    m = md.fit_kernel_svc(one, "label")
    assert m.classes == ["ring"] and m.pairs == []
    assert {r[0] for r in m.predict(one).select("predicted_label").distinct().collect()} == {"ring"}
    with pytest.raises(ValueError):
        md.fit_kernel_svc(df.where("false"), "label")


def test_synthetic_rows_lie_between_neighbours_of_their_class(rings, spark):
    x, y, df = rings
    lone = df.unionByName(spark.createDataFrame([(999, "lone", [0.0, 0.0, 0.0]), (1000, None, [1.0, 1.0, 1.0])], "id long, label string, x array<double>").withColumn("features", array_to_vector("x")))
    rows = oversampled(lone, "id", "x", "label", k=5).collect()
    assert len(rows) == 60 and {r["label"] for r in rows} == {"away"} and sorted(r["j"] for r in rows) == list(range(60))
    for r in rows:
        a, b, v = x[r["base_id"]], x[r["nb_id"]], np.array(r["x"])
        assert y[r["base_id"]] == y[r["nb_id"]] == "away" and r["base_id"] != r["nb_id"]
        near = sorted((np.linalg.norm(x[i] - a), i) for i in range(200, 240) if i != r["base_id"])[:5]
        assert r["nb_id"] in [i for _, i in near]
        u = (v - a) @ (b - a) / ((b - a) @ (b - a))
        assert -1e-9 <= u <= 1 + 1e-9 and np.allclose(v, a + u * (b - a))
    assert oversampled(lone.repartition(5), "id", "x", "label", k=5).exceptAll(spark.createDataFrame(rows, oversampled(lone, "id", "x", "label").schema)).count() == 0
    assert oversampled(df.where("label = 'ring'"), "id", "x", "label").count() == 0
    assert oversampled(df.where("false"), "id", "x", "label").count() == 0


def test_a_partition_without_rows_takes_no_part_in_sums(spark):
    """A file's split that holds no row group is a task without rows."""
    rows = spark.createDataFrame([([1.0, 2.0], 3.0)], "x array<double>, y double").repartition(3)
    assert md._sums(rows, lambda x, y: {0: x.sum(axis=0), 1: y})[0].tolist() == [1.0, 2.0]


def test_svr_and_classifier_with_empty_partitions(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    rows = spark.createDataFrame([(r.tolist(), float(r[0]), "a" if r[0] > 0 else "b") for r in x], "x array<double>, y double, label string").coalesce(1)
    rows = rows.unionByName(rows.where("y > 100")).withColumn("features", array_to_vector("x")).drop("x")
    model = md.fit_svrs(rows, "y", [dict(C=1, kernel="linear", gamma="scale")])[0]
    assert model.gap <= md.GAP and np.abs(model.predict(x) - x[:, 0]).max() < 0.5
    assert max(md.fit_kernel_svc(rows, "label").gaps) <= md.GAP


def test_queries_of_a_pivot_are_dealt_over_slices(spark, monkeypatch):
    """Same neighbours, and no group holds more than its share of the queries."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist(), "ab"[i % 2]) for i in range(90)], "id long, v array<double>, g string").checkpoint()

    def found():
        near = knn.nearest(df, df, "id", "id", "v", "v", k=4, group_col="g", exclude_self=True)
        return sorted((r["id"], r["nn_rank"], r["nn_id"], round(r["dist"], 9)) for r in near.collect())

    whole, seen, search = found(), [], knn._search
    monkeypatch.setattr(knn, "SLICE_QUERIES", 20)
    monkeypatch.setattr(knn, "_search", lambda *a: seen.append(a[-1]) or search(*a))
    assert found() == whole and len(whole) == 90 * 4 and seen == [5, 5]
