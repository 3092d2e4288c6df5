"""Model smoke tests on a 20 x 3 standard-normal fixture (y = 3 x0 + 0.1 noise),
reproducibility, request -> model-row mapping and streaming = batch."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import models as md
from wattline.operators.metrics import regression_metrics


@pytest.fixture(scope="module")
def synth(spark):
    rng = np.random.RandomState(42)
    X = rng.randn(20, 3)
    y = 3 * X[:, 0] + 0.1 * rng.randn(20)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "id bigint, x0 double, x1 double, x2 double, y double")


FEATS = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def rows(synth):
    from pyspark.ml.functions import array_to_vector
    return synth.select("id", "y", array_to_vector(F.array(*FEATS)).alias("features"))


def _finite(pred, n):
    vals = [r["prediction"] for r in pred.select("prediction").collect()]
    assert len(vals) == n and all(v is not None and math.isfinite(v) for v in vals)


def test_ols_recovers_slope(rows):
    m = md.fit_ols(rows, "y")
    assert abs(m.coefficients[0] - 3) < 0.1
    _finite(m.transform(rows), 20)
    assert md.fit_ols(rows, "y", fit_intercept=False).intercept == 0.0


GRIDS = [("CART", [dict(max_depth=3, min_samples_leaf=1, min_samples_split=s, ccp_alpha=a) for s in (2, 15) for a in (0.0, 1.0)]),
         ("RandomForest", [dict(n_estimators=n, max_depth=3, min_samples_leaf=1, min_samples_split=2) for n in (2, 5)]),
         ("Cubist", [dict(n_committees=n, n_rules=3) for n in (1, 2)]),
         ("SVM", [dict(C=10, kernel=k, gamma="scale") for k in ("linear", "rbf")]),
         ("KNN", [dict(n_neighbors=3, weights=w, p=p) for w in ("uniform", "distance") for p in (1, 2)])]


@pytest.mark.parametrize("name, configs", GRIDS, ids=[n for n, _ in GRIDS])
def test_families_predict_every_row_and_beat_the_mean(rows, name, configs):
    preds = md.predict_grid(name, configs, rows, rows, "y", "id")
    for config, pred in zip(configs, preds, strict=True):
        _finite(pred, 20)
        if config.get("ccp_alpha", 0) == 0 and config.get("min_samples_split", 2) == 2:
            assert regression_metrics(pred, "y", "prediction").first()["r2"] > 0.3, config
    with pytest.raises(ValueError):
        md.predict_grid("XGBoost", [{}], rows, rows, "y", "id")


def test_model_queries_run_whole_grids():
    from wattline.operators import grid as gr
    from wattline.plans import q_models as q
    every = [(m, c) for m in gr.MODELS_TO_RUN for c in gr.combinations(m)]
    assert q.M9 == q.M10 == every and len(every) == 74
    for name, family in (("M3", "CART"), ("M4", "RandomForest"), ("M5", "Cubist"), ("M6", "SVM")):
        assert getattr(q, name) == gr.combinations(family)


def test_a_failing_configuration_is_recorded_alone(rows, monkeypatch):
    from wattline.plans import q_models as q
    data, fit = rows.withColumnsRenamed({"y": q.Y, "id": q.KEY}), md.predict_long

    def failing(name, configs, *rest):
        if any(c["fit_intercept"] == "bad" for c in configs):
            raise ValueError("bad")
        return fit(name, configs, *rest)

    monkeypatch.setattr(md, "predict_long", failing)
    got = q.isolated("LinearRegression", [dict(fit_intercept=x) for x in (True, "bad", False)], data, data)
    assert [r[1:] for r in got] == [("fit_intercept=True", "FINISHED", True, 20, 0, None), ("fit_intercept=bad", "FAILED", None, None, None, "ValueError: bad"),
                                    ("fit_intercept=False", "FINISHED", True, 20, 0, None)]


def test_pruning_rules():
    from wattline.operators.trees import Tree, pruned
    # root (8 rows) -> 1 (4 rows: leaves 3, 4), 2 (4 rows: leaves 5, 6)
    t = Tree(np.array([8.0, 4, 4, 2, 2, 2, 2]), np.array([10.0, 1, 4, 0, 0, 0, 0]), np.arange(7.0),
             np.array([1, 3, 5, -1, -1, -1, -1]), np.array([2, 4, 6, -1, -1, -1, -1]))
    assert pruned(t).below(0) == [3, 4, 5, 6]
    assert pruned(t, min_samples_split=5).below(0) == [1, 2]
    assert pruned(t, ccp_alpha=0.5).below(0) == [1, 5, 6]      # gain of 1: 1 * 4 / 8 = 0.5
    assert pruned(t, max_leaves=2).below(0) == [1, 2]
    assert pruned(t, ccp_alpha=99).below(0) == [0]


def test_model_is_stored_and_loaded(spark, sf_dir, tmp_path):
    from wattline.operators.scoring import UsageModel
    from wattline.plans.q_features import clean_split
    train = clean_split(spark, sf_dir).where(F.col("split") == "train")
    model = UsageModel.fit(train)
    again = UsageModel.load(model.save(str(tmp_path / "model")))
    a, b = (sorted(r["prediction"] for r in m.predict(train).collect()) for m in (model, again))
    assert a == b and len(a) > 0


def test_a_later_application_finds_only_what_is_committed(spark, tmp_path):
    """Two sessions with one shared folder: the first writes and publishes, the second reads."""
    import subprocess
    import sys
    code = """
import sys
from pyspark.sql import SparkSession
from wattline.sources import store
s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
if sys.argv[2] == "write":
    assert store.published(s, "t", "v1") is None
    lost = store.new_path(s, "t")
    s.range(3).write.parquet(lost)  # written, never committed
    path = store.new_path(s, "t")
    s.range(5).write.parquet(path)
    store.publish(s, "t", "v1", path)
else:
    assert s.read.parquet(store.published(s, "t", "v1")).count() == 5
    assert store.published(s, "t", "v2") is None
"""
    for step in ("write", "read"):
        subprocess.run([sys.executable, "-c", code, str(tmp_path), step], check=True, cwd=os.path.dirname(os.path.dirname(__file__)), timeout=120)


def test_request_to_model_row(spark):
    from wattline.operators.scoring import request_to_model_row
    from wattline.sources.requests import REQUEST_NUMERIC
    schema = "request_id bigint, " + ", ".join(f"`{c}` double" for c in REQUEST_NUMERIC) + \
             ", NSM string, Day_of_week string, WeekStatus string, Load_Type string"
    rows = [(1, 5.0, 3.5, 0.05, 85.2, 92.1, "43200", "Monday", "Weekday", "Medium_Load"),
            (2, 5.0, 3.5, 0.05, 85.2, 92.1, "0", "Sunday", "Weekend", "Light_Load"),
            (3, 5.0, 3.5, 0.05, 85.2, 92.1, "86399", "Friday", "Weekday", "Maximum_Load")]
    out = request_to_model_row(spark.createDataFrame(rows, schema))
    assert out.columns == ["request_id", "date", "lagging_current_reactive_power_kvarh",
                           "leading_current_reactive_power_kvarh", "co2_tco2", "lagging_current_power_factor",
                           "leading_current_power_factor", "nsm", "day_of_week", "week_status", "load_type"]
    types = dict(out.dtypes)
    assert types["nsm"] == "bigint" and types["date"] == "timestamp_ntz" and types["co2_tco2"] == "double"
    got = {r["request_id"]: r["nsm"] for r in out.collect()}
    assert got == {1: 43200, 2: 0, 3: 86399}


def test_stream_equals_batch(spark, sf_dir):
    from wattline.operators.validate import request_errors
    from wattline.plans.q_validate import REQ_DOMAINS
    from wattline.sources.requests import REQUEST_NUMERIC, requests
    from wattline.streaming.score_stream import read_table, run
    paths = run(spark, sf_dir, None)
    streamed = read_table(spark, paths["checked"])
    batch = request_errors(requests(spark, sf_dir), REQUEST_NUMERIC, "NSM", REQ_DOMAINS) \
        .select("request_id", "is_valid", F.array_join("errors", "; ").alias("errors"))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_svr_gap_and_loss(spark):
    """Every configuration's gap is below the limit, and no nearby coefficients are better."""
    from pyspark.ml.functions import array_to_vector
    from wattline.operators import grid as gr
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 20, 0] + [0, 5, 7]  # a constant feature too
    y = x[:, 0] * 2 + np.sin(x[:, 1] / 10) + rng.standard_t(2, 400)
    df = spark.createDataFrame([(i, float(t), [float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))], "id long, y double, x array<double>")
    configs = [c for c in gr.combinations("SVM") if (c["C"], c["kernel"]) in ((0.1, "linear"), (10, "rbf")) and c["gamma"] == "scale"]
    models = md.fit_svrs(df.select("id", "y", array_to_vector("x").alias("features")), "y", configs)
    for c, m in zip(configs, models, strict=True):
        assert 0 <= m.gap <= md.GAP
        z, t = m.features.z(x), (y - m.shift) / m.scale
        value = lambda w: 0.5 * w @ w + c["C"] * np.maximum(np.abs(t - z @ w) - 0.1, 0).sum()
        assert all(value(m.w) <= value(m.w + rng.normal(size=len(m.w)) * s) * (1 + md.GAP) for s in (1e-3, 1e-2, 0.1) for _ in range(20))
        r = t - z @ m.w
        assert np.abs(m.predict(x) - (m.shift + m.scale * (z @ m.w))).max() < 1e-9 and (np.abs(r) <= 0.1).any()
    flat = df.select("id", F.lit(2.0).alias("y"), array_to_vector("x").alias("features"))
    assert np.allclose(md.fit_svrs(flat, "y", configs[:1])[0].predict(x), 2.0)


@pytest.mark.parametrize("p, group", [(2, None), (1, None), (2, "g")])
def test_neighbours_equal_brute_force(spark, monkeypatch, p, group):
    """Many small balls, ties, repeated rows, groups of a row or two, parts of a ball."""
    from wattline.operators import knn
    monkeypatch.setattr(knn, "PIVOT_ROWS", 8)
    monkeypatch.setattr(knn, "PART_ROWS", 16)
    rng = np.random.default_rng(p)
    x = np.concatenate([rng.normal(size=(150, 3)).round(1), np.zeros((40, 3)), rng.normal(size=(60, 3)) * 0.01 + 50])
    g = [["a", "b", "c", "one"][0 if i % 3 else (1 if i % 2 else 2)] for i in range(249)] + ["one"]
    rows = [(i, [float(v) for v in r], k) for i, (r, k) in enumerate(zip(x, g))]
    df = spark.createDataFrame(rows, "id long, v array<double>, g string")
    got = {}
    for r in knn.nearest(df, df, "id", "id", "v", "v", k=5, p=p, group_col=group, exclude_self=True).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"]))
    for i in range(250):
        d = np.abs(x - x[i]).sum(axis=1) if p == 1 else np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        others = sorted((d[j], j) for j in range(250) if j != i and (group is None or g[j] == g[i]))[:5]
        assert [t for _, t in sorted(got.get(i, []))] == [j for _, j in others], i


@pytest.mark.parametrize("p", [1, 2])
def test_queries_that_reach_most_pivots_go_to_groups_in_small_batches(spark, monkeypatch, p):
    """Same neighbours where queries go to groups of pivots, and no task hands on all pairs of its queries at once."""
    from wattline.operators import knn
    monkeypatch.setattr(knn, "PIVOT_ROWS", 4)
    monkeypatch.setattr(knn, "GROUP_ROWS", 16)
    rng = np.random.default_rng(p)
    rows = [(i, [float(v) for v in r], "ab"[i % 2]) for i, r in enumerate(rng.normal(size=(150, 12)).round(1))]
    df = spark.createDataFrame(rows + [(500 + i, v, g) for i, v, g in rows[:20]], "id long, v array<double>, g string").checkpoint()

    def found(few, held):
        monkeypatch.setattr(knn, "FEW_PIVOTS", few)
        monkeypatch.setattr(knn, "HELD_ROWS", held)
        near = knn.nearest(df, df, "id", "id", "v", "v", k=4, p=p, group_col="g", exclude_self=True)
        return sorted((r["id"], r["nn_rank"], r["nn_id"], round(r["dist"], 9)) for r in near.collect())

    whole = found(10_000, 4096)
    assert len(whole) == 170 * 4 and found(0, 7) == whole and found(10_000, 7) == whole
