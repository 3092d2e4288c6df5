"""Operator edge rules: nulls, ties, empty input, constant columns, unknown categories."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import cleaning as cl
from wattline.operators import compare as cp
from wattline.operators import metrics as mt
from wattline.operators import profiling as pr
from wattline.operators import ranking as rk
from wattline.operators import validate as va
from wattline.operators.knn import nearest
from wattline.operators.ordering import prefix_sums, row_number
from wattline.operators.quantiles import exact_quantiles


def vals(spark, xs, name="x"):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(xs)],
                                 f"id bigint, {name} double")


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    xs = list(np.round(rng.normal(size=500), 3)) + [None]
    probs = [0.25, 0.5, 0.75]
    assert np.allclose(exact_quantiles(vals(spark, xs), "x", probs), np.quantile(xs[:-1], probs))
    assert exact_quantiles(vals(spark, xs).where("x > 1e9"), "x", probs) == [None] * 3


def test_iqr_filter_keeps_nulls_and_is_inclusive(spark):
    df = vals(spark, [1, 2, 3, 4, 100, None])
    out, (lo, hi) = cl.iqr_filter(df, "x", 1.5)
    kept = sorted(r["id"] for r in out.collect())
    assert kept == [0, 1, 2, 3, 5]
    q1, q3 = np.quantile([1, 2, 3, 4, 100], [0.25, 0.75])
    assert lo == q1 - 1.5 * (q3 - q1) and hi == q3 + 1.5 * (q3 - q1)


def test_iqr_all_null_column_drops_nothing(spark):
    df = vals(spark, [None, None])
    out, bounds = cl.iqr_filter(df, "x")
    assert out.count() == 2 and bounds == (None, None)


def test_chained_iqr_uses_survivors(spark):
    rows = [(i, float(i), float(1000 if i == 0 else i)) for i in range(20)] + [(20, 500.0, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double")
    out, rep = cl.chained_iqr(df, [("a", 1.5), ("b", 1.5)])
    ids = sorted(r["id"] for r in out.collect())
    assert 20 not in ids and 0 not in ids
    assert rep[1][3] is not None  # second step bounds computed on survivors


def test_row_number_dense_and_unique(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    out = row_number(df, ["k", "id"], "rn")
    rns = sorted(r["rn"] for r in out.collect())
    assert rns == list(range(1, 5001))
    first = out.where(F.col("rn") == 1).first()
    assert first["k"] == 0 and first["id"] == 0


def test_prefix_sums(spark):
    df = spark.createDataFrame([(float(v), c) for v, c in [(3, 1), (1, 2), (2, 5)]], "v double, c bigint")
    out = {r["v"]: (r["c_cum"], r["pos"]) for r in prefix_sums(df, ["v"], ["c"], rank_col="pos").collect()}
    assert out == {1.0: (2, 1), 2.0: (7, 2), 3.0: (8, 3)}


def test_histogram_last_bin_closed(spark):
    df = vals(spark, [0, 1, 2, 3, 10])
    h = pr.histogram(df, ["x"], bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 0, 0, 1]  # width 2; 10 is in the last bin
    const = pr.histogram(vals(spark, [2, 2]), ["x"], bins=2).orderBy("bin").collect()
    assert [r["lo_edge"] for r in const] == [1.5, 2.0]


def test_modes_keep_ties(spark):
    df = vals(spark, [1, 1, 2, 2, 3])
    m = sorted(r["value"] for r in pr.modes_table(df, ["x"]).collect())
    assert m == ["1", "2"]


def test_bias_corrected_moments(spark):
    xs = [1.0, 2.0, 4.0, 7.0, 11.0, 3.0]
    d = pr.describe(vals(spark, xs), ["x"], extended=True).first()
    n = len(xs)
    m = np.mean(xs)
    m2 = np.mean((np.array(xs) - m) ** 2)
    m3 = np.mean((np.array(xs) - m) ** 3)
    m4 = np.mean((np.array(xs) - m) ** 4)
    g1, g2 = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
    G1 = g1 * math.sqrt(n * (n - 1)) / (n - 2)
    G2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    assert abs(d["skew"] - G1) < 1e-6 and abs(d["kurt"] - G2) < 1e-6


def test_duplicate_count_null_safe(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert pr.duplicate_count(df).first()["n_duplicates"] == 1


def test_wasserstein_and_ks_match_formula(spark):
    a = [0.0, 1.0, 3.0]
    b = [5.0, 6.0, 8.0]
    df = spark.createDataFrame([(f"r{i}", v, "A") for i, v in enumerate(a)] + [(f"s{i}", v, "B") for i, v in enumerate(b)],
                               "id string, x double, tag string")
    w = cp.wasserstein(df, ["x"], "tag", "A", "B").first()["wasserstein"]
    assert abs(w - 5.0) < 1e-9  # a shift by 5
    ks = cp.ks_statistic(df, ["x"], "tag", "A", "B").first()["ks"]
    assert ks == 1.0


def test_regression_metrics_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert mt.regression_metrics(df, "y", "p").first()["r2"] == 1.0
    df2 = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert mt.regression_metrics(df2, "y", "p").first()["r2"] == 0.0


def test_classification_metrics_weighted(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    m = mt.classification_metrics(spark.createDataFrame(rows, "y string, p string"), "y", "p").first()
    assert abs(m["accuracy"] - 0.6) < 1e-12
    # class c is never predicted: its precision counts as 0
    assert 0 <= m["precision"] <= 1 and abs(m["recall"] - 0.6) < 1e-12


def test_rankings_ties_keep_input_order(spark):
    res = spark.createDataFrame([(1, "A", {}, 1.0, 1.0, 0.5, 1.0), (2, "B", {"k": "3"}, 1.0, 2.0, 0.9, 1.0)],
                                "run_ord int, model string, params map<string,string>, rmse double, mae double, r2 double, cv double")
    r = {(x["criterion"], x["rank"]): x["model"] for x in rk.rankings(res).collect()}
    assert r[("RMSE", 1)] == "A" and r[("R2", 1)] == "B"
    with pytest.raises(ValueError):
        rk.best_by_criterion(res, "multi_criteria")


def test_request_validation_cases(spark):
    from wattline.plans.q_validate import REQ_DOMAINS
    from wattline.sources.requests import REQUEST_NUMERIC
    base = dict(zip(REQUEST_NUMERIC, [5.0, 3.5, 0.05, 85.2, 92.1]))
    good = {**base, "NSM": "43200", "Day_of_week": "Monday", "WeekStatus": "Weekday", "Load_Type": "Medium_Load"}
    cases = [good, {**good, REQUEST_NUMERIC[0]: None}, {**good, "NSM": "90000"}, {**good, "NSM": "-100"},
             {**good, "Day_of_week": "Funday"}, {**good, "WeekStatus": "X"}, {**good, "Load_Type": "Y"},
             {**good, "NSM": "noon"}, {**good, "NSM": None}, {**good, "NSM": "0"}, {**good, "NSM": "86399"}]
    cols = REQUEST_NUMERIC + ["NSM", "Day_of_week", "WeekStatus", "Load_Type"]
    rows = [(i, *[c[k] for k in cols]) for i, c in enumerate(cases)]
    schema = "request_id bigint, " + ", ".join(f"`{c}` double" for c in REQUEST_NUMERIC) + \
             ", NSM string, Day_of_week string, WeekStatus string, Load_Type string"
    out = va.request_errors(spark.createDataFrame(rows, schema), REQUEST_NUMERIC, "NSM", REQ_DOMAINS)
    valid = {r["request_id"]: r["is_valid"] for r in out.collect()}
    assert valid == {0: True, 1: False, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False,
                     8: False, 9: True, 10: True}
    with pytest.raises(ValueError):
        va.require_non_empty(spark.createDataFrame([], schema))


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    tr = rng.normal(size=(300, 4))
    qs = rng.normal(size=(40, 4))
    train = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(tr)], "tid bigint, v array<double>")
    query = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(qs)], "qid bigint, v array<double>")
    got = nearest(query, train, "qid", "tid", "v", "v", k=3, p=2)
    res = {}
    for r in got.collect():
        res.setdefault(r["qid"], []).append((r["nn_rank"], r["tid"]))
    for q in range(40):
        d = np.sqrt(((tr - qs[q]) ** 2).sum(axis=1))
        want = list(np.argsort(d, kind="stable")[:3])
        assert [t for _, t in sorted(res[q])] == want


def test_param_grid_counts(spark):
    from wattline.operators.grid import combination_counts, combinations, grid_frame
    counts = {r["model"]: r["n_combinations"] for r in combination_counts(grid_frame(spark)).collect()}
    assert counts == {"LinearRegression": 2, "KNN": 16, "CART": 16, "RandomForest": 16, "Cubist": 12,
                      "SVM": 12, "TOTAL": 74}
    assert len(combinations("SVM")) == 12
    with pytest.raises(ValueError):
        combinations("XGBoost")


def test_knn_within_group_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(200, 3))
    grp = rng.integers(0, 3, size=200)
    df = spark.createDataFrame([(i, int(g), [float(x) for x in v]) for i, (g, v) in enumerate(zip(grp, pts))],
                               "id bigint, g int, v array<double>")
    got = nearest(df, df, "id", "id", "v", "v", k=4, p=2, group_col="g", exclude_self=True)
    res = {}
    for r in got.collect():
        res.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"]))
    for i in range(200):
        same = [j for j in range(200) if grp[j] == grp[i] and j != i]
        d = np.sqrt(((pts[same] - pts[i]) ** 2).sum(axis=1))
        want = [same[j] for j in np.argsort(d, kind="stable")[:4]]
        assert [t for _, t in sorted(res[i])] == want


def test_grouped_quantiles_match_numpy_and_keep_null_groups(spark):
    from wattline.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(11)
    rows = [(str(g), float(v)) for g, v in zip(rng.integers(0, 4, 400), np.round(rng.normal(size=400), 2))]
    rows += [("hot", 1.0)] * 300 + [("hot", 2.0)] * 5  # a hot group with a hot value
    rows += [(None, 5.0), (None, 6.0), ("z", None), ("z", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["q1"], r["m"]) for r in grouped_quantiles(df, ["g"], "x", [0.25, 0.5], ["q1", "m"]).collect()}
    assert got["z"] == (None, None) and got[None] == (5.25, 5.5)
    for k in got.keys() - {"z", None}:
        assert np.allclose(got[k], np.quantile([v for g, v in rows if g == k], [0.25, 0.5]))


def test_selection_by_sketch_and_bracket(spark, monkeypatch):
    from wattline.operators import selection as se
    monkeypatch.setattr(se, "FEW", 5)
    rng = np.random.default_rng(4)
    for xs in (rng.normal(size=4000), np.round(rng.normal(size=4000), 1), np.exp(20 * rng.normal(size=2000)), np.repeat([1.0, 2.0], [999, 1]),
               np.array([1e308, -1e308, 0.0, 5.0] * 10), np.append(rng.normal(size=500), [np.inf, -np.inf, np.inf])):
        df = spark.createDataFrame([(float(v), None) for v in xs] + [(None, None), (float("nan"), None)], "x double, y double")
        ranks = sorted({0, 1, len(xs) // 3, len(xs) // 2, len(xs) - 1})
        found = se.select_ranks(df, {"x": F.col("x"), "y": F.col("y")}, lambda name, n, rows: ranks)
        assert found["x"].n == len(xs) and found["y"].n == 0
        for r in ranks:
            v = np.sort(xs)[r]
            assert found["x"].at[r] == (v, (xs < v).sum(), (xs == v).sum())
    whole = rng.integers(-2 ** 59, 2 ** 59, 3000)
    df = spark.createDataFrame([(int(v),) for v in whole], "x long")
    assert se.select_ranks(df, {"x": F.col("x")}, lambda name, n, rows: [1234])["x"].at[1234][0] == int(np.sort(whole)[1234])


def test_selection_takes_three_passes_whatever_the_range(spark, monkeypatch):
    """Values over 600 decades, all equal but one, two far clusters: the number of passes
    depends on the number of rows only."""
    from wattline.operators import selection as se
    passes = []
    monkeypatch.setattr(se, "FEW", 2_000)
    for name in ("_narrowed", "_picked"):
        real = getattr(se, name)
        monkeypatch.setattr(se, name, lambda *a, real=real: (passes.append(1), real(*a))[1])
    n = 100_000
    for value in ("pow(10D, (id * 7919 % 100000) / 100000D * 600 - 300)", "if(id = 5, 1e300D, 1D)", "if(id % 2 = 0, -1e200D, 1e-200D) * (1 + id)"):
        df = spark.range(n).selectExpr(f"{value} AS x")
        passes.clear()
        ranks = [0, n // 4, n // 2, 3 * n // 4, n - 1]
        found = se.select_ranks(df, {"x": F.col("x")}, lambda *_: ranks)["x"].at
        xs = np.sort([r["x"] for r in df.collect()])
        assert {r: found[r][0] for r in ranks} == {r: xs[r] for r in ranks}
        assert len(passes) <= 2  # and the first sketch


def test_a_sketch_that_errs_costs_a_pass_only(spark, monkeypatch):
    from wattline.operators import selection as se
    monkeypatch.setattr(se, "ERROR", 0.0)
    monkeypatch.setattr(se, "SKETCH_K", 8)
    df = spark.range(20_000).selectExpr("(id * 7919 % 20011) AS x", "if(id % 3 = 0, null, cast(id as double)) AS y")
    found = se.select_ranks(df, {"x": F.col("x"), "y": F.col("y")}, lambda *_: [0, 17, 9_999, 13_332])
    xs = np.sort([r["x"] for r in df.collect()])
    assert {r: found["x"].at[r][0] for r in (0, 17, 9_999, 13_332)} == {r: xs[r] for r in (0, 17, 9_999, 13_332)}
    assert found["y"].n == 13_333 and found["y"].at[13_332][0] == 19_999.0


def test_splits_with_null_keys(spark):
    """Nulls sort last in every key: they are the latest rows of a time split."""
    from wattline.operators.ordering import random_split, time_split
    rows = [(None if i % 10 < 3 else i % 20, None if i % 7 == 0 else i, i) for i in range(100)]
    df = spark.createDataFrame(rows, "t long, k long, id long")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2]))
    for size in (0.2, 0.3, 0.5, 0.75):
        got = {r["id"] for r in time_split(df, ["t", "k", "id"], size).where("split = 'test'").collect()}
        assert got == {r[2] for r in order[-math.ceil(size * 100):]}
        assert random_split(df, "t", test_size=size, tie_break=["k", "id"]).where("split = 'test'").count() == math.ceil(size * 100)
    assert time_split(df.where("t is null"), ["t", "k", "id"], 0.2).where("split = 'train'").count() == 24
    assert time_split(df.where("id < 0"), ["t", "k", "id"], 0.2).count() == 0


def test_cleaning_a_filtered_table_uses_its_own_bounds(spark, sf_dir):
    from wattline.operators.cleaning import clean_readings
    from wattline.sources.readings import readings_dirty
    full = readings_dirty(spark, sf_dir)
    few = full.where("reading_id % 3 = 0")
    alone = clean_readings(few).count()
    clean_readings(full).count()
    assert clean_readings(few).count() == alone


def test_indices_beyond_32_bits_are_drawn(spark):
    from wattline.functions.draws import hash60
    top = spark.range(2000).select((hash60(1, "s", F.col("id")) % (1 << 40)).alias("h")).agg(F.max("h")).first()[0]
    assert top > 1 << 39


def test_noise_and_pairs_do_not_depend_on_partitions(spark):
    from wattline.operators.augment import mixed_pairs, noisy
    rng = np.random.default_rng(2)
    rows = [(i, float(v), ["A", "B", "C"][i % 3]) for i, v in enumerate(np.round(rng.gamma(2.0, 10.0, 300), 2))]
    base = spark.createDataFrame(rows, "rid bigint, usage double, load string")

    def run(parts):
        df = base.repartition(parts)
        pairs = mixed_pairs(df, "rid", ["usage"], ["load"], seed=9).select("i", F.round("usage", 9), "load")
        return sorted(map(tuple, noisy(df, "rid", ["usage"]).select("rid", F.round("usage", 9)).collect())), sorted(map(tuple, pairs.collect()))
    one, five = run(1), run(5)
    assert one == five and len(one[0]) == len(one[1]) == 300


def test_random_split_is_exact(spark):
    from wattline.operators.ordering import random_split
    df = spark.range(103).select(F.floor(F.col("id") / 2).alias("k"), "id")
    out = random_split(df, "k", tie_break=["id"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"test": 21, "train": 82}


def test_time_split_takes_the_latest_ceil_share(spark):
    from wattline.operators.ordering import time_split
    df = spark.range(33).select(F.col("id").alias("k"), (F.col("id") % 7).alias("t"))
    out = time_split(df, ["t", "k"], 0.2)
    test = sorted((r["t"], r["k"]) for r in out.where(F.col("split") == "test").collect())
    assert len(test) == math.ceil(0.2 * 33) == 7
    assert test == sorted((k % 7, k) for k in range(33))[-7:]  # the latest rows in (t, k) order


def test_binned_density_is_near_the_exact_one(spark):
    from wattline.operators.profiling import kde
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.gamma(2, 10, 900), [400.0], np.full(50, 7.0)]).round(2)
    got = kde(spark.createDataFrame([(float(x), "a") for x in xs] + [(1.0, "b"), (None, "a")], "x double, g string"), "x", "g").orderBy("grid_index").collect()
    bw = xs.std(ddof=1) * len(xs) ** -0.2
    grid = np.linspace(xs.min() - 3 * bw, xs.max() + 3 * bw, 200)
    exact = np.exp(-0.5 * ((grid[:, None] - xs) / bw) ** 2).sum(axis=1) / (len(xs) * bw * math.sqrt(2 * math.pi))
    assert len(got) == 200 and np.allclose([r["x"] for r in got], grid, atol=1e-8)
    assert np.abs(np.array([r["density"] for r in got]) - exact).max() < 1e-5 * exact.max() * 10
    assert kde(spark.createDataFrame([], "x double, g string"), "x", "g").count() == 0


def test_bootstrap_interval_covers_like_the_normal_one(spark):
    from wattline.operators.profiling import POISSON_STEPS, mean_ci
    assert POISSON_STEPS[0] == round(4096 / math.e)
    rng = np.random.default_rng(6)
    xs = rng.normal(50, 10, 2000)
    df = spark.createDataFrame([(i, float(x), None if i % 4 == 0 else "k") for i, x in enumerate(xs)] + [(9999, None, "k")], "id long, x double, k string")
    for part in (df, df.repartition(5)):
        rows = {r["key"]: r for r in mean_ci(part, "x", F.col("k"), "id").collect()}
        for key, own in ((None, xs[::4]), ("k", np.delete(xs, np.arange(0, 2000, 4)))):
            half = 1.96 * own.std(ddof=1) / math.sqrt(len(own))
            assert rows[key]["n"] == len(own)
            assert abs(rows[key]["ci_lo"] - (own.mean() - half)) < 0.35 * half and abs(rows[key]["ci_hi"] - (own.mean() + half)) < 0.35 * half


def test_sparse_indicators_of_many_categories(spark):
    from wattline.operators.features import sparse_indicators
    df = spark.range(3000).selectExpr("id", "if(id % 100 = 0, null, concat('v', id % 2500)) AS c", "cast(id % 3 AS string) AS d")
    out = sparse_indicators(df.where("id < 2000"), df, ["c", "d"])
    seen = sorted({f"v{i % 2500}" for i in range(2000) if i % 100})
    for r in out.where("id in (0, 1, 1999, 2400, 2999)").collect():
        i = r["id"]
        want = ([seen.index(f"v{i % 2500}")] if i % 100 and f"v{i % 2500}" in seen else []) + [len(seen) + i % 3]
        assert (r["indicators"]["size"], r["indicators"]["indices"], r["indicators"]["values"]) == (len(seen) + 3, want, [1.0] * len(want))
    assert out.count() == 3000


def test_bootstrap_of_several_groupings_is_one_pass_over_the_draws(spark):
    """All groupings share a row's draws, and a task hands on sums by key, not a row for each row and replicate."""
    from wattline.operators.profiling import PER_HASH, POISSON_STEPS, _replicate_sums, bootstrap_digits, mean_ci_by
    import hashlib
    data = [(i % 90 if i % 7 else None, float(i % 13) + 0.25, f"a{i % 3}", None if i % 5 == 0 else "b") for i in range(400)] + [(5, None, "a0", "b")]
    df = spark.createDataFrame(data, "id long, x double, k string, m string").repartition(3)
    rows = df.where("x is not null").select("k", "m", F.col("x").alias("_x"), bootstrap_digits("id", 25, 42).alias("_digits"))
    assert _replicate_sums(rows, ["k", "m"], 25).count() <= 3 * 5

    def weight(i, b):
        digest = hashlib.md5(":".join(["42", f"boot.{b // PER_HASH}"] + ([] if i is None else [str(i)])).encode()).hexdigest()
        return sum(int(digest[3 * (b % PER_HASH):][:3], 16) >= t for t in POISSON_STEPS)

    got = {(r["grain"], r["key"]): r for r in mean_ci_by(df, "x", {"one": F.col("k"), "two": F.col("m")}, "id", replicates=25).collect()}
    assert len(got) == 5
    for (grain, key), r in got.items():
        own = [(i, x) for i, x, *ks in data if x is not None and ks[grain == "two"] == key]
        means = [sum(weight(i, b) * x for i, x in own) / sum(weight(i, b) for i, _ in own) for b in range(25)]
        assert r["n"] == len(own)
        assert np.allclose([r["ci_lo"], r["ci_hi"]], np.quantile(means, [0.025, 0.975]), atol=1e-6)
