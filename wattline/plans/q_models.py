"""Queries for model fitting, scoring and comparison.

Fits by Spark ML aren't reproducible in SQL, so their queries return what must hold
of them: how many rows were predicted, that every prediction is finite, and that the
model beats the mean of the training rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wattline.operators import baselines as bl
from wattline.operators import features as fe
from wattline.operators import forest
from wattline.operators import grid as gr
from wattline.operators import knn
from wattline.operators import models as md
from wattline.operators import rules as ru
from wattline.operators.metrics import classification_metrics, regression_metrics, residual_columns
from wattline.operators.ordering import random_split, time_split
from wattline.operators.smote import oversampled
from wattline.plans import sqlgen as S
from wattline.plans.q_features import SPLIT_CLEAN, clean_split
from wattline.plans.q_ranking import SPLIT_CTES
from wattline.plans.registry import register
from wattline.sources import store
from wattline.sources.tables import load, table_version

FEATS = ["l_quantity", "l_discount", "l_tax"]
Y, KEY = "usage_kwh", "reading_id"


def encoded_split(spark, sf_dir):
    """(train, test) of the cleaned readings, encoded with the training statistics."""
    sp = clean_split(spark, sf_dir)
    encoder = fe.ReadingsEncoder.fit_on(sp.where(F.col("split") == "train"))
    rows = knn.stored(knn.spread(encoder.transform(sp).select(KEY, Y, "load_type", "split", "features")))
    return rows.where(F.col("split") == "train").drop("split"), rows.where(F.col("split") == "test").drop("split")


def text_of(params: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in params.items()) or "default"


def grid_rows(name: str, configs: list[dict], train, test, label: str = Y):
    """One row per configuration: rows predicted, predictions that aren't finite, and
    whether the error is below that of the rows' mean (null for a lone tree on random
    subsets of the features, which may be worse on few rows)."""
    p, y = F.col("prediction"), F.col(label)
    bad = F.count(F.when(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf")), 1))
    r2 = 1 - F.sum((y - p) * (y - p)) / (F.var_pop(label) * F.count(F.lit(1)))
    rows = md.predict_long(name, configs, train, test, label, KEY).groupBy("config").agg(
        F.count(F.lit(1)).alias("n_test"), bad.alias("n_bad"), (F.lit(None).cast("boolean") if name == "CART" else r2 > 0).alias("beats_mean"))
    names = F.array(*[F.lit(text_of(c)) for c in configs])
    return rows.select(F.lit(name).alias("model"), F.element_at(names, F.col("config") + 1).alias("hyperparameters"), "n_test", "n_bad", "beats_mean")


def sanity_sql(rows: list[tuple[str, dict]]) -> str:
    return S.with_(SPLIT_CLEAN, " UNION ALL ".join(
        f"SELECT {S.lit(m)} AS model, {S.lit(text_of(p))} AS hyperparameters, count(*) AS n_test, CAST(0 AS BIGINT) AS n_bad, {'CAST(NULL AS BOOLEAN)' if m == 'CART' else 'true'} AS beats_mean "
        "FROM csp WHERE split = 'test'" for m, p in rows))


M1_SQL = S.with_(SPLIT_CTES + ["tr AS (SELECT * FROM sp WHERE split = 'train')"],
                 "SELECT true AS fit_intercept, " + S.r("regr_slope(l_extendedprice, l_quantity)", 4) + " AS coef, "
                 + S.r("regr_intercept(l_extendedprice, l_quantity)", 2) + " AS intercept FROM tr UNION ALL "
                 "SELECT false, " + S.r("sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity)", 4)
                 + ", 0.0 FROM tr")


def lineitem_train(spark, sf_dir, features):
    li = load(spark, sf_dir, "lineitem").select(*bl.LINEITEM_ORDER, "l_extendedprice", *FEATS)
    train = time_split(li, bl.LINEITEM_ORDER, 0.2).where(F.col("split") == "train")
    return train.withColumn("features", array_to_vector(F.array(*features)))


@register("m1_ols", M1_SQL)
def m1_ols(spark, sf_dir):
    train = lineitem_train(spark, sf_dir, ["l_quantity"])
    rows = []
    for fi in (True, False):
        m = md.fit_ols(train, "l_extendedprice", fit_intercept=fi)
        rows.append((fi, float(m.coefficients[0]), float(m.intercept)))
    df = spark.createDataFrame(rows, "fit_intercept boolean, coef double, intercept double")
    return df.select("fit_intercept", (F.round("coef", 4) + F.lit(0.0)).alias("coef"),
                     (F.round("intercept", 2) + F.lit(0.0)).alias("intercept"))


M1_ALL_SQL = S.with_(SPLIT_CTES, " UNION ALL ".join(
    f"SELECT {fi} AS fit_intercept, count(*) AS n_train, CAST(0.0 AS DOUBLE) AS correlation FROM sp WHERE split = 'train'" for fi in ("true", "false")))


@register("m1_ols_all_features", M1_ALL_SQL)
def m1_ols_all_features(spark, sf_dir):
    """Least squares on all features: the residuals are orthogonal to every one of them
    (and to the constant, if there is one). `correlation` is the largest cosine."""
    train, out = lineitem_train(spark, sf_dir, FEATS), None
    for fi in (True, False):
        res = md.fit_ols(train, "l_extendedprice", fit_intercept=fi).transform(train).withColumn("_r", F.col("l_extendedprice") - F.col("prediction"))
        sides = [F.col(c) for c in FEATS] + ([F.lit(1.0)] if fi else [])
        cosine = [F.abs(F.sum(F.col("_r") * x)) / F.sqrt(F.sum(F.col("_r") * F.col("_r")) * F.sum(x * x)) for x in sides]
        row = res.agg(F.lit(fi).alias("fit_intercept"), F.count(F.lit(1)).alias("n_train"), (F.round(F.greatest(*cosine), 6) + F.lit(0.0)).alias("correlation"))
        out = row if out is None else out.unionByName(row)
    return out


EMB_SPLIT = ("e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS DOUBLE) AS y, "
             "row_number() OVER (ORDER BY vec_id) AS pos, count(*) OVER () AS n FROM embeddings), "
             "sp AS (SELECT *, pos <= n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS is_train FROM e)")
KNN_GRID = gr.combinations("KNN")
M2_SQL = ("WITH " + EMB_SPLIT + ", pairs AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.y, p, CASE WHEN p = 1 THEN "
          "list_sum(list_transform(range(1, len(q.v) + 1), lambda i: abs(q.v[i] - t.v[i]))) ELSE list_distance(q.v, t.v) END AS dist "
          "FROM sp q, sp t, (VALUES (1), (2)) w(p) WHERE NOT q.is_train AND t.is_train), "
          "top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, p ORDER BY dist, tid) AS r FROM pairs) WHERE r <= 11) "
          + " UNION ALL ".join(
              f"SELECT qid AS vec_id, {S.lit(', '.join(f'{k}={v}' for k, v in c.items()))} AS hyperparameters, "
              + S.r("avg(y)" if c["weights"] == "uniform" else
                    "CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) = 1 THEN avg(CASE WHEN dist = 0 THEN y END) "
                    "ELSE sum(y / dist) / sum(1.0 / dist) END")
              + f" AS prediction FROM top WHERE p = {c['p']} AND r <= {c['n_neighbors']} GROUP BY qid" for c in KNN_GRID))


def embeddings_split(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("y"))
    return time_split(emb, ["vec_id"], 0.2)


@register("m2_knn_regression", M2_SQL)
def m2_knn_regression(spark, sf_dir):
    """All 16 configurations; neighbours are found once per distance."""
    sp = embeddings_split(spark, sf_dir)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    most, near, out = max(c["n_neighbors"] for c in KNN_GRID), {}, None
    for c in KNN_GRID:
        if c["p"] not in near:
            near[c["p"]] = knn.stored(knn.nearest(test, train, "vec_id", "vec_id", "embedding", "embedding", k=most, p=c["p"]))
        few = near[c["p"]].where(F.col("nn_rank") <= c["n_neighbors"])
        pred = knn.knn_regress(few, train, "vec_id", "vec_id", "y", c["weights"]).select(
            "vec_id", F.lit(text_of(c)).alias("hyperparameters"), (F.round("prediction", 6) + F.lit(0.0)).alias("prediction"))
        out = pred if out is None else out.unionByName(pred)
    return out


M3 = gr.combinations("CART")


@register("m3_cart", sanity_sql([("CART", c) for c in M3]))
def m3_cart(spark, sf_dir):
    return grid_rows("CART", M3, *encoded_split(spark, sf_dir))


def _best_split_sql(name: str, rows: str) -> list[str]:
    """CTEs of the best split of every node of `rows` (node, f0.., y): `{name}`(node, f, thr, gain)."""
    long = " UNION ALL ".join(f"SELECT node, {j} AS f, f{j} AS v, y FROM {rows}" for j in range(len(FEATS)))
    return [f"{name}_c AS (SELECT node, f, v, count(*) AS n, sum(y) AS s FROM ({long}) GROUP BY 1, 2, 3)",
            f"{name}_r AS (SELECT node, f, v, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY node, f) AS an, sum(s) OVER (PARTITION BY node, f) AS tot, "
            f"lead(v) OVER w AS nv FROM {name}_c WINDOW w AS (PARTITION BY node, f ORDER BY v))",
            f"{name} AS (SELECT node, f, (v + nv) / 2 AS thr FROM (SELECT *, ls * ls / ln + (tot - ls) * (tot - ls) / (an - ln) - tot * tot / an AS gain FROM {name}_r "
            "WHERE nv IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)"]


def _side(split: str, rows: str) -> str:
    value = "CASE b.f " + " ".join(f"WHEN {j} THEN f{j}" for j in range(len(FEATS))) + " END"
    return f"SELECT r.* REPLACE (2 * r.node + CASE WHEN {value} <= b.thr THEN 0 ELSE 1 END AS node) FROM {rows} r JOIN {split} b ON b.node = r.node"


M3_EXACT_SQL = S.with_(
    ["li AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position, count(*) OVER () AS total FROM lineitem)",
     "r1 AS (SELECT 1 AS node, " + ", ".join(f"{c} AS f{j}" for j, c in enumerate(FEATS))
     + ", l_extendedprice AS y FROM li WHERE position <= total - CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT))"]
    + _best_split_sql("b1", "r1") + [f"r2 AS ({_side('b1', 'r1')})"] + _best_split_sql("b2", "r2") + [f"r3 AS ({_side('b2', 'r2')})",
     "every AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)", "best AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2)"],
    "SELECT CAST(e.node AS BIGINT) AS node, CAST(count(*) AS DOUBLE) AS n_rows, " + S.r("avg(y)", 4) + " AS value, CAST(coalesce(any_value(best.f), -1) AS INT) AS feature, "
    + S.r("coalesce(any_value(best.thr), 0)", 6) + " AS threshold FROM every e LEFT JOIN best ON best.node = e.node GROUP BY e.node")


@register("m3_exact_splits", M3_EXACT_SQL)
def m3_exact_splits(spark, sf_dir):
    """A tree of depth 2 on lineitem: thresholds, sizes and means of all its nodes."""
    train = lineitem_train(spark, sf_dir, FEATS).withColumn("_key", F.lit(0).cast("long"))
    nodes = forest.grow(forest.bootstrap_rows(train, "l_extendedprice", "_key", 1, bootstrap=False), 2)
    return nodes.select("node", F.col("rows").alias("n_rows"), (F.round("value", 4) + F.lit(0.0)).alias("value"), "feature", (F.round("threshold", 6) + F.lit(0.0)).alias("threshold"))


M4 = gr.combinations("RandomForest")


@register("m4_random_forest", sanity_sql([("RandomForest", c) for c in M4]))
def m4_random_forest(spark, sf_dir):
    return grid_rows("RandomForest", M4, *encoded_split(spark, sf_dir))


M5 = gr.combinations("Cubist")


@register("m5_model_tree", sanity_sql([("Cubist", c) for c in M5]))
def m5_model_tree(spark, sf_dir):
    return grid_rows("Cubist", M5, *encoded_split(spark, sf_dir))


def _adjusted_sql(sse: str, n: str, v: str) -> str:
    return f"sqrt(greatest({sse}, 0) / ({n})) * (({n}) + ({v})) / (({n}) - ({v}))"


RULE_CTES = ["li AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position, count(*) OVER () AS total FROM lineitem)",
             "sp AS (SELECT l_orderkey, l_linenumber, l_partkey, 1 AS node, l_quantity AS f0, l_extendedprice AS y, position <= total - CAST(ceil(CAST(0.2 AS DOUBLE) * total) AS BIGINT) AS is_train FROM li)",
             "r1 AS (SELECT node, f0, y FROM sp WHERE is_train)",
             "c AS (SELECT f0 AS v, count(*) AS n, sum(y) AS s FROM r1 GROUP BY 1)",
             "run AS (SELECT v, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER () AS an, sum(s) OVER () AS tot, lead(v) OVER w AS nv FROM c WINDOW w AS (ORDER BY v))",
             "b AS (SELECT (v + nv) / 2 AS thr FROM (SELECT *, ls * ls / ln + (tot - ls) * (tot - ls) / (an - ln) AS gain FROM run WHERE nv IS NOT NULL AND ln >= 4 AND an - ln >= 4) ORDER BY gain DESC, v LIMIT 1)",
             # of all rows (0) and of either side: count, the fits of a line and of a constant
             "side AS (SELECT 0 AS rule, f0, y FROM r1 UNION ALL SELECT CASE WHEN f0 <= thr THEN 1 ELSE 2 END, f0, y FROM r1, b)",
             "m AS (SELECT rule, count(*) AS n, regr_slope(y, f0) AS s1, regr_intercept(y, f0) AS s0, avg(y) AS ybar, regr_syy(y, f0) AS syy, regr_sxy(y, f0) AS sxy, regr_sxx(y, f0) AS sxx FROM side GROUP BY 1)",
             f"k AS (SELECT *, {_adjusted_sql('syy', 'n', '1')} > {_adjusted_sql('syy - sxy * sxy / sxx', 'n', '2')} AS line FROM m)",
             "fit AS (SELECT rule, n, CASE WHEN line THEN s1 ELSE 0 END AS c1, CASE WHEN line THEN s0 ELSE ybar END AS c0 FROM k)",
             "sm AS (SELECT a.rule, (a.n * a.c1 + 15 * r.c1) / (a.n + 15) AS c1, (a.n * a.c0 + 15 * r.c0) / (a.n + 15) AS c0 FROM fit a, fit r WHERE a.rule > 0 AND r.rule = 0)",
             "err AS (SELECT sm.rule, any_value(c0) AS c0, any_value(c1) AS c1, count(*) AS na, sum((y - c0 - c1 * f0) ** 2) AS qa, count(*) FILTER ((f0 <= thr) = (sm.rule = 1)) AS ns, "
             "sum((y - c0 - c1 * f0) ** 2) FILTER ((f0 <= thr) = (sm.rule = 1)) AS qs, any_value(thr) AS thr, any_value(CASE WHEN c1 <> 0 THEN 2 ELSE 1 END) AS v FROM sm, r1, b GROUP BY sm.rule)",
             f"ad AS (SELECT *, {_adjusted_sql('qa', 'na', 'v')} AS ea, {_adjusted_sql('qs', 'ns', 'v')} AS es FROM err)",
             "rules AS (SELECT rule, CASE WHEN ea <= es THEN '' WHEN rule = 1 THEN '<=' ELSE '>' END AS op, thr, CASE WHEN ea <= es THEN na ELSE ns END AS n_rows, least(ea, es) AS error, c0, c1 FROM ad)"]


def lineitem_rules(spark, sf_dir):
    """(rule set of at most two rules on one feature, training rows, test rows)."""
    li = load(spark, sf_dir, "lineitem").select(*bl.LINEITEM_ORDER, "l_extendedprice", "l_quantity")
    sp = time_split(li, bl.LINEITEM_ORDER, 0.2).withColumn("features", array_to_vector(F.array("l_quantity")))
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return md.fit_committees(train, "l_extendedprice", 1, [2]), train, test


@register("m5_rule_table", S.with_(RULE_CTES, "SELECT CAST(rule - 1 AS INT) AS rule, CASE WHEN op = '' THEN '' ELSE 'l_quantity ' || op || ' ' || CAST(CAST(thr AS DECIMAL(18, 2)) AS VARCHAR) END AS conditions, n_rows, "
                                   + S.r("error", 4) + " AS error, " + S.r("c0", 3) + " AS intercept, " + S.r("c1", 4) + " AS l_quantity FROM rules"))
def m5_rule_table(spark, sf_dir):
    """The rules of one member of at most two: conditions left, rows covered, adjusted
    error, pruned and smoothed model."""
    members, _, _ = lineitem_rules(spark, sf_dir)
    table = ru.rule_table(spark, [m.sets[0] for m in members], ["l_quantity"])
    text = F.array_join(F.transform("conditions", lambda c: F.concat_ws(" ", c["feature"], c["op"], c["value"].cast("decimal(18,2)").cast("string"))), " and ")
    return table.select("rule", text.alias("conditions"), "n_rows", (F.round("error", 4) + F.lit(0.0)).alias("error"), (F.round("intercept", 3) + F.lit(0.0)).alias("intercept"),
                        (F.round(F.coalesce(F.col("coefficients")["l_quantity"], F.lit(0.0)), 4) + F.lit(0.0)).alias("l_quantity"))


@register("m5_rule_predictions", S.with_(RULE_CTES, "SELECT l_orderkey, l_linenumber, l_partkey, " + S.r("avg(c0 + c1 * f0)", 3) + " AS prediction FROM sp JOIN rules ON op = '' OR (op = '<=' AND f0 <= thr) OR (op = '>' AND f0 > thr) "
                                         "WHERE NOT is_train GROUP BY ALL"))
def m5_rule_predictions(spark, sf_dir):
    """The test rows' predictions: the mean over the rules that cover a row."""
    members, _, test = lineitem_rules(spark, sf_dir)
    pred = md.committee_column(members, [(0, 1)], test)
    return pred.select(*bl.LINEITEM_KEYS, (F.round(F.element_at("predictions", 1), 3) + F.lit(0.0)).alias("prediction"))


M6 = gr.combinations("SVM")


@register("m6_svr", sanity_sql([("SVM", c) for c in M6]))
def m6_svr(spark, sf_dir):
    return grid_rows("SVM", M6, *encoded_split(spark, sf_dir))


M7_SQL = ("WITH " + EMB_SPLIT + " " + " UNION ALL ".join(
    f"SELECT '{k}' AS kernel, '{s}' AS split, count(*) AS n, CAST(0 AS BIGINT) AS n_unknown, {'true' if s == 'train' else 'CAST(NULL AS BOOLEAN)'} AS beats_majority FROM sp WHERE {'is_train' if s == 'train' else 'NOT is_train'}"
    for k in ("linear", "rbf") for s in ("train", "test")))


@register("m7_svc_classification", M7_SQL)
def m7_svc_classification(spark, sf_dir):
    """Classes of the embeddings: accuracy on the training rows above the share of the
    largest class (the labels of the test rows can't be told from their vectors)."""
    sp = embeddings_split(spark, sf_dir).select(F.col("y").cast("int").cast("string").alias("label"), "split",
                                                array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    train, out = sp.where(F.col("split") == "train"), None
    for kernel in ("linear", "rbf"):
        pred = md.predict_class(md.fit_svc(train, "label", kernel), sp)
        largest = sp.groupBy("split", "label").count().groupBy("split").agg((F.max("count") / F.sum("count")).alias("largest"))
        known = pred.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("predicted_label").isNull(), 1)).alias("n_unknown"))
        met = classification_metrics(pred, "label", "predicted_label", by=["split"])
        row = known.join(met, "split").join(largest, "split").select(
            F.lit(kernel).alias("kernel"), "split", "n", "n_unknown", F.when(F.col("split") == "train", F.col("accuracy") > F.col("largest")).alias("beats_majority"))
        out = row if out is None else out.unionByName(row)
    return out


@register("m8_fit_one_config", S.with_(SPLIT_CLEAN, f"SELECT {KEY}, {Y} AS actual, true AS predicted FROM csp WHERE split = 'test'"))
def m8_fit_one_config(spark, sf_dir):
    """Per test row, that one configuration gives it a finite prediction."""
    train, test = encoded_split(spark, sf_dir)
    config = dict(max_depth=10, min_samples_leaf=2, min_samples_split=2, ccp_alpha=0.0)
    pred = md.predict_grid("CART", [config], train, test, Y, KEY)[0]
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return pred.select(KEY, F.col(Y).alias("actual"), finite.alias("predicted"))


#: With the target among the features, as in the notebook, and without it.
SVC_FEATURES = ("with load_type", "without load_type")


@register("m7_kernel_svc", S.with_(SPLIT_CLEAN, "SELECT features, split, CASE WHEN split = 'test' THEN CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) ELSE n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) END AS n, "
                                   "CAST(0 AS BIGINT) AS n_unknown, CASE WHEN features LIKE 'without%' THEN CAST(NULL AS BOOLEAN) ELSE true END AS beats_majority, true AS converged "
                                   "FROM (SELECT count(*) AS n FROM csp), (VALUES ('with load_type'), ('without load_type')) f(features), (VALUES ('train'), ('test')) s(split)"))
def m7_kernel_svc(spark, sf_dir):
    """Kernel classifiers of load_type, one against one, fitted after oversampling: on the
    train and test rows of a random split, whether the accuracy is above the share of the
    largest class (not told where the features hold nothing of it)."""
    out = svc_metrics(spark, sf_dir)
    beats = F.when(F.col("features") == SVC_FEATURES[0], F.col("accuracy") > F.col("largest"))
    return out.select("features", "split", "n", "n_unknown", beats.alias("beats_majority"), (F.col("gap") <= md.GAP).alias("converged"))


def svc_metrics(spark, sf_dir):
    """Per features and split: rows, accuracy, precision, recall, F1, share of the largest
    class, largest duality gap of the fits."""
    rows = clean_split(spark, sf_dir).drop("split")
    sp = random_split(rows, KEY)
    encoder = fe.ReadingsEncoder.fit_on(sp.where(F.col("split") == "train"))
    every = knn.stored(encoder.transform(sp).select(KEY, "load_type", "split", vector_to_array("features").alias("x")))
    out = None
    for name in SVC_FEATURES:
        x = F.col("x") if name == SVC_FEATURES[0] else F.expr("slice(x, 1, size(x) - 1)")  # load_type is the last
        some = every.withColumn("x", x)
        train = some.where(F.col("split") == "train")
        made = oversampled(train, KEY, "x", "load_type").select("load_type", "x")
        model = md.fit_kernel_svc(knn.stored(train.select("load_type", "x").unionByName(made).withColumn("features", array_to_vector("x"))), "load_type")
        pred = knn.stored(model.predict(some.withColumn("features", array_to_vector("x"))).select("split", "load_type", "predicted_label"))
        known = pred.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("predicted_label").isNull(), 1)).alias("n_unknown"))
        largest = pred.groupBy("split", "load_type").count().groupBy("split").agg((F.max("count") / F.sum("count")).alias("largest"))
        row = known.join(classification_metrics(pred, "load_type", "predicted_label", by=["split"]), "split").join(largest, "split").select(
            F.lit(name).alias("features"), "*", F.lit(max(model.gaps, default=0.0)).alias("gap"))
        out = row if out is None else out.unionByName(row)
    return out


RUN_CTES = SPLIT_CTES + ["fit AS (SELECT true AS fit_intercept, regr_slope(l_extendedprice, l_quantity) AS c1, regr_intercept(l_extendedprice, l_quantity) AS c0 FROM sp WHERE split = 'train' "
                         "UNION ALL SELECT false, sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 0 FROM sp WHERE split = 'train')",
                         "run AS (SELECT fit_intercept, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y, c0 + c1 * l_quantity AS p FROM sp, fit WHERE split = 'test')"]


def lineitem_run(spark, sf_dir):
    """Predictions of a linear run, with and without an intercept, of the test rows."""
    li = load(spark, sf_dir, "lineitem").select(*bl.LINEITEM_ORDER, "l_extendedprice", "l_quantity")
    sp = time_split(li, bl.LINEITEM_ORDER, 0.2).withColumn("features", array_to_vector(F.array("l_quantity")))
    configs = gr.combinations("LinearRegression")
    rows = md.predict_long("LinearRegression", configs, sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"), "l_extendedprice", "l_orderkey")
    flags = F.array(*[F.lit(c["fit_intercept"]) for c in configs])
    return rows.withColumn("fit_intercept", F.element_at(flags, F.col("config") + 1))


@register("m8_run_errors", S.with_(RUN_CTES, "SELECT fit_intercept, l_orderkey, l_linenumber, l_partkey, " + S.r("y", 2) + " AS actual, " + S.r("p", 3) + " AS predicted, " + S.r("y - p", 3)
                                   + " AS residual, " + S.r("CASE WHEN y <> 0 THEN 100 * (y - p) / y END", 4) + " AS pct_error FROM run"))
def m8_run_errors(spark, sf_dir):
    """Per test row of a fitted run: actual, predicted, residual, percentage error."""
    rows = residual_columns(lineitem_run(spark, sf_dir), "l_extendedprice", "prediction")
    rounded = lambda c, d: F.round(c, d) + F.lit(0.0)
    return rows.select("fit_intercept", *bl.LINEITEM_KEYS, rounded("l_extendedprice", 2).alias("actual"), rounded("prediction", 3).alias("predicted"), rounded("residual", 3).alias("residual"),
                       rounded("pct_error", 4).alias("pct_error"))


@register("m8_run_metrics", S.with_(RUN_CTES, "SELECT fit_intercept, count(*) AS n, " + S.r("sqrt(avg((y - p) ** 2))", 4) + " AS rmse, " + S.r("avg(abs(y - p))", 4) + " AS mae, "
                                    + S.r("1 - sum((y - p) ** 2) / (var_pop(y) * count(*))", 6) + " AS r2, " + S.r("100 * sqrt(avg((y - p) ** 2)) / avg(y)", 5) + " AS cv FROM run GROUP BY fit_intercept"))
def m8_run_metrics(spark, sf_dir):
    """The metrics of a fitted run."""
    met = regression_metrics(lineitem_run(spark, sf_dir), "l_extendedprice", "prediction", by=["fit_intercept"])
    return met.select("fit_intercept", "n", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("rmse", 4), ("mae", 4), ("r2", 6), ("cv", 5))])


#: Every configuration of all six families, as the comparison of the reference trains them.
M9 = [(m, c) for m in gr.MODELS_TO_RUN for c in gr.combinations(m)]


@register("m9_fit_model_grid", sanity_sql(M9))
def m9_fit_model_grid(spark, sf_dir):
    """Fits all configurations, each in isolation, and publishes the runs."""
    return fit_runs(spark, sf_dir).select("model", "hyperparameters", "n_test", "n_bad", "beats_mean")


M10 = M9

RUNS = "model string, hyperparameters string, status string, beats_mean boolean, n_test long, n_bad long, reason string"


def isolated(name: str, configs: list[dict], train, test) -> list[tuple]:
    """A row of RUNS per configuration. They share fits; if one can't be fitted, each is fitted alone, and the failure is recorded
    with its reason, not raised. Lost executors and programming errors are raised."""
    try:
        found = grid_rows(name, configs, train, test).collect()
        return [(r["model"], r["hyperparameters"], "FINISHED", None if r["beats_mean"] is None else r["beats_mean"] and not r["n_bad"], r["n_test"], r["n_bad"], None) for r in found]
    except (ValueError, ArithmeticError, np.linalg.LinAlgError, IllegalArgumentException) as e:
        if len(configs) == 1:
            return [(name, text_of(configs[0]), "FAILED", None, None, None, f"{type(e).__name__}: {e}")]
        return [row for c in configs for row in isolated(name, [c], train, test)]


def fit_runs(spark, sf_dir):
    """All configurations of all families fitted on this version of the readings; the runs
    are written to the store and published."""
    version = table_version(spark, sf_dir, "events")
    train, test = encoded_split(spark, sf_dir)
    rows = [row for m in gr.MODELS_TO_RUN for row in isolated(m, gr.combinations(m), train, test)]
    path = store.new_path(spark, "model-runs")
    spark.createDataFrame(rows, RUNS).coalesce(1).write.parquet(path)
    return spark.read.schema(RUNS).parquet(store.publish(spark, "model-runs", version, path))


def stored_runs(spark, sf_dir):
    """The published runs on this version of the readings; fitted first if there are none."""
    path = store.published(spark, "model-runs", table_version(spark, sf_dir, "events"))
    return fit_runs(spark, sf_dir) if path is None else spark.read.schema(RUNS).parquet(path)


@register("m10_compare_models", S.with_(SPLIT_CLEAN, " UNION ALL ".join(
    f"SELECT '{m}' AS model, {S.lit(text_of(p))} AS hyperparameters, 'FINISHED' AS status, {'CAST(NULL AS BOOLEAN)' if m == 'CART' else 'true'} AS beats_mean, CAST(1.0 AS DOUBLE) AS success_ratio, "
    "count(*) AS n_test FROM csp WHERE split = 'test'" for m, p in M10)))
def m10_compare_models(spark, sf_dir):
    """The whole grids of all six families, each configuration in isolation."""
    runs = stored_runs(spark, sf_dir).drop("n_bad", "reason")
    done = runs.agg((F.sum((F.col("status") == "FINISHED").cast("double")) / F.count(F.lit(1))).alias("success_ratio"))
    return runs.crossJoin(F.broadcast(done))  # one row


def _s9_sql(k=5, seed=42):
    sid = "CAST(label AS VARCHAR) || ':' || CAST(j AS VARCHAR)"
    return ("WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, "
            "row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS ci, count(*) OVER (PARTITION BY label) AS n_c FROM embeddings), "
            "m AS (SELECT max(n_c) AS m FROM e), "
            f"nn AS (SELECT * FROM (SELECT a.vec_id AS qid, b.vec_id AS tid, row_number() OVER (PARTITION BY a.vec_id "
            "ORDER BY list_distance(a.v, b.v), b.vec_id) AS nn_rank FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id) "
            f"WHERE nn_rank <= {k}), "
            "nk AS (SELECT qid, count(*) AS nk FROM nn GROUP BY qid), "
            "need AS (SELECT DISTINCT label, n_c, m - n_c AS need FROM e, m WHERE n_c < m), "
            f"syn AS (SELECT label, n_c, CAST(j AS BIGINT) AS j, {S.hash60(seed, 'smote.base', sid)} % n_c AS ci, "
            f"{S.hash60(seed, 'smote.nn', sid)} AS hn, {S.uniform(seed, 'smote.u', sid)} AS u "
            "FROM need, range(need) t(j)), "
            "b AS (SELECT syn.*, e.vec_id AS base_id, e.v AS x FROM syn JOIN e USING (label, ci)), "
            "bn AS (SELECT b.*, nn.tid AS nb_id FROM b JOIN nk ON nk.qid = b.base_id JOIN nn ON nn.qid = b.base_id "
            "AND nn.nn_rank = b.hn % nk.nk + 1) "
            "SELECT bn.label, j, base_id, nb_id, list_transform(list_zip(x, e.v), lambda p: "
            + S.r("p[1] + u * (p[2] - p[1])").replace("(CASE", "(CASE", 1)
            + ") AS embedding FROM bn JOIN e ON e.vec_id = bn.nb_id")


@register("s9_smote", _s9_sql())
def s9_smote(spark, sf_dir, k: int = 5, seed: int = 42):
    """Oversample every class of the embeddings to the majority count."""
    made = oversampled(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", k, seed)
    return made.withColumn("embedding", F.transform("embedding", lambda v: F.round(v, 6) + F.lit(0.0)))
