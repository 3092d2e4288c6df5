"""Queries for scoring, streaming and the declared extras."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wattline.operators import baselines as bl
from wattline.operators import ranking as rk
from wattline.operators import scoring as sc
from wattline.operators import validate as va
from wattline.operators.grams import expanding_folds, grams
from wattline.operators.metrics import regression_metrics
from wattline.operators.models import fit_ols
from wattline.operators.ordering import after_positions
from wattline.plans import sqlgen as S
from wattline.plans.q_features import SPLIT_CLEAN
from wattline.plans.q_ranking import RESULT_CTES, SPLIT_CTES, results
from wattline.plans.q_validate import REQ_DOMAINS, REQUESTS_CTE, error_cases_sql
from wattline.plans.registry import register
from wattline.sources import store
from wattline.sources.requests import REQUEST_NUMERIC, requests
from wattline.sources.tables import load, table_version

B9_SQL = S.with_([S.READINGS, REQUESTS_CTE], "SELECT request_id, TIMESTAMP '2024-01-01 00:00:00' AS date, " + ", ".join(
    (f"TRY_CAST({S.qi(a)} AS BIGINT) AS {b}" if b == "nsm" else f"{S.qi(a)} AS {b}") for a, b in sc.REQUEST_TO_MODEL)
    + " FROM requests")


@register("b9_request_to_row", B9_SQL)
def b9_request_to_row(spark, sf_dir):
    return sc.request_to_model_row(requests(spark, sf_dir))


def stored_model(spark, sf_dir):
    """The model for this version of the readings, loaded from the store; fitted, saved
    and published first if no application has done so."""
    version = table_version(spark, sf_dir, "events")
    path = store.published(spark, "usage-model", version)
    if path is None:
        from wattline.plans.q_features import clean_split
        train = clean_split(spark, sf_dir).where(F.col("split") == "train")
        path = store.publish(spark, "usage-model", version, sc.UsageModel.fit(train).save(store.new_path(spark, "usage-model")))
    return sc.UsageModel.load(path)


#: co2 is usage / 1000 in the derived readings, so least squares reproduces it from there.
PREDICTED_SQL = S.r('CAST("CO2(tCO2)" AS DOUBLE) * 1000.0', 3)
VALID_SQL = f"FROM requests WHERE {error_cases_sql()} = ''"


def valid_requests(spark, sf_dir):
    checked = va.request_errors(va.require_non_empty(requests(spark, sf_dir)), REQUEST_NUMERIC, "NSM", REQ_DOMAINS)
    return va.split_valid(checked)[0]


def rounded(scored):
    return scored.withColumn("Usage_kWh", F.round("Usage_kWh", 3) + F.lit(0.0))


@register("p1_batch_scoring", S.with_([S.READINGS, REQUESTS_CTE], f"SELECT request_id, {PREDICTED_SQL} AS Usage_kWh, "
                                      f"(SELECT count(*) {VALID_SQL}) AS batch_count {VALID_SQL}"))
def p1_batch_scoring(spark, sf_dir):
    valid = valid_requests(spark, sf_dir)
    return rounded(sc.score_batch(stored_model(spark, sf_dir), valid)).withColumn("batch_count", F.lit(valid.count()))


@register("p2_single_row_scoring", S.with_([S.READINGS, REQUESTS_CTE], f"SELECT request_id, {PREDICTED_SQL} AS Usage_kWh {VALID_SQL} ORDER BY request_id LIMIT 1"))
def p2_single_row_scoring(spark, sf_dir):
    one = valid_requests(spark, sf_dir).orderBy("request_id").limit(1)  # one request is the feature here
    return rounded(sc.score_batch(stored_model(spark, sf_dir), one))


P3_SQL = S.with_(RESULT_CTES + ["best AS (SELECT run_ord FROM results ORDER BY rmse NULLS LAST, run_ord LIMIT 1)"],
                 "SELECT 'run-' || CAST(run_ord AS VARCHAR) AS run_id, " + ", ".join(
                     f"{S.r(c, d)} AS {c}" for c, d in (("rmse", 4), ("mae", 4), ("r2", 9), ("cv", 6)))
                 + " FROM results WHERE run_ord IN (SELECT run_ord FROM best)")


@register("p3_evaluate_best_run", P3_SQL)
def p3_evaluate_best_run(spark, sf_dir):
    best = rk.best_finished_run(rk.runs_table(results(spark, sf_dir))).select("run_ord", "run_id")
    long = bl.long_predictions(bl.family_predictions(bl.lineitem_split(spark, sf_dir)))
    ev = long.join(F.broadcast(best), "run_ord")  # one run
    m = regression_metrics(ev, "y", "yhat", by=["run_id"])
    return m.select("run_id", *[(F.round(c, d) + F.lit(0.0)).alias(c)
                                for c, d in (("rmse", 4), ("mae", 4), ("r2", 9), ("cv", 6))])


@register("p3_evaluate_stored_model", S.with_(SPLIT_CLEAN, "SELECT reading_id, " + S.r("usage_kwh", 3) + " AS y_true, "
                                              + S.r("co2_tco2 * 1000.0", 3) + " AS y_pred FROM csp WHERE split = 'test'"))
def p3_evaluate_stored_model(spark, sf_dir):
    """The stored pipeline on the test rows of the time split."""
    from wattline.plans.q_features import clean_split
    test = clean_split(spark, sf_dir).where(F.col("split") == "test")
    pred = stored_model(spark, sf_dir).predict(test)
    return pred.select("reading_id", (F.round("usage_kwh", 3) + F.lit(0.0)).alias("y_true"), (F.round("prediction", 3) + F.lit(0.0)).alias("y_pred"))


T1_SQL = S.with_([S.READINGS, REQUESTS_CTE],
                 f"SELECT request_id, {error_cases_sql()} = '' AS is_valid, {error_cases_sql()} AS errors, "
                 f"CASE WHEN {error_cases_sql()} = '' THEN {PREDICTED_SQL} END AS Usage_kWh, "
                 f"{error_cases_sql()} <> '' AS quarantined FROM requests")


@register("t1_stream_validate_score", T1_SQL)
def t1_stream_validate_score(spark, sf_dir):
    """The three tables that the stream wrote, joined by request."""
    from wattline.streaming.score_stream import read_table, run
    paths = run(spark, sf_dir, stored_model(spark, sf_dir))
    checked = read_table(spark, paths["checked"])
    scored = rounded(read_table(spark, paths["predictions"]).select("request_id", "Usage_kWh"))
    bad = read_table(spark, paths["quarantine"]).select("request_id", F.lit(True).alias("quarantined"))
    return (checked.join(scored, "request_id", "left").join(bad, "request_id", "left")
            .withColumn("quarantined", F.coalesce("quarantined", F.lit(False))))


# -- X1 time-series cross-validation (expanding window, 5 folds) ------------------------------

def _x1_sql(n_splits=5):
    folds = n_splits + 1
    return S.with_(SPLIT_CTES + [
        f"fz AS (SELECT n // {folds} AS ts, n - {n_splits} * (n // {folds}) AS first FROM li LIMIT 1)",
        f"fl AS (SELECT CAST(f AS BIGINT) AS fold, first + f * ts AS start, ts FROM fz, range({n_splits}) t(f))",
        "tr AS (SELECT fold, l_returnflag, avg(l_extendedprice) AS m, count(*) AS c FROM li, fl WHERE position <= start GROUP BY 1, 2)",
        "trall AS (SELECT fold, avg(l_extendedprice) AS m, count(*) AS n_train FROM li, fl WHERE position <= start GROUP BY 1)",
        "te AS (SELECT fl.fold, l_extendedprice AS y, coalesce(tr.m, trall.m) AS yhat FROM li JOIN fl ON position > start "
        "AND position <= start + ts LEFT JOIN tr ON tr.fold = fl.fold AND tr.l_returnflag = li.l_returnflag "
        "JOIN trall ON trall.fold = fl.fold)"],
        "SELECT te.fold, max(n_train) AS n_train, count(*) AS n_test, " + S.r("-sqrt(avg((y - yhat) * (y - yhat)))", 4)
        + " AS neg_rmse FROM te JOIN trall USING (fold) GROUP BY te.fold")


@register("x1_time_series_cv", _x1_sql())
def x1_time_series_cv(spark, sf_dir, n_splits: int = 5):
    """Fold f trains on the rows before its test block. The blocks' limits are found by
    counting; one aggregate per (block, flag) then gives every fold's training means."""
    li = load(spark, sf_dir, "lineitem").select(*bl.LINEITEM_ORDER, "l_extendedprice", "l_returnflag")
    # rows before the test block of each fold; a row's block is 0, then fold + 1
    block = after_positions(li, bl.LINEITEM_ORDER, lambda n: [n - (n_splits - f) * (n // (n_splits + 1)) for f in range(n_splits)])
    rows = li.withColumn("block", block)
    sums = rows.groupBy("block", "l_returnflag").agg(F.sum("l_extendedprice").alias("s"), F.count(F.lit(1)).alias("c"))
    # (n_splits + 1) * flags rows from here on
    seen = sums.withColumn("fold", F.explode(F.sequence(F.col("block"), F.lit(n_splits)))).where(F.col("fold") < n_splits)
    tr = seen.groupBy("fold", "l_returnflag").agg((F.sum("s") / F.sum("c")).alias("m"))
    trall = seen.groupBy("fold").agg((F.sum("s") / F.sum("c")).alias("ma"), F.sum("c").alias("n_train"))
    te = rows.where("block > 0").withColumn("fold", F.col("block") - 1)
    te = te.join(tr, ["fold", "l_returnflag"], "left").join(trall, "fold")
    e = F.col("l_extendedprice") - F.coalesce("m", "ma")
    return te.groupBy(F.col("fold").cast("long").alias("fold")).agg(F.max("n_train").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
                                  (F.round(-F.sqrt(F.avg(e * e)), 4) + F.lit(0.0)).alias("neg_rmse"))


def _x1_regression_sql(n_splits=5):
    folds, a, b, y = n_splits + 1, "l_quantity", "l_discount", "l_extendedprice"
    li = SPLIT_CTES[0].replace("l_quantity, ", "l_quantity, l_discount, ", 1)
    det = "(vaa * vbb - vab * vab)"
    return S.with_([li, f"fz AS (SELECT n // {folds} AS ts, n - {n_splits} * (n // {folds}) AS first FROM li LIMIT 1)",
                    f"fl AS (SELECT CAST(f AS BIGINT) AS fold, first + f * ts AS start, ts FROM fz, range({n_splits}) t(f))",
                    f"st AS (SELECT fold, count(*) AS n_train, avg({a}) AS ma, avg({b}) AS mb, avg({y}) AS my, var_pop({a}) AS vaa, var_pop({b}) AS vbb, covar_pop({a}, {b}) AS vab, "
                    f"covar_pop({a}, {y}) AS vay, covar_pop({b}, {y}) AS vby FROM li, fl WHERE position <= start GROUP BY 1)",
                    f"cf AS (SELECT *, (vay * vbb - vby * vab) / {det} AS ca, (vby * vaa - vay * vab) / {det} AS cb FROM st)",
                    f"te AS (SELECT fl.fold, n_train, ca, cb, my - ca * ma - cb * mb AS c0, {y} - my - ca * ({a} - ma) - cb * ({b} - mb) AS e FROM li JOIN fl ON position > start AND position <= start + ts "
                    "JOIN cf ON cf.fold = fl.fold)"],
                   "SELECT fold, max(n_train) AS n_train, count(*) AS n_test, " + S.r("max(c0)", 2) + " AS intercept, " + S.r("max(ca)", 3) + " AS quantity, " + S.r("max(cb)", 2) + " AS discount, "
                   + S.r("-sqrt(avg(e * e))", 3) + " AS neg_rmse FROM te GROUP BY fold")


@register("x1_fold_regression", _x1_regression_sql())
def x1_fold_regression(spark, sf_dir, n_splits: int = 5):
    """Cross-validation of least squares: sums of squares and products per block of time,
    from which all folds' coefficients and errors follow (one pass after the limits)."""
    li = load(spark, sf_dir, "lineitem").select(*bl.LINEITEM_ORDER, "l_extendedprice", "l_quantity", "l_discount")
    block = after_positions(li, bl.LINEITEM_ORDER, lambda n: [n - (n_splits - f) * (n // (n_splits + 1)) for f in range(n_splits)])
    rows = li.select(F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")).alias("x"), F.col("l_extendedprice").alias("y"), block.alias("block"))
    folds = [(f.fold, f.n_train, f.n_test, *map(float, f.coefficients), -f.rmse) for f in expanding_folds(grams(rows, "block"), n_splits)]
    out = spark.createDataFrame(folds, "fold long, n_train long, n_test long, intercept double, quantity double, discount double, neg_rmse double")
    return out.select("fold", "n_train", "n_test", *[(F.round(c, d) + F.lit(0.0)).alias(c) for c, d in (("intercept", 2), ("quantity", 3), ("discount", 2), ("neg_rmse", 3))])


X2_SQL = S.with_(SPLIT_CTES + [
    "tr AS (SELECT * FROM sp WHERE split = 'train')",
    "g AS (SELECT l_returnflag, avg(ln(1 + l_extendedprice)) AS ml FROM tr GROUP BY 1)",
    "b AS (SELECT regr_slope(ln(1 + l_extendedprice), l_quantity) AS b1, regr_intercept(ln(1 + l_extendedprice), l_quantity) AS b0 FROM tr)",
    "p AS (SELECT 'group mean' AS model, l_extendedprice AS y, exp(g.ml) - 1 AS yhat FROM sp JOIN g USING (l_returnflag) WHERE split = 'test' "
    "UNION ALL SELECT 'least squares', l_extendedprice, exp(b0 + b1 * l_quantity) - 1 FROM sp, b WHERE split = 'test')"],
    "SELECT model, " + S.r("sqrt(avg((y - yhat) * (y - yhat)))", 4) + " AS rmse, " + S.r("avg(abs(y - yhat))", 4) + " AS mae FROM p GROUP BY model")


@register("x2_log1p_target", X2_SQL)
def x2_log1p_target(spark, sf_dir):
    """Models of log(1 + y), their predictions transformed back: group means, and least
    squares on the quantity."""
    sp = bl.lineitem_split(spark, sf_dir).withColumn("log_y", F.log1p("l_extendedprice"))
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    g = train.groupBy("l_returnflag").agg(F.avg("log_y").alias("ml"))
    means = test.join(g, "l_returnflag").select(F.lit("group mean").alias("model"), F.col("l_extendedprice").alias("y"), F.expm1("ml").alias("yhat"))
    vector = lambda df: df.withColumn("features", array_to_vector(F.array("l_quantity")))
    line = fit_ols(vector(train), "log_y").transform(vector(test)).select(F.lit("least squares").alias("model"), F.col("l_extendedprice").alias("y"), F.expm1("prediction").alias("yhat"))
    e = F.col("y") - F.col("yhat")
    return means.unionByName(line).groupBy("model").agg((F.round(F.sqrt(F.avg(e * e)), 4) + F.lit(0.0)).alias("rmse"),
                                                        (F.round(F.avg(F.abs(e)), 4) + F.lit(0.0)).alias("mae"))
