"""Queries over model results: metrics, rankings, selection, the runs view and
summary sinks (K1-K5, W1, W2, L4-L6, C14, A7-A9, B11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.params import params_to_string
from wattline.operators import baselines as bl
from wattline.operators import metrics as mt
from wattline.operators import ranking as rk
from wattline.plans import sqlgen as S
from wattline.plans.registry import register
from wattline.session import scratch_path
from wattline.sources import files

CFG = ", ".join(f"({i}, '{m}', '{', '.join(f'{k}={v}' for k, v in p) or 'default'}')" for i, m, p in bl.FAMILY)
SPLIT_CTES = [
    "li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_quantity, l_returnflag, "
    "l_linestatus, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position, "
    "count(*) OVER () AS n FROM lineitem)",
    "sp AS (SELECT *, CASE WHEN position <= n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) THEN 'train' "
    "ELSE 'test' END AS split FROM li)",
]
RESULT_CTES = SPLIT_CTES + [
    "tr AS (SELECT * FROM sp WHERE split = 'train')",
    "te AS (SELECT * FROM sp WHERE split = 'test')",
    "st AS (SELECT avg(l_extendedprice) AS m, regr_slope(l_extendedprice, l_quantity) AS b1, "
    "regr_intercept(l_extendedprice, l_quantity) AS b0, sum(l_quantity * l_extendedprice) / "
    "sum(l_quantity * l_quantity) AS b_0 FROM tr)",
    "g2 AS (SELECT l_returnflag, avg(l_extendedprice) AS m2 FROM tr GROUP BY 1)",
    "g3 AS (SELECT l_linestatus, avg(l_extendedprice) AS m3 FROM tr GROUP BY 1)",
    "g4 AS (SELECT l_returnflag, l_linestatus, avg(l_extendedprice) AS m4 FROM tr GROUP BY 1, 2)",
    "pred AS (SELECT te.*, st.m AS p1, coalesce(m2, st.m) AS p2, coalesce(m3, st.m) AS p3, coalesce(m4, st.m) AS p4, "
    "st.b0 + st.b1 * l_quantity AS p5, st.b_0 * l_quantity AS p6 FROM te CROSS JOIN st "
    "LEFT JOIN g2 USING (l_returnflag) LEFT JOIN g3 USING (l_linestatus) LEFT JOIN g4 USING (l_returnflag, l_linestatus))",
    "lp AS (" + " UNION ALL ".join(f"SELECT {i} AS run_ord, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y, "
                                   f"p{i} AS yhat FROM pred" for i, *_ in bl.FAMILY) + ")",
    "met AS (SELECT run_ord, sqrt(sum((y - yhat) * (y - yhat)) / count(*)) AS rmse, avg(abs(y - yhat)) AS mae, "
    "CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END ELSE "
    "1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) END AS r2, "
    "100.0 * sqrt(sum((y - yhat) * (y - yhat)) / count(*)) / avg(y) AS cv FROM lp GROUP BY run_ord)",
    f"cfg AS (SELECT * FROM (VALUES {CFG}) t(run_ord, model, hyperparameters))",
    "results AS (SELECT cfg.run_ord, model, hyperparameters, rmse, mae, r2, cv FROM cfg JOIN met USING (run_ord))",
]


def results(spark, sf_dir):
    return bl.family_results(spark, sf_dir)


def _rm(c):
    """Rounding per metric: error sums of large prices keep 4 decimals."""
    return {"rmse": 4, "mae": 4, "r2": 9, "cv": 6}[c]


def rounded_metrics(df, names=("rmse", "mae", "r2", "cv"), upper=False):
    return [(F.round(c, _rm(c)) + F.lit(0.0)).alias(c.upper() if upper else c) for c in names]


def sql_metrics(upper=False):
    return ", ".join(f"{S.r(c, _rm(c))} AS {c.upper() if upper else c}" for c in ("rmse", "mae", "r2", "cv"))


@register("k1_regression_metrics", S.with_(RESULT_CTES, f"SELECT run_ord, {sql_metrics()} FROM results"))
def k1_regression_metrics(spark, sf_dir):
    res = results(spark, sf_dir)
    return res.select(F.col("run_ord").cast("int"), *rounded_metrics(res))


@register("k3_all_runs_summary", S.with_(RESULT_CTES, f"SELECT run_ord, model AS Model, hyperparameters AS "
                                                      f"Hyperparameters, {sql_metrics(True)} FROM results"))
def k3_all_runs_summary(spark, sf_dir):
    sm = rk.summary(results(spark, sf_dir))
    return sm.select("run_ord", "Model", "Hyperparameters",
                     *[(F.round(c, _rm(c.lower())) + F.lit(0.0)).alias(c) for c in ("RMSE", "MAE", "R2", "CV")])


C14_KEYS = ["load_type", "week_status", "day_of_week"]


@register("c14_params_to_string", S.with_(S.clean_ctes(), "SELECT load_type, 'week_status=' || week_status || ', day_of_week=' || "
          "day_of_week || ', readings=' || CAST(count(*) AS VARCHAR) AS settings FROM readings_clean "
          "GROUP BY load_type, week_status, day_of_week"))
def c14_params_to_string(spark, sf_dir):
    from wattline.plans.q_cleaning import clean
    counts = clean(spark, sf_dir).groupBy(*C14_KEYS).agg(F.count(F.lit(1)).alias("readings"))
    settings = F.create_map(*[x for c in [*C14_KEYS[1:], "readings"] for x in (F.lit(c), F.col(c).cast("string"))])
    return counts.select("load_type", params_to_string(settings).alias("settings"))


def _value_round(crit_col, v):
    return F.when(crit_col.isin("RMSE", "MAE"), F.round(v, 4)).otherwise(F.round(v, 6)) + F.lit(0.0)


def _value_round_sql(crit, v):
    return f"CASE WHEN {crit} IN ('RMSE', 'MAE') THEN {S.r(v, 4)} ELSE {S.r(v, 6)} END"


RANK_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS criterion, row_number() OVER (ORDER BY {m} {'ASC' if asc else 'DESC'} NULLS LAST, run_ord) AS rank, "
    f"model, hyperparameters, {m} AS value FROM results" for c, (m, asc) in rk.CRITERIA.items())


@register("w1_rankings", S.with_(RESULT_CTES + [f"rk AS ({RANK_SQL})"],
                                 "SELECT criterion, rank, model, hyperparameters, "
                                 + _value_round_sql("criterion", "value") + " AS value FROM rk"))
def w1_rankings(spark, sf_dir):
    out = rk.rankings(results(spark, sf_dir))
    return out.withColumn("rank", F.col("rank").cast("bigint")).withColumn(
        "value", _value_round(F.col("criterion"), F.col("value")))


@register("w2_best_per_model", S.with_(RESULT_CTES, "SELECT run_ord, model, hyperparameters, " + S.r("rmse", 4)
                                       + " AS rmse FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY "
                                       "rmse NULLS LAST, run_ord) AS r FROM results) WHERE r = 1"))
def w2_best_per_model(spark, sf_dir):
    b = rk.best_per_model(results(spark, sf_dir))
    return b.select("run_ord", "model", params_to_string("params").alias("hyperparameters"),
                    (F.round("rmse", 4) + F.lit(0.0)).alias("rmse"))


L4_SQL = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS criterion, model, hyperparameters, {S.r(m, _rm(m))} AS value FROM results "
    f"ORDER BY {m} {'ASC' if asc else 'DESC'} NULLS LAST, run_ord LIMIT 1)" for c, (m, asc) in rk.CRITERIA.items())


@register("l4_best_by_criterion", S.with_(RESULT_CTES, L4_SQL))
def l4_best_by_criterion(spark, sf_dir):
    res, out = results(spark, sf_dir), None
    for c, (m, _) in rk.CRITERIA.items():
        one = rk.best_by_criterion(res, c).select(
            F.lit(c).alias("criterion"), "model", params_to_string("params").alias("hyperparameters"), (F.round(m, _rm(m)) + F.lit(0.0)).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


K4_SQL = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS Criterion, model AS Best_Model, hyperparameters AS Hyperparameters, "
    f"{_value_round_sql(repr(c), m)} AS Value FROM results ORDER BY {m} {'ASC' if asc else 'DESC'} NULLS LAST, "
    "run_ord LIMIT 1)" for c, (m, asc) in rk.CRITERIA.items())


@register("k4_best_by_criterion_table", S.with_(RESULT_CTES, K4_SQL))
def k4_best_by_criterion_table(spark, sf_dir):
    t = rk.best_by_criterion_table(results(spark, sf_dir))
    return t.withColumn("Value", _value_round(F.col("Criterion"), F.col("Value")))


@register("l5_compare_models", S.with_(RESULT_CTES, "SELECT row_number() OVER (ORDER BY rmse NULLS LAST, run_ord) "
                                                    "AS position, model, hyperparameters, " + S.r("rmse", 4)
                                       + " AS rmse FROM results"))
def l5_compare_models(spark, sf_dir):
    c = rk.compare_models(results(spark, sf_dir))
    return c.withColumn("position", F.col("position").cast("bigint")).withColumn(
        "rmse", F.round("rmse", 4) + F.lit(0.0))


K5_SQL = S.with_(RESULT_CTES + [
    "bpm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY rmse NULLS LAST, run_ord) AS r "
    "FROM results) WHERE r = 1)",
    "best AS (" + K4_SQL.replace("Value FROM results", "Value FROM results") + ")"],
    "SELECT 'best_' || lower(Criterion) || '_value' AS key, Value AS value FROM best UNION ALL "
    + " UNION ALL ".join(f"SELECT model || '_{c}' AS key, {_value_round_sql(repr(c), m)} AS value FROM bpm"
                         for c, (m, _) in rk.CRITERIA.items()))


@register("k5_long_metrics", K5_SQL)
def k5_long_metrics(spark, sf_dir):
    res = results(spark, sf_dir)
    lm = rk.long_metrics(res)
    crit = F.upper(F.regexp_extract("key", r"(?i)(rmse|mae|r2|cv)", 1))
    return lm.withColumn("value", _value_round(crit, F.col("value")))


RUNS_CTES = RESULT_CTES + [
    "runs AS (SELECT 'run-' || CAST(run_ord AS VARCHAR) AS run_id, *, CASE WHEN rmse IS NOT NULL AND NOT isnan(rmse) "
    "THEN 'FINISHED' ELSE 'FAILED' END AS status FROM results)"]


@register("l6_best_finished_run", S.with_(RUNS_CTES, "SELECT run_id, model, " + S.r("rmse", 4) + " AS rmse FROM runs "
                                          "WHERE status = 'FINISHED' ORDER BY rmse NULLS LAST, run_ord LIMIT 1"))
def l6_best_finished_run(spark, sf_dir):
    b = rk.best_finished_run(rk.runs_table(results(spark, sf_dir)))
    return b.select("run_id", "model", (F.round("rmse", 4) + F.lit(0.0)).alias("rmse"))


KEYS = "l_orderkey, l_linenumber, l_partkey"


@register("a7_prediction_sink", S.with_(RESULT_CTES, f"SELECT 'run-' || CAST(run_ord AS VARCHAR) AS run_id, {KEYS}, "
                                        "y AS actual, " + S.r("yhat", 6) + " AS predicted, " + S.r("y - yhat", 6)
                                        + " AS residual FROM lp"))
def a7_prediction_sink(spark, sf_dir):
    long = bl.long_predictions(bl.family_predictions(bl.lineitem_split(spark, sf_dir)))
    out = long.select(F.concat(F.lit("run-"), F.col("run_ord").cast("string")).alias("run_id"),
                      *bl.LINEITEM_KEYS, F.col("y").alias("actual"), F.col("yhat").alias("predicted"))
    out = mt.residual_columns(out, "actual", "predicted").drop("pct_error")
    path = files.write_parquet(out, scratch_path(spark, "predictions"), partition_by=["run_id"])
    back = spark.read.parquet(path)
    return back.select("run_id", *bl.LINEITEM_KEYS, "actual", (F.round("predicted", 6) + F.lit(0.0)).alias("predicted"),
                       (F.round("residual", 6) + F.lit(0.0)).alias("residual"))


@register("b11_residuals", S.with_(RESULT_CTES, f"SELECT CAST(run_ord AS INTEGER) AS run_ord, {KEYS}, " + S.r("y - yhat", 6) + " AS residual, "
                                   + S.r("100.0 * (y - yhat) / CASE WHEN y = 0 THEN NULL ELSE y END", 6)
                                   + " AS pct_error FROM lp"))
def b11_residuals(spark, sf_dir):
    long = bl.long_predictions(bl.family_predictions(bl.lineitem_split(spark, sf_dir)))
    out = mt.residual_columns(long, "y", "yhat")
    return out.select("run_ord", *bl.LINEITEM_KEYS, (F.round("residual", 6) + F.lit(0.0)).alias("residual"),
                      (F.round("pct_error", 6) + F.lit(0.0)).alias("pct_error"))


@register("a8_evaluation_sink", S.with_(RESULT_CTES + [
    "best AS (SELECT run_ord FROM results ORDER BY rmse NULLS LAST, run_ord LIMIT 1)"],
    f"SELECT {KEYS}, y AS y_true, " + S.r("yhat", 6) + " AS y_pred, " + S.r("y - yhat", 6)
    + " AS residual FROM lp WHERE run_ord IN (SELECT run_ord FROM best)"))
def a8_evaluation_sink(spark, sf_dir):
    res = results(spark, sf_dir)
    best = rk.best_finished_run(rk.runs_table(res)).select("run_ord")
    long = bl.long_predictions(bl.family_predictions(bl.lineitem_split(spark, sf_dir)))
    ev = long.join(F.broadcast(best), "run_ord")  # one row
    ev = ev.select(*bl.LINEITEM_KEYS, F.col("y").alias("y_true"), F.col("yhat").alias("y_pred"),
                   (F.col("y") - F.col("yhat")).alias("residual"))
    path = files.write_parquet(ev, scratch_path(spark, "evaluation"))
    back = spark.read.parquet(path)
    return back.select(*bl.LINEITEM_KEYS, "y_true", (F.round("y_pred", 6) + F.lit(0.0)).alias("y_pred"),
                       (F.round("residual", 6) + F.lit(0.0)).alias("residual"))


def _a9_sql():
    def ranked(m, asc):
        return f"row_number() OVER (ORDER BY {m} {'ASC' if asc else 'DESC'} NULLS LAST, run_ord)"
    parts = [f"SELECT 'models_metrics_summary' AS artifact, CAST(run_ord AS BIGINT) AS row_no, model, hyperparameters, {S.r('rmse', 4)} AS value FROM results"]
    parts += [f"SELECT 'best_models_by_criterion', {i}, model, hyperparameters, {S.r(m, _rm(m))} FROM (SELECT *, {ranked(m, asc)} AS k FROM results) WHERE k = 1"
              for i, (m, asc) in enumerate(rk.CRITERIA.values(), 1)]
    parts += [f"SELECT '{c.lower()}_ranking', {ranked(m, asc)}, model, hyperparameters, {S.r(m, _rm(m))} FROM results" for c, (m, asc) in rk.CRITERIA.items()]
    return " UNION ALL ".join(parts)


@register("a9_summary_sinks", S.with_(RESULT_CTES, _a9_sql()))
def a9_summary_sinks(spark, sf_dir):
    """The contents of the six files, as read back."""
    res = results(spark, sf_dir)
    ranks = rk.rankings(res)
    tables = [("models_metrics_summary", rk.summary(res).select("run_ord", "Model", "Hyperparameters", "RMSE")),
              ("best_models_by_criterion", ranks.where("rank = 1").select(
                  (F.array_position(F.array(*[F.lit(c) for c in rk.CRITERIA]), F.col("criterion"))).alias("run_ord"), "model", "hyperparameters", "value"))]
    tables += [(f"{c.lower()}_ranking", ranks.where(F.col("criterion") == c).select("rank", "model", "hyperparameters", "value")) for c in rk.CRITERIA]
    root = scratch_path(spark, "summary")
    out = None
    for name, t in tables:
        t = t.toDF("row_no", "model", "hyperparameters", "value")
        files.write_csv(t, f"{root}/{name}")
        back = files.read_csv_typed(spark, f"{root}/{name}", "row_no long, model string, hyperparameters string, value double")
        m = rk.CRITERIA[name.split("_")[0].upper()][0] if name.endswith("_ranking") else "rmse"
        digits = F.lit(_rm(m))
        if name == "best_models_by_criterion":
            value = F.element_at(F.array(*[F.round("value", _rm(x)) for x, _ in rk.CRITERIA.values()]), F.col("row_no").cast("int"))
        else:
            value = F.round("value", digits)
        part = back.select(F.lit(name).alias("artifact"), "row_no", "model", "hyperparameters", (value + F.lit(0.0)).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# -- K2 classification metrics: majority class of l_returnflag per l_linestatus --------------

K2_SQL = S.with_(SPLIT_CTES + [
    "cnt AS (SELECT l_linestatus, l_returnflag, count(*) AS c FROM sp WHERE split = 'train' GROUP BY 1, 2)",
    "maj AS (SELECT l_linestatus, arg_min(l_returnflag, (-c, l_returnflag)) AS pred FROM cnt GROUP BY 1)",
    "allmaj AS (SELECT arg_min(l_returnflag, (-c, l_returnflag)) AS pred FROM (SELECT l_returnflag, sum(c) AS c FROM cnt GROUP BY 1))",
    "pr AS (SELECT split, l_returnflag AS y, coalesce(maj.pred, allmaj.pred) AS p FROM sp LEFT JOIN maj USING (l_linestatus) CROSS JOIN allmaj)",
    "conf AS (SELECT split, y, p, count(*) AS c FROM pr GROUP BY 1, 2, 3)",
    "act AS (SELECT split, y AS cls, sum(c) AS support FROM conf GROUP BY 1, 2)",
    "prd AS (SELECT split, p AS cls, sum(c) AS npred FROM conf GROUP BY 1, 2)",
    "tp AS (SELECT split, y AS cls, sum(c) AS tp FROM conf WHERE y = p GROUP BY 1, 2)",
    "per AS (SELECT coalesce(a.split, b.split) AS split, coalesce(a.cls, b.cls) AS cls, coalesce(support, 0) AS support, "
    "coalesce(npred, 0) AS npred, coalesce(tp.tp, 0) AS tp FROM act a FULL JOIN prd b ON a.split = b.split AND a.cls = b.cls "
    "LEFT JOIN tp ON tp.split = coalesce(a.split, b.split) AND tp.cls = coalesce(a.cls, b.cls))",
    "pm AS (SELECT split, support, tp, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS pp, "
    "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rr FROM per)"],
    "SELECT split, " + S.r("sum(tp) / sum(support)", 9) + " AS accuracy, " + S.r("sum(pp * support) / sum(support)", 9)
    + " AS precision, " + S.r("sum(rr * support) / sum(support)", 9) + " AS recall, "
    + S.r("sum(CASE WHEN pp + rr > 0 THEN 2 * pp * rr / (pp + rr) ELSE 0.0 END * support) / sum(support)", 9)
    + " AS f1 FROM pm GROUP BY split")


@register("k2_classification_metrics", K2_SQL)
def k2_classification_metrics(spark, sf_dir):
    sp = bl.lineitem_split(spark, sf_dir)
    train = sp.where(F.col("split") == "train")
    cnt = train.groupBy("l_linestatus", "l_returnflag").agg(F.count(F.lit(1)).alias("c"))
    key = F.struct((-F.col("c")).alias("nc"), F.col("l_returnflag"))
    maj = cnt.groupBy("l_linestatus").agg(F.min_by("l_returnflag", key).alias("_maj"))
    overall = (cnt.groupBy("l_returnflag").agg(F.sum("c").alias("c"))
                  .agg(F.min_by("l_returnflag", F.struct((-F.col("c")).alias("nc"), F.col("l_returnflag"))).alias("_all")))
    pr = (sp.join(maj, "l_linestatus", "left").crossJoin(F.broadcast(overall))
            .select("split", F.col("l_returnflag").alias("y"), F.coalesce("_maj", "_all").alias("p")))
    m = mt.classification_metrics(pr, "y", "p", by=["split"])
    return m.select("split", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in ("accuracy", "precision", "recall", "f1")])
