"""Regression and classification metrics (K1, K2, B11), one aggregate pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.numeric import safe_pct_error


def residual_columns(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """residual = y - yhat and percentage error 100 * residual / y (null if y = 0)."""
    res = F.col(y) - F.col(yhat)
    return df.withColumn("residual", res).withColumn("pct_error", safe_pct_error(res, F.col(y)))


def regression_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """K1: RMSE, MAE, R2 (1 - SSE / SST; constant y -> 1 if perfect else 0), CV% = 100 RMSE / mean(y)."""
    e = F.col(y) - F.col(yhat)
    agg = (df.groupBy(*(by or [])) if by else df.groupBy()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"),
        F.avg(y).alias("ybar"), F.var_pop(y).alias("vy"))
    n = F.col("n").cast("double")
    sst = F.col("vy") * n
    rmse = F.sqrt(F.col("sse") / n)
    r2 = (F.when(sst == 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0) - F.col("sse") / sst))
    return agg.select(*(by or []), rmse.alias("rmse"), (F.col("sae") / n).alias("mae"), r2.alias("r2"),
                      (F.lit(100.0) * F.try_divide(rmse, F.col("ybar"))).alias("cv"), F.col("n"))


def classification_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """K2: accuracy and support-weighted precision, recall, F1 (0 where undefined),
    from the confusion counts (a table of at most classes^2 rows per group)."""
    by = by or []
    conf = df.groupBy(*by, F.col(y).alias("_y"), F.col(yhat).alias("_p")).agg(F.count(F.lit(1)).alias("c"))
    actual = conf.groupBy(*by, F.col("_y").alias("cls")).agg(F.sum("c").alias("support"))
    pred = conf.groupBy(*by, F.col("_p").alias("cls")).agg(F.sum("c").alias("npred"))
    tp = conf.where(F.col("_y") == F.col("_p")).groupBy(*by, F.col("_y").alias("cls")).agg(F.sum("c").alias("tp"))
    per = (actual.join(pred, by + ["cls"], "full").join(tp, by + ["cls"], "left")
                 .na.fill(0, ["support", "npred", "tp"]))
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    per = per.select(*by, "support", "tp", prec.alias("p"), rec.alias("r"), f1.alias("f"))
    tot = F.sum("support")
    return per.groupBy(*by).agg(
        (F.sum("tp") / tot).alias("accuracy"), (F.sum(F.col("p") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("r") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f") * F.col("support")) / tot).alias("f1"))


def prediction_sanity(df: DataFrame, n_inputs: int, yhat: str) -> DataFrame:
    """as many predictions as inputs, no NaN, no infinity, no null."""
    p = F.col(yhat)
    counts = df.agg(F.count(F.lit(1)).alias("n_predictions"),
                    F.count(F.when(F.isnan(p), 1)).alias("n_nan"),
                    F.count(F.when(F.abs(p) == F.lit(float("inf")), 1)).alias("n_inf"),
                    F.count(F.when(p.isNull(), 1)).alias("n_null"), F.lit(n_inputs).cast("bigint").alias("n_inputs"))
    return counts.withColumn("passed", (F.col("n_predictions") == F.col("n_inputs")) & (F.col("n_nan") + F.col("n_inf") + F.col("n_null") == 0))
