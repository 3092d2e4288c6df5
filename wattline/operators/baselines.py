"""Closed-form predictors fitted by aggregation: global mean, group means,
one-feature least squares. They give every results / ranking / sink operator
a deterministic, data-derived family of model runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.metrics import regression_metrics
from wattline.sources.tables import load
from wattline.operators.ordering import time_split
from wattline.session import checkpoint_root

LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]

# (run_ord, model, params) of the baseline family, in input order.
FAMILY = [
    (1, "GlobalMean", []),
    (2, "GroupMean", [("by", "l_returnflag")]),
    (3, "GroupMean", [("by", "l_linestatus")]),
    (4, "GroupMean", [("by", "l_returnflag+l_linestatus")]),
    (5, "LinearRegression", [("fit_intercept", "True"), ("feature", "l_quantity")]),
    (6, "LinearRegression", [("fit_intercept", "False"), ("feature", "l_quantity")]),
]


def lineitem_split(spark, sf_dir: str) -> DataFrame:
    """L2 on lineitem: target l_extendedprice, time l_shipdate (+ unique tie-break)."""
    li = load(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER, "l_extendedprice", "l_quantity",
                                               "l_returnflag", "l_linestatus")
    return time_split(li, LINEITEM_ORDER, 0.2)


def family_predictions(split: DataFrame, y: str = "l_extendedprice", x: str = "l_quantity") -> DataFrame:
    """Test rows with one prediction column per configuration (p1..p6)."""
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    st = train.agg(F.avg(y).alias("m"), F.regr_slope(y, x).alias("b1"), F.regr_intercept(y, x).alias("b0"),
                   (F.sum(F.col(x) * F.col(y)) / F.sum(F.col(x) * F.col(x))).alias("b_0")).first()
    gm = F.lit(st["m"])
    out = test
    for i, keys in [(2, ["l_returnflag"]), (3, ["l_linestatus"]), (4, ["l_returnflag", "l_linestatus"])]:
        means = train.groupBy(*keys).agg(F.avg(y).alias(f"_m{i}"))
        out = out.join(means, keys, "left")
    return out.select(
        *split.columns,
        gm.alias("p1"), F.coalesce("_m2", gm).alias("p2"), F.coalesce("_m3", gm).alias("p3"),
        F.coalesce("_m4", gm).alias("p4"),
        (F.lit(st["b0"]) + F.lit(st["b1"]) * F.col(x)).alias("p5"),
        (F.lit(st["b_0"]) * F.col(x)).alias("p6"))


def long_predictions(pred: DataFrame, y: str = "l_extendedprice") -> DataFrame:
    """(run_ord, keys..., y, yhat): one row per test row and configuration."""
    arr = F.array(*[F.struct(F.lit(i).alias("run_ord"), F.col(f"p{i}").alias("yhat")) for i, *_ in FAMILY])
    return pred.select(*LINEITEM_KEYS, F.col(y).alias("y"), F.explode(arr).alias("_p")).select(
        F.col("_p.run_ord").alias("run_ord"), *LINEITEM_KEYS, "y", F.col("_p.yhat").alias("yhat"))


def config_table(spark) -> DataFrame:
    """The configuration grid (parameters, not data); params keep their order."""
    rows = [(i, m, [k for k, _ in p], [v for _, v in p]) for i, m, p in FAMILY]
    df = spark.createDataFrame(rows, "run_ord int, model string, k array<string>, v array<string>")
    return df.select("run_ord", "model", F.map_from_arrays("k", "v").alias("params"))


def family_results(spark, sf_dir: str) -> DataFrame:
    """Results table: run_ord, model, params, rmse, mae, r2, cv (one row per config)."""
    long = long_predictions(family_predictions(lineitem_split(spark, sf_dir)))
    met = regression_metrics(long, "y", "yhat", by=["run_ord"])
    checkpoint_root(spark)
    # One row per configuration; written, as several rankings and sinks read it.
    return (config_table(spark).join(met, "run_ord").select("run_ord", "model", "params", "rmse", "mae", "r2", "cv")
            .checkpoint(eager=True))
