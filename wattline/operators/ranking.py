"""Model-result tables: summaries, rankings, best-by-criterion and the runs view
(W1, W2, L4-L6, K3-K5, C14).

A results table has one row per fitted configuration: ``run_ord`` (input
order), ``model``, ``params`` MAP<STRING,STRING>, ``rmse``, ``mae``, ``r2``,
``cv``. It has as many rows as configurations (74 for the full grid), so
the windows here rank a table whose size is fixed by the grid, not the data.
Every ranking comes from one pass over the table, one row per criterion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.params import params_to_string

# criterion -> (column, ascending)
CRITERIA = {"RMSE": ("rmse", True), "MAE": ("mae", True), "R2": ("r2", False), "CV": ("cv", True)}


def _order(metric: str, asc: bool):
    c = F.col(metric)
    return [c.asc_nulls_last() if asc else c.desc_nulls_last(), F.col("run_ord")]


def summary(results: DataFrame) -> DataFrame:
    """K3: Model, Hyperparameters ("k=v, ..." or "default"), RMSE, MAE, R2, CV."""
    return results.select(F.col("run_ord"), F.col("model").alias("Model"),
                          params_to_string("params").alias("Hyperparameters"),
                          F.col("rmse").alias("RMSE"), F.col("mae").alias("MAE"),
                          F.col("r2").alias("R2"), F.col("cv").alias("CV"))


def rankings(results: DataFrame) -> DataFrame:
    """The four rankings in long form; ties keep input order (row_number)."""
    each = F.explode(F.array(*[F.struct(F.lit(crit).alias("criterion"), F.col(metric).alias("value"),
                                        (F.col(metric) * (1 if asc else -1)).alias("key"))
                               for crit, (metric, asc) in CRITERIA.items()]))
    rows = results.select("run_ord", "model", params_to_string("params").alias("hyperparameters"), each.alias("_c"))
    w = Window.partitionBy("_c.criterion").orderBy(F.col("_c.key").asc_nulls_last(), "run_ord")
    return rows.select("_c.criterion", F.row_number().over(w).alias("rank"), "model", "hyperparameters", "_c.value")


def best_per_model(results: DataFrame, metric: str = "rmse") -> DataFrame:
    """Best configuration inside each algorithm (min RMSE, first wins)."""
    w = Window.partitionBy("model").orderBy(*_order(metric, True))
    return results.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def best_by_criterion(results: DataFrame, criterion: str = "RMSE") -> DataFrame:
    """L4: the best row for one criterion; other names are refused."""
    if criterion not in CRITERIA:
        raise ValueError(f"no ranking by {criterion!r}; there are {', '.join(CRITERIA)}")
    metric, asc = CRITERIA[criterion]
    return results.orderBy(*_order(metric, asc)).limit(1)


def best_by_criterion_table(results: DataFrame) -> DataFrame:
    """K4: Criterion, Best_Model, Hyperparameters, Value (4 rows)."""
    return rankings(results).where("rank = 1").select(
        F.col("criterion").alias("Criterion"), F.col("model").alias("Best_Model"),
        F.col("hyperparameters").alias("Hyperparameters"), F.col("value").alias("Value"))


def compare_models(results: DataFrame) -> DataFrame:
    """All configurations sorted by RMSE, with their position."""
    w = Window.orderBy(*_order("rmse", True))
    return results.select(F.row_number().over(w).alias("position"), "model",
                          params_to_string("params").alias("hyperparameters"), "rmse")


def long_metrics(results: DataFrame) -> DataFrame:
    """K5: ``best_<criterion>_value`` and ``<model>_<METRIC>`` of each model's best run."""
    best = best_by_criterion_table(results).select(
        F.concat(F.lit("best_"), F.lower("Criterion"), F.lit("_value")).alias("key"), F.col("Value").alias("value"))
    per = best_per_model(results)
    stacked = per.select("model", F.explode(F.array(*[
        F.struct(F.lit(c).alias("m"), F.col(m).alias("v")) for c, (m, _) in CRITERIA.items()])).alias("s"))
    per_long = stacked.select(F.concat("model", F.lit("_"), F.col("s.m")).alias("key"), F.col("s.v").alias("value"))
    return best.unionByName(per_long)


def runs_table(results: DataFrame) -> DataFrame:
    """Runs view: one run per configuration; FINISHED when its metrics exist."""
    return results.select(F.concat(F.lit("run-"), F.col("run_ord").cast("string")).alias("run_id"),
                          "run_ord", "model", "params", "rmse", "mae", "r2", "cv",
                          F.when(F.col("rmse").isNotNull() & ~F.isnan("rmse"), F.lit("FINISHED"))
                           .otherwise(F.lit("FAILED")).alias("status"))


def best_finished_run(runs: DataFrame) -> DataFrame:
    """Status FINISHED, lowest RMSE (nulls last); empty input is an error upstream."""
    return (runs.where(F.col("status") == "FINISHED")
                .orderBy(F.col("rmse").asc_nulls_last(), F.col("run_ord")).limit(1))
