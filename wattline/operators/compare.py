"""Comparison of two data sets.

Distribution distances need each sample's CDF over the merged, sorted values.
Values are first reduced to (column, value) -> (count in set 1, count in set
2) by one grouped shuffle, so duplicates and hot values collapse; running
counts in value order come from a range-partitioned prefix sum (no window
over a whole column in one task) and the next value from an equi-join on the
position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.ordering import prefix_sums
from wattline.operators.profiling import bin_index
from wattline.schema import q


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union all by column name; absent columns are null-filled."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """U2."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def _long_two(df: DataFrame, cols: list[str], tag: str, first: str, second: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(q(c)).cast("double").alias("value"))
                    for c in cols])
    t = F.col(tag)
    return (df.where(t.isin(first, second))
              .select(F.explode(arr).alias("_p"), (t == first).cast("bigint").alias("i1"),
                      (t == second).cast("bigint").alias("i2"))
              .select("_p.*", "i1", "i2")
              .where(F.col("value").isNotNull() & ~F.isnan("value")))


def cdf_table(df: DataFrame, cols: list[str], tag: str, first: str, second: str) -> DataFrame:
    """Per column and distinct merged value: F1, F2 (right-continuous
    empirical CDFs) and the next larger value (null for the last)."""
    counts = (_long_two(df, cols, tag, first, second)
              .groupBy("column_name", "value").agg(F.sum("i1").alias("c1"), F.sum("i2").alias("c2")))
    pre = prefix_sums(counts, ["column_name", "value"], ["c1", "c2"], rank_col="pos")
    base = pre.groupBy("column_name").agg(
        F.min(F.col("c1_cum") - F.col("c1")).alias("b1"), F.min(F.col("c2_cum") - F.col("c2")).alias("b2"),
        F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))  # one row per column
    nxt = pre.select((F.col("pos") - 1).alias("pos"), F.col("column_name").alias("_nc"),
                     F.col("value").alias("next_value"))
    out = (pre.join(F.broadcast(base), "column_name")
              .join(nxt, ["pos"], "left")
              .withColumn("next_value", F.when(F.col("_nc") == F.col("column_name"), F.col("next_value"))))
    return out.select("column_name", "value",
                      ((F.col("c1_cum") - F.col("b1")) / F.col("n1")).alias("f1"),
                      ((F.col("c2_cum") - F.col("b2")) / F.col("n2")).alias("f2"),
                      "next_value", "n1", "n2")


def wasserstein(df: DataFrame, cols: list[str], tag: str, first: str, second: str,
                digits: int = 6) -> DataFrame:
    """W1 per column, sum |F1 - F2| * (next - value), sorted descending."""
    cdf = cdf_table(df, cols, tag, first, second)
    w = cdf.groupBy("column_name").agg(F.sum(F.when(F.col("next_value").isNotNull(),
        F.abs(F.col("f1") - F.col("f2")) * (F.col("next_value") - F.col("value")))).alias("w"),
        F.first("n1").alias("n1"), F.first("n2").alias("n2"))
    return (w.where((F.col("n1") > 0) & (F.col("n2") > 0))
             .select("column_name", (F.round(F.coalesce("w", F.lit(0.0)), digits) + F.lit(0.0))
                     .alias("wasserstein"))
             .orderBy(F.col("wasserstein").desc(), "column_name"))


def ks_statistic(df: DataFrame, cols: list[str], tag: str, first: str, second: str,
                 digits: int = 6) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic, max |F1 - F2|."""
    cdf = cdf_table(df, cols, tag, first, second)
    return cdf.groupBy("column_name").agg(
        (F.round(F.max(F.abs(F.col("f1") - F.col("f2"))), digits) + F.lit(0.0)).alias("ks"))


def jensen_shannon(df: DataFrame, cols: list[str], tag: str, first: str, second: str,
                   bins: int = 30, eps: float = 1e-10, digits: int = 3) -> DataFrame:
    """JS distance (natural log) on 30 bins spanning data set 1's range;
    set-2 values outside it are ignored; densities + eps, renormalized."""
    lv = _long_two(df, cols, tag, first, second)
    rng = (lv.where(F.col("i1") == 1).groupBy("column_name")
             .agg(F.min("value").alias("lo0"), F.max("value").alias("hi0")))
    same = F.col("lo0") == F.col("hi0")
    rng = rng.select("column_name", F.when(same, F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(same, F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    inr = lv.join(F.broadcast(rng), "column_name").where(F.col("value").between(F.col("lo"), F.col("hi")))
    cnt = inr.groupBy("column_name", bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin")) \
             .agg(F.sum("i1").alias("c1"), F.sum("i2").alias("c2"))
    grid = rng.select("column_name", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                                   F.lit(bins - 1).cast("bigint"))).alias("bin"))
    full = grid.join(cnt, ["column_name", "bin"], "left").na.fill(0, ["c1", "c2"])
    wdt = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    tot = full.groupBy("column_name").agg(F.sum("c1").alias("n1"), F.sum("c2").alias("n2"))
    dens = full.join(F.broadcast(tot), "column_name").select(
        "column_name",
        (F.col("c1") / (F.col("n1") * wdt) + F.lit(eps)).alias("p"),
        (F.col("c2") / (F.col("n2") * wdt) + F.lit(eps)).alias("q"))
    sums = dens.groupBy("column_name").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    nrm = dens.join(F.broadcast(sums), "column_name").select(
        "column_name", (F.col("p") / F.col("sp")).alias("p"), (F.col("q") / F.col("sq")).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    terms = nrm.select("column_name", (F.col("p") * F.log(F.col("p") / m)).alias("kp"),
                       (F.col("q") * F.log(F.col("q") / m)).alias("kq"))
    js = terms.groupBy("column_name").agg(F.sqrt((F.sum("kp") + F.sum("kq")) / 2).alias("js"))
    return (js.select("column_name", (F.round("js", digits) + F.lit(0.0)).alias("js_distance"))
              .orderBy(F.col("js_distance").desc(), "column_name"))

