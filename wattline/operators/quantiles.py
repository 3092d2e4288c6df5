"""Exact, linearly interpolated quantiles (pandas / ``quantile_cont`` rule).

The two ranks around p * (n - 1) are found by sketch and bracket
(:mod:`wattline.operators.selection`) or, per group, from running counts of the
distinct values; memory of a task never depends on the number of distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.ordering import prefix_sums
from wattline.operators.selection import around, select_ranks
from wattline.schema import q


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Quantiles of several columns together; [None, ..] for a column without values."""
    def ranks(_name: str, n: int, _rows: int) -> list[int]:
        return [r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    found = select_ranks(df, {c: F.col(q(c)).cast("double") for c in cols}, ranks, around(probs))
    out = {}
    for c in cols:
        n, at = found[c].n, found[c].at
        out[c] = [None] * len(probs)
        for i, p in enumerate(probs if n else []):
            pos = p * (n - 1)
            lo, hi = float(at[math.floor(pos)][0]), float(at[math.ceil(pos)][0])
            out[c][i] = lo if lo == hi else lo + (pos - math.floor(pos)) * (hi - lo)
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    return column_quantiles(df, [col], probs)[col]


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str]) -> DataFrame:
    """Exact interpolated quantiles per group: (keys..., names...).

    Counts per (group, value), so a hot group collapses to its distinct values, then
    running counts in (group, value) order, and the two ranks around p * (n - 1) of
    every group by range conditions. Null keys are a group like others; a group
    without a non-null value has null quantiles.
    """
    x = F.nanvl(F.col(q(value)).cast("double"), F.lit(None).cast("double"))
    rows = df.select(F.struct(*keys).alias("_g"), x.alias("_v"))  # a struct: null keys compare equal
    groups = rows.groupBy("_g").agg(F.count("_v").alias("_n"))
    counts = rows.where(F.col("_v").isNotNull()).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    pre = prefix_sums(counts, ["_g", "_v"], ["_c"])
    base = pre.groupBy("_g").agg(F.min(F.col("_c_cum") - F.col("_c")).alias("_b"), F.sum("_c").alias("_m"))
    loc = pre.join(base, "_g").select("_g", "_v", "_m", (F.col("_c_cum") - F.col("_b")).alias("_end"),
                                      (F.col("_c_cum") - F.col("_b") - F.col("_c")).alias("_start"))
    picks = []
    for p, n in zip(probs, names, strict=True):
        pos = F.lit(float(p)) * (F.col("_m") - 1)
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            picks.append(F.max(F.when((F.col("_start") <= r) & (r < F.col("_end")), F.col("_v"))).alias(f"_{side}_{n}"))
    picked = loc.groupBy("_g").agg(*picks).withColumnRenamed("_g", "_h")
    out = groups.join(picked, F.col("_g") == F.col("_h"), "left")
    for p, n in zip(probs, names, strict=True):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_lo_{n}"), F.col(f"_hi_{n}")
        out = out.withColumn(n, F.when(lo == hi, lo).otherwise(lo + (pos - F.floor(pos)) * (hi - lo)))
    return out.select(*[F.col("_g")[k].alias(k) for k in keys], *names)
