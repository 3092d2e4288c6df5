"""Augmentation of a table by keyed draws: noise (S7) and mixed pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.draws import beta_sym, normal, uniform
from wattline.functions.numeric import clip
from wattline.operators.sampling import IDX, indexed, positions, random_pair
from wattline.schema import q


def noisy(df: DataFrame, key: str, cols: list[str], level: float = 0.05, seed: int = 42) -> DataFrame:
    """Each value plus `level` population standard deviations of normal noise drawn
    by the row's key, kept inside the column's range. Columns without values stay."""
    spread = df.agg(*[f(q(c)).alias(f"{name}{i}") for i, c in enumerate(cols)
                      for name, f in (("sd", F.stddev_pop), ("lo", F.min), ("hi", F.max))]).first()
    changed = {}
    for i, c in enumerate(cols):
        if spread[f"sd{i}"] is not None:
            x = F.col(q(c)).cast("double") + F.lit(spread[f"sd{i}"] * level) * normal(seed, f"noise.{c}", key)
            changed[c] = clip(x, spread[f"lo{i}"], spread[f"hi{i}"])
    return df.withColumns(changed)


def mixed_pairs(df: DataFrame, key: str, numeric: list[str], categorical: list[str], alpha: float = 0.2,
                seed: int = 42, n: int | None = None) -> DataFrame:
    """N rows (as many as there are, by default), each mixed from two different
    ones: numbers as w * first + (1 - w) * second with w ~ Beta(alpha, alpha), each
    category from the first with probability w."""
    rows = indexed(df.select(key, *[q(c) for c in numeric + categorical]), [key])
    total = rows.count()
    where = positions(df.sparkSession, n, None if n else rows)

    def side(name: str) -> DataFrame:
        return rows.select(F.col(IDX).alias(f"_r{name}"), *[F.col(q(c)).alias(f"{c}_{name}") for c in numeric + categorical])

    both = random_pair(where, total, seed).join(side("1"), "_r1").join(side("2"), "_r2")
    w = F.col("_w")
    mixed = [(w * F.col(f"{c}_1") + (F.lit(1.0) - w) * F.col(f"{c}_2")).alias(c) for c in numeric]
    mixed += [F.when(uniform(seed, f"mixup.pick.{c}", "i") < w, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2")).alias(c) for c in categorical]
    return both.withColumn("_w", beta_sym(seed, "mixup.lam", "i", alpha)).select("i", *mixed)
