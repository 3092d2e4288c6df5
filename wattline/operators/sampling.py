"""Sampling and shuffling by keyed hash draws.

Rows get a dense 0-based index (scalable row number); a draw for output
position i picks source index hash(seed, stream, i) mod N and is resolved by
an equi-join on the index: no driver loop, no per-row Python, and the same
draws after a retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.draws import hash60
from wattline.operators.ordering import row_number

IDX = "_src"


def indexed(df: DataFrame, order_cols: list[str], name: str = IDX) -> DataFrame:
    """Dense 0-based index in a fixed order (give a unique key)."""
    return row_number(df, order_cols, name=name, base=0)


def positions(spark, n: int | None = None, like: DataFrame | None = None, col: str = "i") -> DataFrame:
    """Output positions 0..n-1; with `like` (an indexed frame) it reuses its index."""
    if like is not None:
        return like.select(F.col(IDX).alias(col))
    return spark.range(int(n)).select(F.col("id").alias(col))


def sample_with_replacement(idx: DataFrame, n_src: int, pos: DataFrame, seed: int = 42,
                            stream: str = "sample", col: str = "i") -> DataFrame:
    """For each position i a uniformly drawn source row."""
    draws = pos.withColumn(IDX, F.pmod(hash60(seed, stream, F.col(col)), F.lit(n_src)))
    return draws.join(idx, IDX).drop(IDX)


def random_pair(pos: DataFrame, n_src: int, seed: int, col: str = "i"):
    """Two different source indexes per position: r1 uniform, r2 = (r1 + 1 + h' mod (N-1)) mod N."""
    r1 = F.pmod(hash60(seed, "pair.1", F.col(col)), F.lit(n_src))
    step = F.pmod(hash60(seed, "pair.2", F.col(col)), F.lit(max(n_src - 1, 1)))
    return pos.withColumn("_r1", r1).withColumn("_r2", F.pmod(F.col("_r1") + 1 + step, F.lit(n_src)))


def shuffle(df: DataFrame, key: str, seed: int = 42, stream: str = "shuffle", name: str = "position") -> DataFrame:
    """A reproducible permutation: order by hash(seed, key) with the key as tie-break."""
    keyed = df.withColumn("_h", hash60(seed, stream, F.col(key)))
    return row_number(keyed, ["_h", key], name=name, base=0).drop("_h")
