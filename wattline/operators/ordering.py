"""Global order without a single-task window.

``Window.orderBy`` with no partition runs in one task. Instead: range
partition on the order keys (the sampler splits hot key values across
partitions when a tie-breaker is part of the key), sort inside partitions,
tag rows with their partition and local position, cut lineage with a
reliable checkpoint (so a retried task sees the same placement), and add
per-partition offsets from a table of at most `partitions` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.draws import hash60
from wattline.operators.selection import before_or_at, cut_point, cut_points
from wattline.session import checkpoint_root

_LOCAL_BITS = 33
_PID, _LOC, _MID = "_wl_pid", "_wl_loc", "_wl_mid"


#: Rows of one sorted partition.
ROWS_PER_PARTITION = 5_000_000


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Enough partitions for the rows there are, and at least the session's number."""
    if partitions:
        return int(partitions)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-df.count() // ROWS_PER_PARTITION))


def _cols(cols) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _tag(df: DataFrame, order_cols, partitions: int | None) -> DataFrame:
    checkpoint_root(df.sparkSession)
    oc = _cols(order_cols)
    ranged = (df.repartitionByRange(_partitions(df, partitions), *oc)
                .sortWithinPartitions(*oc)
                .withColumn(_MID, F.monotonically_increasing_id()))
    tagged = ranged.checkpoint(eager=True)
    return (tagged
            .withColumn(_PID, F.shiftright(F.col(_MID), _LOCAL_BITS))
            .withColumn(_LOC, F.col(_MID).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
            .drop(_MID))


def _offsets(totals: DataFrame, cols: list[str]) -> DataFrame:
    """Exclusive running totals over partition ids (<= #partitions rows)."""
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        _PID, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_off") for c in cols])


def row_number(df: DataFrame, order_cols, name: str = "rn",
               partitions: int | None = None, base: int = 1) -> DataFrame:
    """Dense global row number (starting at `base`) in `order_cols` order.

    Give `order_cols` a unique tie-breaker: equal keys are numbered in an
    arbitrary but fixed order otherwise.
    """
    tagged = _tag(df, order_cols, partitions)
    totals = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_wl_n"))
    offs = _offsets(totals, ["_wl_n"])
    return (tagged.join(F.broadcast(offs), _PID)
                  .withColumn(name, F.col("_wl_n_off") + F.col(_LOC) + F.lit(base))
                  .drop(_PID, _LOC, "_wl_n_off"))


def prefix_sums(df: DataFrame, order_cols, sum_cols: list[str], suffix: str = "_cum",
                partitions: int | None = None, rank_col: str | None = None) -> DataFrame:
    """Inclusive running sums of `sum_cols` in `order_cols` order (and, if
    `rank_col` is given, the 1-based position).

    Meant for tables already reduced by a ``groupBy`` (e.g. value -> count),
    where a hot value is one row; the order keys should be unique.
    """
    tagged = _tag(df, order_cols, partitions).withColumn("_wl_one", F.lit(1))
    cols = list(sum_cols) + ["_wl_one"]
    w = Window.partitionBy(_PID).orderBy(_LOC).rowsBetween(Window.unboundedPreceding, 0)
    within = tagged.select("*", *[F.sum(c).over(w).alias(f"_wl_{c}_in") for c in cols])
    totals = tagged.groupBy(_PID).agg(*[F.sum(c).alias(c) for c in cols])
    offs = _offsets(totals, cols)
    out = within.join(F.broadcast(offs), _PID)
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.col(f"{c}_off") + F.col(f"_wl_{c}_in")) \
                 .drop(f"{c}_off", f"_wl_{c}_in")
    if rank_col:
        out = out.withColumnRenamed(f"_wl_one{suffix}", rank_col)
    else:
        out = out.drop(f"_wl_one{suffix}")
    return out.drop(_PID, _LOC, "_wl_one")


def _whole(c) -> Column:
    """An order key as an integer: dates and timestamps by their microseconds."""
    kind = c[1]
    x = F.col(c[0])
    return F.unix_micros(x.cast("timestamp")) if kind.startswith(("timestamp", "date")) else x.cast("long")


def first_rows(df: DataFrame, order_cols: list[str], rows: int | Callable[[int], int]) -> Column:
    """Condition that holds for the first `rows` rows (a number, or a function of how many
    there are) in the order of these integer or time columns, nulls last. The row at the
    limit is found by counting aggregates, column by column within its ties, so nothing
    is sorted, moved or stored."""
    kinds = dict(df.dtypes)
    order = [_whole((c, kinds[c])) for c in order_cols]
    number = rows if callable(rows) else lambda n: rows
    return before_or_at(order, cut_point(df.select(*order_cols), order, lambda n: min(n, number(n)) - 1))


def after_positions(df: DataFrame, order_cols: list[str], positions: Callable[[int], list[int]]) -> Column:
    """How many of positions(n) (ascending, n rows) a row lies behind, in the order of these
    columns as in `first_rows`; the limits are found together."""
    kinds = dict(df.dtypes)
    order = [_whole((c, kinds[c])) for c in order_cols]
    limits = cut_points(df.select(*order_cols), order, lambda n: [min(n, m) - 1 for m in positions(n)])
    return sum(((~before_or_at(order, values)).cast("int") for values in limits), F.lit(0))


def time_split(df: DataFrame, order_cols: list[str], test_size: float = 0.2, label: str = "split") -> DataFrame:
    """L2: the last ceil(test_size * n) rows in time order are 'test' (`order_cols`: the
    time column, then a unique tie-breaker; rows equal in all of them stay together).
    Keys that are null sort last."""
    first = first_rows(df, order_cols, lambda n: n - math.ceil(test_size * n))
    return df.withColumn(label, F.when(first, F.lit("train")).otherwise(F.lit("test")))


def random_split(df: DataFrame, key: str, seed: int = 42, test_size: float = 0.2, label: str = "split",
                 tie_break: list[str] | None = None) -> DataFrame:
    """L3: exactly ceil(test_size * n) 'test' rows, the first ones by a keyed hash of the
    integer `key` (then the key, then `tie_break`); a null key hashes to null, which sorts last."""
    keyed = df.withColumn("_wl_h", hash60(seed, "split", F.col(key)))
    keyed = keyed.withColumn("_wl_h", F.when(F.col(key).isNotNull(), F.col("_wl_h")))
    first = first_rows(keyed, ["_wl_h", key, *(tie_break or [])], lambda n: math.ceil(test_size * n))
    return keyed.withColumn(label, F.when(first, F.lit("test")).otherwise(F.lit("train"))).drop("_wl_h")


def head(df: DataFrame, order_cols, n: int = 5) -> DataFrame:
    """L8 first rows (top-k: a partial sort per partition, then a merge)."""
    return df.orderBy(*_cols(order_cols)).limit(n)


def tail(df: DataFrame, order_cols, n: int = 5) -> DataFrame:
    """L8 last rows: top-k of the reversed order."""
    rev = [(c if isinstance(c, Column) else F.col(c)).desc() for c in order_cols]
    return df.orderBy(*rev).limit(n)

