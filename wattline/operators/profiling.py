"""Profiling aggregates.

Every statistic over many columns is one pass: a single global aggregate
whose partial results are combined map-side, emitted as an array of
per-column structs and exploded into a long table (column_name, stats...).
Value frequency tables go through one ``groupBy`` on (column, value) after an
``explode`` to long form, so a hot value is pre-aggregated before the shuffle.
Per-group windows over unbounded groups are avoided: maxima per group are
computed by ``groupBy`` and joined back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.quantiles import column_quantiles, grouped_quantiles
from wattline.schema import q


def _num(c: str) -> Column:
    return F.col(q(c)).cast("double")


def per_column(df: DataFrame, cols: list[str], stats: dict) -> DataFrame:
    """One aggregate pass -> (column_name, <stat>...) per column."""
    structs = [F.struct(F.lit(c).alias("column_name"),
                        *[fn(c).alias(name) for name, fn in stats.items()]) for c in cols]
    return (df.agg(F.array(*structs).alias("_s"))
              .select(F.explode("_s").alias("_s")).select("_s.*"))


def value_text(c: str, dtype: T.DataType) -> Column:
    """Text that tells every two values apart: for floating columns the shortest exact
    decimal (with an exponent below 1e-10 and from 1e17 on)."""
    x = F.col(q(c))
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return x.cast("string")
    size = F.abs(x)
    plain = F.when(size < 1e9, x.cast("decimal(38,28)").cast("string")).otherwise(x.cast("decimal(38,12)").cast("string"))
    return F.when((size == 0) | ((size >= 1e-10) & (size < 1e17)), F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))).otherwise(x.cast("string"))


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, num) triples, one per cell: value as text, num the
    numeric value (null for text columns) for numeric ordering."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def num(c):
        if isinstance(kinds[c], T.NumericType):
            return F.col(q(c)).cast("double")
        return F.lit(None).cast("double")
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), value_text(c, kinds[c]).alias("value"),
                             num(c).alias("num")) for c in cols])
    return df.select(F.explode(arr).alias("_p")).select("_p.*")


# -- G1-G4 --------------------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def missing_pct(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    cols = cols or df.columns
    return per_column(df, cols, {"pct_missing": lambda c: F.round(
        F.avg(F.col(q(c)).isNull().cast("double")) * F.lit(100.0), digits) + F.lit(0.0)})


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per-column nulls plus a '__total__' row."""
    cols = cols or df.columns
    per = per_column(df, cols, {"n_null": lambda c: F.count(F.lit(1)) - F.count(F.col(q(c)))})
    total = per.agg(F.lit("__total__").alias("column_name"), F.sum("n_null").cast("bigint").alias("n_null"))
    return per.unionByName(total)


def structure(df: DataFrame) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return per_column(df, df.columns, {"data_type": lambda c: F.lit(types[c]),
                                       "non_null": lambda c: F.count(F.col(q(c)))})


# -- G5, G6, G11, G15 ----------------------------------------------------------------

def describe(df: DataFrame, cols: list[str], digits: int = 6, extended: bool = False) -> DataFrame:
    """G5 count/mean/std/min/25/50/75/max. G6 adds skew and kurt, and has one row per
    column and mode (no cell grows with the number of ties)."""
    spark = df.sparkSession
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    qrows = [(c, *[None if v is None else float(v) for v in qs[c]]) for c in cols]
    qdf = spark.createDataFrame(qrows, "column_name string, q25 double, q50 double, q75 double")
    stats = {
        "count": lambda c: F.count(F.col(q(c))),
        "mean": lambda c: F.avg(_num(c)),
        "std": lambda c: F.stddev_samp(_num(c)),
        "min": lambda c: F.min(_num(c)),
        "max": lambda c: F.max(_num(c)),
    }
    if extended:
        stats["g1"] = lambda c: F.skewness(_num(c))
        stats["g2"] = lambda c: F.kurtosis(_num(c))
    base = per_column(df, cols, stats).join(F.broadcast(qdf), "column_name")  # <= #columns rows
    # exact-valued statistics keep 9 digits; floating-noisy ones (std, moments) `digits`
    rd = lambda c, d=9: F.round(F.col(c), d) + F.lit(0.0)
    sel = [F.col("column_name"), F.col("count").cast("bigint").alias("count"), rd("mean").alias("mean"),
           rd("std", digits).alias("std"), rd("min").alias("min"), rd("q25").alias("q25"),
           rd("q50").alias("q50"), rd("q75").alias("q75"), rd("max").alias("max")]
    if not extended:
        return base.select(*sel)
    n = F.col("count").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    md = modes_table(df, cols).select("column_name", F.col("value").alias("mode"))
    return (base.select(*sel, (F.round(F.nanvl(skew, F.lit(None)), digits) + F.lit(0.0)).alias("skew"),
                        (F.round(F.nanvl(kurt, F.lit(None)), digits) + F.lit(0.0)).alias("kurt"))
                .join(md, "column_name", "left"))


def baseline_profile(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Mean, population std, min, max; nulls excluded; empty columns skipped."""
    prof = per_column(df, cols, {
        "n": lambda c: F.count(F.col(q(c))),
        "mean": lambda c: F.avg(_num(c)), "std": lambda c: F.stddev_pop(_num(c)),
        "min": lambda c: F.min(_num(c)), "max": lambda c: F.max(_num(c))})
    rd = lambda c, d=9: (F.round(F.col(c), d) + F.lit(0.0)).alias(c)
    return prof.where(F.col("n") > 0).select("column_name", rd("mean"), rd("std", digits), rd("min"), rd("max"))


def quartiles(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """Exact interpolated Q1 / median / Q3 per column."""
    spark = df.sparkSession
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, *[None if v is None else float(v) for v in qs[c]]) for c in cols]
    out = spark.createDataFrame(rows, "column_name string, q25 double, q50 double, q75 double")
    return out.select("column_name", *[(F.round(k, digits) + F.lit(0.0)).alias(k) for k in ("q25", "q50", "q75")])


# -- G7-G10 ----------------------------------------------------------------------------------

def value_counts(df: DataFrame, cols: list[str], dropna: bool = False) -> DataFrame:
    """(column_name, value, n) with nulls counted (or dropped)."""
    lv = long_values(df, cols)
    if dropna:
        lv = lv.where(F.col("value").isNotNull())
    return lv.groupBy("column_name", "value", "num").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every most-frequent non-null value per column (all ties kept)."""
    vc = value_counts(df, cols, dropna=True)
    top = vc.groupBy("column_name").agg(F.max("n").alias("_max"))  # one row per column
    return (vc.join(F.broadcast(top), "column_name")
              .where(F.col("n") == F.col("_max")).drop("_max"))


def modes_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """G7 as rows: (column_name, value, n)."""
    return modes(df, cols).drop("num")


def categorical_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, unique, top (smallest value among the most frequent), freq."""
    vc = value_counts(df, cols, dropna=True).drop("num")
    return vc.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def value_share(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """Normalized value counts (null excluded)."""
    vc = value_counts(df, cols, dropna=True).drop("num")
    tot = vc.groupBy("column_name").agg(F.sum("n").alias("_tot"))
    return (vc.join(F.broadcast(tot), "column_name")
              .select("column_name", "value",
                      (F.round(F.col("n") / F.col("_tot"), digits) + F.lit(0.0)).alias("share")))


# -- G12-G14, G16 --------------------------------------------------------------------------

def _pairs(cols: list[str]) -> list[tuple[str, str]]:
    """Each unordered pair once, a column with itself included."""
    return [(a, b) for i, a in enumerate(cols) for b in cols[i:]]


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Rows of unordered pairs as the full matrix; columns x_a and x_b change places."""
    turned = {c: c[:-1] + "ba"[c.endswith("b")] if c[-2:] in ("_a", "_b") else c for c in pairs.columns}
    as_is, other = F.struct(*pairs.columns), F.struct(*[F.col(v).alias(c) for c, v in turned.items()])
    rows = F.when(F.col("col_a") == F.col("col_b"), F.array(as_is)).otherwise(F.array(as_is, other))
    return pairs.select(F.explode(rows).alias("_r")).select("_r.*")


def corr_matrix(df: DataFrame, cols: list[str], listwise: bool = True, digits: int = 6,
                half_even: bool = False) -> DataFrame:
    """G12 (list-wise null removal) / G13 (pair-wise): Pearson per pair, long form."""
    src = df.na.drop("any", subset=cols) if listwise else df
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        F.nanvl(F.corr(_num(a), _num(b)), F.lit(None).cast("double")).alias("corr"))
               for a, b in _pairs(cols)]
    out = src.agg(F.array(*structs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")
    rnd = F.bround if half_even else F.round
    return _both_ways(out.withColumn("corr", rnd("corr", digits) + F.lit(0.0)))


def cov_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Sample covariance per pair, with the mean of the first column."""
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        F.covar_samp(_num(a), _num(b)).alias("cov"), F.avg(_num(a)).alias("mean_a"), F.avg(_num(b)).alias("mean_b"))
               for a, b in _pairs(cols)]
    out = _both_ways(df.agg(F.array(*structs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*"))
    return out.select("col_a", "col_b", (F.round("cov", digits) + F.lit(0.0)).alias("cov"),
                      (F.round("mean_a", 9) + F.lit(0.0)).alias("mean_a"))


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (null-safe), by one grouped shuffle."""
    cols = cols or df.columns
    groups = df.groupBy(*[q(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
                      F.count(F.lit(1)).alias("n_distinct"))


# -- G17-G19, G25 ---------------------------------------------------------------------------

def _ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, lo, hi, n): numpy widens a zero range by 0.5 each side."""
    per = per_column(df, cols, {"lo": lambda c: F.min(_num(c)), "hi": lambda c: F.max(_num(c)),
                                "n": lambda c: F.count(F.col(q(c)))})
    same = F.col("lo") == F.col("hi")
    return per.select("column_name", F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                      F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), "n")


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins); the top edge belongs to the last bin."""
    b = F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)).cast("bigint")
    return F.least(b, F.lit(bins - 1))


def histogram(df: DataFrame, cols: list[str], bins: int = 30, density: bool = False,
              log_counts: bool = False, digits: int = 9) -> DataFrame:
    """(column_name, bin, lo_edge, hi_edge, count[, density|log10])."""
    rng = _ranges(df, cols)  # one row per column: safe to broadcast
    lv = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _num(c).alias("x"))
                                       for c in cols])).alias("_p")).select("_p.*")
    lv = lv.where(F.col("x").isNotNull()).join(F.broadcast(rng), "column_name")
    counts = lv.groupBy("column_name", bin_index(F.col("x"), F.col("lo"), F.col("hi"), bins)
                        .alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("column_name", "lo", "hi", "n",
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    out = grid.join(counts, ["column_name", "bin"], "left").select(
        "column_name", "bin",
        (F.round(F.col("lo") + F.col("bin") * w, digits) + F.lit(0.0)).alias("lo_edge"),
        (F.round(F.col("lo") + (F.col("bin") + 1) * w, digits) + F.lit(0.0)).alias("hi_edge"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"), "n", "lo", "hi")
    extra = []
    if density:
        extra.append((F.round(F.col("count") / (F.col("n") * w), digits) + F.lit(0.0)).alias("density"))
    if log_counts:
        extra.append((F.round(F.when(F.col("count") > 0, F.log10(F.col("count").cast("double"))), digits)
                      + F.lit(0.0)).alias("log10_count"))
    return out.select("column_name", "bin", "lo_edge", "hi_edge", "count", *extra)


def pair_bins(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """2-D binned counts for every pair of columns (non-empty cells)."""
    rng = {r["column_name"]: (r["lo"], r["hi"]) for r in _ranges(df, cols).collect()}  # #cols rows
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            la, ha = rng[a]
            lb, hb = rng[b]
            if la is None or lb is None:
                continue
            parts.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                  bin_index(_num(a), F.lit(la), F.lit(ha), bins).alias("bin_a"),
                                  bin_index(_num(b), F.lit(lb), F.lit(hb), bins).alias("bin_b")))
    cells = df.select(F.explode(F.array(*parts)).alias("_p")).select("_p.*")
    return (cells.where(F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
                 .groupBy("col_a", "col_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n")))


# -- G20-G24 --------------------------------------------------------------------------------

def box_stats(df: DataFrame, value: str, group_cols: list[str] | None = None,
              whis: float = 1.5, digits: int = 9, quartiles: tuple | None = None) -> DataFrame:
    """Quartiles, whiskers at the last point inside the fences,
    outlier count; per group. Null keys are a group of their own."""
    x = _num(value)
    keys = group_cols or []
    if keys:
        qs = grouped_quantiles(df, keys, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    else:
        q1, med, q3 = quartiles or column_quantiles(df, [value], [0.25, 0.5, 0.75])[value]
        qs = df.sparkSession.createDataFrame([(q1, med, q3)], "q1 double, median double, q3 double")
    # per-group quartiles are one row per group; the planner broadcasts them when small
    if keys:
        qs = qs.select(F.struct(*keys).alias("_g"), "q1", "median", "q3")
        fenced = df.withColumn("_k", F.struct(*keys)).join(qs, F.col("_k") == F.col("_g"))
    else:
        fenced = df.crossJoin(F.broadcast(qs))
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - whis * iqr, F.col("q3") + whis * iqr
    inside = x.between(lo, hi)
    out = fenced.groupBy(*[F.col(c) for c in keys], "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count(F.when(x.isNotNull() & ~inside, 1)).alias("n_outliers"),
        F.count(x).alias("n"))
    rd = lambda c: (F.round(F.col(c), digits) + F.lit(0.0)).alias(c)
    return out.select(*keys, rd("q1"), rd("median"), rd("q3"), rd("whisker_lo"), rd("whisker_hi"),
                      "n_outliers", "n")


#: Thresholds of 12 random bits for Poisson(1) counts: rounded 4096 * P(count <= k).
POISSON_STEPS = [round(4096 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(6)]
#: Replicates that one md5 of 32 hex digits gives.
PER_HASH = 10
#: Keys whose sums a task holds before it hands them on (3 kB a key with 200 replicates).
HELD_KEYS = 10_000


def bootstrap_digits(row_id: str, replicates: int, seed: int) -> Column:
    """The md5 digests of "seed:boot.h:id" behind one another, 16 bytes for each PER_HASH
    replicates. They don't depend on partitions or retries."""
    return F.concat(*[F.unhex(F.md5(F.concat_ws(":", F.lit(f"{seed}:boot.{h}"), F.col(row_id).cast("string")))) for h in range(-(-replicates // PER_HASH))])


def bootstrap_weights(digits: pa.Array, replicates: int) -> np.ndarray:
    """(rows x replicates) Poisson(1) counts from these digests; 3 hex digits each."""
    octets = np.frombuffer(b"".join(digits.to_pylist()), dtype=np.uint8).reshape(len(digits), -1, 16)[:, :, :15].reshape(len(digits), -1, 3).astype(np.uint16)
    u = np.stack([octets[:, :, 0] << 4 | octets[:, :, 1] >> 4, (octets[:, :, 1] & 15) << 8 | octets[:, :, 2]], axis=2).reshape(len(digits), -1)
    return np.searchsorted(POISSON_STEPS, np.arange(4096), side="right").astype(np.float64)[u[:, :replicates]]


def _replicate_sums(rows: DataFrame, keys: list[str], replicates: int) -> DataFrame:
    """(_g, _key, _s, _w) of rows (keys.., _x, _digits): by key number and key, the weighted
    sums and the weights of all replicates as arrays, of a part of the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def flushed(kind: pa.DataType) -> pa.RecordBatch:
            both = list(held.values())
            out = pa.RecordBatch.from_arrays([
                pa.array([g for g, _ in held], pa.int32()), pa.array([k for _, k in held], kind),
                pa.array([v[0] for v in both], pa.list_(pa.float64())), pa.array([v[1] for v in both], pa.list_(pa.float64()))], names=["_g", "_key", "_s", "_w"])
            held.clear()
            return out

        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field(0).type
            w = bootstrap_weights(batch.column("_digits"), replicates)
            x = batch.column("_x").to_numpy(zero_copy_only=False)[:, None]
            wx = w * x if np.isfinite(x).all() else np.multiply(w, x, where=w > 0, out=np.zeros_like(w))
            for g in range(len(keys)):
                coded = batch.column(g).dictionary_encode()
                values = [*coded.dictionary.to_pylist(), None]
                code = coded.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False)
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
                sums = np.stack([np.add.reduceat(wx[order], first, axis=0), np.add.reduceat(w[order], first, axis=0)], axis=1)
                for c, both in zip(code[order][first].tolist(), sums):
                    at = (g, values[c])
                    held[at] = held[at] + both if at in held else both
                if len(held) >= HELD_KEYS:
                    yield flushed(kind)
        if held:
            yield flushed(kind)

    schema = T.StructType([T.StructField("_g", T.IntegerType()), T.StructField("_key", rows.schema[keys[0]].dataType),
                           T.StructField("_s", T.ArrayType(T.DoubleType())), T.StructField("_w", T.ArrayType(T.DoubleType()))])
    return rows.select(*keys, "_x", "_digits").mapInArrow(run, schema)


def mean_ci_by(df: DataFrame, value: str, keys: dict[str, Column], row_id: str, name: str = "grain", key_name: str = "key", replicates: int = 200,
               seed: int = 42, level: float = 0.95, digits: int = 6) -> DataFrame:
    """G22 for several groupings (name -> key, all of one type): mean with a bootstrap
    percentile interval. Every row counts Poisson(1) times in each replicate, so a
    replicate's mean is a quotient of two sums and all replicates of all groupings are one
    pass, however large a group is: a task adds up its rows by key, then the tasks' sums are
    added. Null values are left out; null keys are a group."""
    x = _num(value)
    cols = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[k.alias(c) for c, k in zip(cols, keys.values(), strict=True)], x.alias("_x"), F.col(row_id).alias("_id")).where("_x is not null")
    each_key = F.explode(F.array(*[F.struct(F.lit(i).alias("g"), F.col(c).alias("k")) for i, c in enumerate(cols)]))
    means = rows.select(each_key.alias("_e"), "_x").groupBy(F.col("_e.g").alias("_h"), F.col("_e.k").alias(key_name)).agg(F.count("_x").alias("n"), F.avg("_x").alias("mean"))
    parts = _replicate_sums(rows.withColumn("_digits", bootstrap_digits("_id", replicates, seed)), cols, replicates)
    cells = parts.select("_g", "_key", F.posexplode(F.arrays_zip("_s", "_w")).alias("_b", "_v"))
    each = cells.groupBy("_g", "_key", "_b").agg(F.sum("_v._s").alias("_s"), F.sum("_v._w").alias("_w")).where("_w > 0")
    # at most `replicates` means a group from here on
    sorted_means = each.groupBy("_g", "_key").agg(F.sort_array(F.collect_list(F.col("_s") / F.col("_w"))).alias("_sorted"))

    def at(p: float) -> Column:
        place = F.lit(p) * (F.size("_sorted") - 1)
        lo, hi = F.get("_sorted", F.floor(place).cast("int")), F.get("_sorted", F.ceil(place).cast("int"))
        return lo + (place - F.floor(place)) * (hi - lo)

    rd = lambda e, n: (F.round(e, digits) + F.lit(0.0)).alias(n)
    out = means.join(sorted_means, (F.col("_h") == F.col("_g")) & F.col(key_name).eqNullSafe(F.col("_key")), "left")
    return out.select(F.element_at(F.array(*[F.lit(k) for k in keys]), F.col("_h") + 1).alias(name), key_name, "n", (F.round("mean", 9) + F.lit(0.0)).alias("mean"),
                      rd(at((1 - level) / 2), "ci_lo"), rd(at((1 + level) / 2), "ci_hi"))


def mean_ci(df: DataFrame, value: str, key: Column, row_id: str, key_name: str = "key", replicates: int = 200, seed: int = 42,
            level: float = 0.95, digits: int = 6) -> DataFrame:
    """G22 for one grouping; see `mean_ci_by`."""
    return mean_ci_by(df, value, {"": key}, row_id, "_grain", key_name, replicates, seed, level, digits).drop("_grain")


#: Bins of a density per bandwidth, and how many bandwidths the kernel reaches: beyond it
#: lies less than 10^-17 of its weight.
BINS_PER_WIDTH, REACH = 64, 9.0


def kde(df: DataFrame, value: str, group: str, grid_size: int = 200, cut: float = 3.0,
        digits: int = 9) -> DataFrame:
    """Gaussian density per group on a grid from min - cut*bw to max + cut*bw,
    Scott bandwidth bw = s * n^(-1/5) (s = sample std).

    Values are shared between the two nearest points of a fine grid of bw / BINS_PER_WIDTH
    (linear binning: a relative error of the order of its square / 8), so a group has at
    most range / bw * BINS_PER_WIDTH rows after one aggregate; each of them meets the grid
    points within REACH bandwidths."""
    x = _num(value)
    rows = df.select(F.col(group).alias("grp"), x.alias("x")).where("x is not null")
    st = (rows.groupBy("grp").agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi"))
          .withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("bw") > 0)
          .withColumn("fine", F.col("bw") / F.lit(float(BINS_PER_WIDTH)))
          .withColumn("g0", F.col("lo") - cut * F.col("bw"))
          .withColumn("gs", (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / F.lit(float(grid_size - 1))))
    # the planner broadcasts the groups if it has measured them as small
    t = (F.col("x") - F.col("lo")) / F.col("fine")
    cell = rows.join(st.select("grp", "lo", "fine"), "grp").select("grp", F.floor(t).alias("j"), (t - F.floor(t)).alias("f"))
    binned = cell.groupBy("grp", "j").agg(F.count(F.lit(1)).alias("c"), F.sum("f").alias("f"))
    both = F.array(F.struct(F.col("j").alias("j"), (F.col("c") - F.col("f")).alias("w")), F.struct((F.col("j") + 1).alias("j"), F.col("f").alias("w")))
    points = binned.select("grp", F.inline(both)).groupBy("grp", "j").agg(F.sum("w").alias("w")).join(st, "grp")
    at = F.col("lo") + F.col("j") * F.col("fine")
    first = F.greatest(F.lit(0), F.ceil((at - REACH * F.col("bw") - F.col("g0")) / F.col("gs"))).cast("int")
    last = F.least(F.lit(grid_size - 1), F.floor((at + REACH * F.col("bw") - F.col("g0")) / F.col("gs"))).cast("int")
    near = points.select("grp", "w", "bw", "g0", "gs", at.alias("at"), F.explode(F.when(first <= last, F.sequence(first, last))).alias("gi"))
    z = (F.col("g0") + F.col("gi") * F.col("gs") - F.col("at")) / F.col("bw")
    dens = near.groupBy("grp", "gi").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
    grid = st.select("grp", "n", "bw", "g0", "gs", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("gi"))
    density = F.coalesce("s", F.lit(0.0)) / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    return grid.join(dens, ["grp", "gi"], "left").select(
        F.col("grp").alias(group), F.col("gi").cast("bigint").alias("grid_index"), (F.round(F.col("g0") + F.col("gi") * F.col("gs"), digits) + F.lit(0.0)).alias("x"),
        (F.round(density, digits) + F.lit(0.0)).alias("density"))


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows kept after cleaning, percent, half-even to 2 digits."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return b.crossJoin(a).select("rows_before", "rows_after", (F.bround(
        F.col("rows_after") * 100.0 / F.col("rows_before"), 2) + F.lit(0.0)).alias("retention_pct"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """G27."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))



def box_stats_columns(df: DataFrame, cols: list[str], whis: float = 1.5) -> DataFrame:
    """G20 for many columns: quartiles of all columns together, then one box
    aggregate per column."""
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    out = None
    for c in cols:
        part = box_stats(df, c, whis=whis, quartiles=tuple(qs[c])).withColumn("column_name", F.lit(c))
        out = part if out is None else out.unionByName(part)
    return out
