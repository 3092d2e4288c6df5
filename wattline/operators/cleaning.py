"""Projection, renaming, cleaning and filtering operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.dates import parse_day_first
from wattline.functions.numeric import strict_integer
from wattline.functions.text import (canonicalize, na_literals_to_null, numeric_lenient,
                                     numeric_strict)
from wattline.operators.quantiles import exact_quantiles
from wattline.schema import (CATEGORICAL_COLUMNS, DAY_OF_WEEK_MAP, JUNK_COLUMN, KEY,
                             LOAD_TYPE_MAP, NSM_MAX, NUMERIC_COLUMNS, OUTLIER_STEPS,
                             RAW_COLUMNS, SNAKE_COLUMNS, WEEK_STATUS_MAP, q)
from wattline.session import scratch_path
from wattline.sources.files import write_parquet

CATEGORY_MAPS = {"week_status": WEEK_STATUS_MAP, "day_of_week": DAY_OF_WEEK_MAP,
                 "load_type": LOAD_TYPE_MAP}


# -- projections -------------------------------------------------------------

def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    """B1: drop the listed columns that exist; missing names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """B2: rename every column by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping; unknown keys are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def raw_to_snake(df: DataFrame) -> DataFrame:
    """Raw file names (dotted, parenthesised) -> internal snake case, key first."""
    keep = [c for c in [KEY] if c in df.columns]
    sel = [F.col(c) for c in keep] + [F.col(q(raw)).alias(sn)
                                      for raw, sn in zip(RAW_COLUMNS, SNAKE_COLUMNS)]
    extra = [F.col(q(c)) for c in df.columns if c not in RAW_COLUMNS and c not in keep]
    return df.select(*sel, *extra)


def features_target(df: DataFrame, target: str = "usage_kwh") -> tuple[DataFrame, DataFrame]:
    """The feature columns and the target column (label stays with its key)."""
    keys = [KEY] if KEY in df.columns else []
    return df.drop(target), df.select(*keys, target)


def select_by_kind(df: DataFrame, kind: str) -> DataFrame:
    """Keep numeric or string columns."""
    from pyspark.sql.types import NumericType, StringType
    want = NumericType if kind == "numeric" else StringType
    return df.select(*[q(f.name) for f in df.schema.fields if isinstance(f.dataType, want)])


def existing_columns(df: DataFrame, configured: list[str]) -> list[str]:
    """Configured columns that exist, in configured order."""
    return [c for c in configured if c in df.columns]


# -- cleaning ------------------------------------------------------------------

def na_literals(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A2: CSV missing-value literals -> null on string columns."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: na_literals_to_null(F.col(q(c))) for c in cols})


def clean_numeric(df: DataFrame, cols: list[str], strict: bool = True,
                  integer_cols: tuple[str, ...] = ("nsm",)) -> DataFrame:
    """C1 (strict) / C2 (lenient) token cleaning; B10 whole values -> BIGINT."""
    out = {}
    for c in cols:
        v = numeric_strict(F.col(q(c)), c) if strict else numeric_lenient(F.col(q(c)))
        out[c] = strict_integer(v, c) if c in integer_cols else v
    return df.withColumns(out)


def parse_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """Day-first parse after trimming."""
    return df.withColumn(col, parse_day_first(F.col(q(col))))


def canonicalize_categoricals(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trim, then map inverted-case spellings and 'NAN'."""
    cols = cols or CATEGORICAL_COLUMNS
    return df.withColumns({c: canonicalize(F.col(q(c)), CATEGORY_MAPS[c]) for c in cols})


def replace_values(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Exact value replacement in one column."""
    return df.replace(mapping, subset=[col])


# -- outlier filters -------------------------------------------------------------

def iqr_bounds(df: DataFrame, col: str, k: float = 1.5) -> tuple[float | None, float | None]:
    q1, q3 = exact_quantiles(df, col, [0.25, 0.75])
    if q1 is None:
        return None, None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def inlier(col: str, lo: float | None, hi: float | None):
    c = F.col(q(col))
    if lo is None:  # no non-null values: nothing to drop
        return F.lit(True)
    return c.isNull() | c.between(F.lit(lo), F.lit(hi))


def iqr_filter(df: DataFrame, col: str, k: float = 1.5):
    """keep nulls and values inside [Q1 - k IQR, Q3 + k IQR]; also the bounds."""
    lo, hi = iqr_bounds(df, col, k)
    return df.where(inlier(col, lo, hi)), (lo, hi)


def iqr_mask(df: DataFrame, col: str, k: float = 1.5, name: str = "is_inlier"):
    """the same rule as a boolean column, no filtering."""
    lo, hi = iqr_bounds(df, col, k)
    return df.withColumn(name, inlier(col, lo, hi)), (lo, hi)


def chained_iqr(df: DataFrame, steps=OUTLIER_STEPS, stored: bool = False):
    """Sequential IQR filters; each step's quartiles use the survivors.
    Returns the filtered frame and the report [(step, column, k, lo, hi)]. `stored`:
    `df` is a scan of a stored table.

    The bounds of a step are two driver scalars, so the plan stays one scan with a
    growing filter. The columns of the steps are computed once and stored; a step's
    aggregates read only those filtered so far.
    """
    cond = F.lit(True)
    report = []
    names = list(dict.fromkeys(col for col, _ in steps))
    spark = df.sparkSession
    narrow = df if stored else spark.read.parquet(write_parquet(df.select(*[q(c) for c in names]), scratch_path(spark, "iqr_columns")))
    for i, (col, k) in enumerate(steps, start=1):
        lo, hi = iqr_bounds(narrow.where(cond), col, k)
        cond = cond & inlier(col, lo, hi)
        report.append((i, col, float(k), lo, hi))
    return df.where(cond), report


def chained_iqr_report(df: DataFrame, steps) -> DataFrame:
    """F4 report: (step, col, k, lo, hi, rows_in, rows_out), computed in Spark."""
    spark = df.sparkSession
    _, report = chained_iqr(df, steps)
    cond = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("rows_0")]
    for i, col, k, lo, hi in report:
        cond = cond & inlier(col, lo, hi)
        aggs.append(F.count(F.when(cond, 1)).alias(f"rows_{i}"))
    counts = df.agg(*aggs)  # one pass for all step counts
    rows = [(i, col, k, lo, hi) for i, col, k, lo, hi in report]
    bounds = spark.createDataFrame(rows, "step bigint, col string, k double, lo double, hi double")
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("step"),
                 F.col(f"rows_{i - 1}").alias("rows_in"),
                 F.col(f"rows_{i}").alias("rows_out")) for i, *_ in report])).alias("s")).select("s.*")
    return bounds.join(stacked, "step")


def nsm_range(df: DataFrame, max_nsm: int = NSM_MAX, col: str = "nsm") -> DataFrame:
    """keep nsm <= max (null dropped, as a comparison with null is false)."""
    return df.where(F.col(col) <= F.lit(max_nsm))


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with any null (in `subset` if given)."""
    return df.na.drop("any", subset=subset)


def typed_readings(dirty: DataFrame) -> DataFrame:
    """A2 (reader literals) -> snake names -> C3 dates -> B1 drop junk -> C1 numbers."""
    df = na_literals(dirty)
    df = raw_to_snake(df)
    df = parse_dates(df, "date")
    df = drop_if_exists(df, [JUNK_COLUMN])
    return clean_numeric(df, NUMERIC_COLUMNS, strict=True)


def clean_readings(dirty: DataFrame, steps=OUTLIER_STEPS) -> DataFrame:
    """The whole cleaning chain, in the reference order.

    typed (A2, B2, C3, B1, C1) -> F3 chained IQR -> F5 NSM rule -> C5-C7
    categories -> F6 drop nulls. The text is parsed once, into a stored typed table
    from which every later pass reads only the columns that it needs; the categories,
    which no row filter before them reads, are mapped there too. The bounds are
    those of this very frame; nothing is kept between calls.
    """
    rows = canonicalize_categoricals(typed_readings(dirty))
    typed = write_parquet(rows, scratch_path(dirty.sparkSession, "readings_typed"))
    df, _ = chained_iqr(dirty.sparkSession.read.parquet(typed), steps, stored=True)
    return drop_nulls(nsm_range(df))
