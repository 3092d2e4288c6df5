"""Row validation, expectation suites and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.schema import q


def domain_violations(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """Distinct values outside each allowed set (0 -> passed). The domain
    lists are fixed and tiny, so the check is an ``isin`` filter, no join."""
    structs = []
    for c, allowed in domains.items():
        bad = F.count_distinct(F.when(~F.col(q(c)).isin(allowed), F.col(q(c))))
        structs.append(F.struct(F.lit(c).alias("column_name"), bad.alias("n_outside"),
                                (bad == 0).alias("passed")))
    return df.agg(F.array(*structs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """U4: required names absent from the schema (metadata only)."""
    return [c for c in required if c not in df.columns]


# -- F9 row validation with quarantine -----------------------------------------------

def request_errors(df: DataFrame, numeric_fields: list[str], nsm_field: str,
                   domains: dict[str, list[str]], nsm_max: int = 86399) -> DataFrame:
    """one error list per row (required, numeric, integer NSM in 0..nsm_max,
    enum domains); ``is_valid`` when the list is empty. Columnar, no per-row Python."""
    checks = []
    for c in numeric_fields:
        v = F.col(q(c))
        checks.append(F.when(v.isNull(), F.lit(f"{c}: field required")))
        checks.append(F.when(F.isnan(v), F.lit(f"{c}: not a number")))
    n = F.col(q(nsm_field))
    as_int = F.when(n.cast("string").rlike(r"^\s*[+-]?[0-9]+\s*$"), n.cast("string").try_cast("bigint"))
    checks.append(F.when(n.isNull(), F.lit(f"{nsm_field}: field required")))
    checks.append(F.when(n.isNotNull() & as_int.isNull(), F.lit(f"{nsm_field}: not an integer")))
    checks.append(F.when(as_int < 0, F.lit(f"{nsm_field}: must be >= 0")))
    checks.append(F.when(as_int > nsm_max, F.lit(f"{nsm_field}: must be <= {nsm_max}")))
    for c, allowed in domains.items():
        v = F.col(q(c))
        checks.append(F.when(v.isNull(), F.lit(f"{c}: field required")))
        checks.append(F.when(v.isNotNull() & ~v.isin(allowed), F.lit(f"{c}: not a valid value")))
    errs = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("errors", errs).withColumn("is_valid", F.size("errors") == 0)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine (rows with their error list)."""
    return checked.where(F.col("is_valid")).drop("errors", "is_valid"), checked.where(~F.col("is_valid"))


def require_non_empty(df: DataFrame) -> DataFrame:
    """A batch must hold at least one row."""
    if df.isEmpty():
        raise ValueError("batch must contain at least one row")
    return df


# -- F10 expectation suite ------------------------------------------------------------------

def expectation_suite(df: DataFrame, required: list[str], numeric: list[str], nsm: str,
                      non_negative: list[str], domains: dict[str, list[str]],
                      nsm_upper: int = 86400) -> DataFrame:
    """(check, violations, passed) from one aggregate pass."""
    missing = missing_columns(df, required)
    aggs = []
    aggs.append(F.struct(F.lit("columns_present").alias("check_name"),
                         F.lit(len(missing)).cast("bigint").alias("violations")))
    for c in numeric:
        bad = F.count(F.when(F.col(q(c)).isNotNull() & F.col(q(c)).cast("string").try_cast("double").isNull(), 1))
        aggs.append(F.struct(F.lit(f"castable:{c}").alias("check_name"), bad.alias("violations")))
    for c in required:
        if c in df.columns:
            aggs.append(F.struct(F.lit(f"not_null:{c}").alias("check_name"),
                                 F.count(F.when(F.col(q(c)).isNull(), 1)).alias("violations")))
    aggs.append(F.struct(F.lit(f"range:{nsm}").alias("check_name"),
                         F.count(F.when(~F.col(q(nsm)).between(0, nsm_upper), 1)).alias("violations")))
    for c in non_negative:
        aggs.append(F.struct(F.lit(f"non_negative:{c}").alias("check_name"),
                             F.count(F.when(F.col(q(c)) < 0, 1)).alias("violations")))
    for c, allowed in domains.items():
        aggs.append(F.struct(F.lit(f"domain:{c}").alias("check_name"),
                             F.count(F.when(~F.col(q(c)).isin(allowed), 1)).alias("violations")))
    out = df.agg(F.array(*aggs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")
    return out.withColumn("passed", F.col("violations") == 0)


def outlier_rate(df: DataFrame, cols: list[str], bounds: dict[str, tuple[float, float]],
                 threshold: float = 0.05, digits: int = 9) -> DataFrame:
    """share of values outside the IQR fences per column, passed if < threshold."""
    structs = []
    for c in cols:
        lo, hi = bounds[c]
        v = F.col(q(c))
        rate = F.avg(F.when(v.isNotNull(), (~v.between(F.lit(lo), F.lit(hi))).cast("double")))
        structs.append(F.struct(F.lit(c).alias("column_name"), rate.alias("rate")))
    out = df.agg(F.array(*structs).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")
    return out.select("column_name", (F.round("rate", digits) + F.lit(0.0)).alias("outlier_rate"),
                      (F.col("rate") < threshold).alias("passed"))
