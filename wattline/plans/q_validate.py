"""Queries for row validation, expectations and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import validate as va
from wattline.operators import baselines as bl
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, clean
from wattline.plans.q_ranking import RESULT_CTES
from wattline.plans.registry import register
from wattline.schema import (DAY_OF_WEEK_VALUES, LOAD_TYPE_VALUES, NUMERIC_COLUMNS,
                             SNAKE_COLUMNS, WEEK_STATUS_VALUES)
from wattline.sources.requests import REQUEST_NUMERIC, requests

REQ_DOMAINS = {"Day_of_week": DAY_OF_WEEK_VALUES, "WeekStatus": WEEK_STATUS_VALUES, "Load_Type": LOAD_TYPE_VALUES}
CLEAN_DOMAINS = {"week_status": WEEK_STATUS_VALUES, "day_of_week": DAY_OF_WEEK_VALUES,
                 "load_type": LOAD_TYPE_VALUES}

REQUESTS_CTE = """requests AS (
  SELECT reading_id AS request_id,
    CASE WHEN reading_id % 73 = 0 THEN NULL ELSE lagging_current_reactive_power_kvarh END AS "Lagging_Current_Reactive_Power_kVarh",
    leading_current_reactive_power_kvarh AS "Leading_Current_Reactive_Power_kVarh",
    co2_tco2 AS "CO2(tCO2)", lagging_current_power_factor AS "Lagging_Current_Power_Factor",
    leading_current_power_factor AS "Leading_Current_Power_Factor",
    CASE WHEN reading_id % 53 = 0 THEN CAST(nsm + 86400 AS VARCHAR) WHEN reading_id % 59 = 0 THEN '-100'
         WHEN reading_id % 79 = 0 THEN 'noon' ELSE CAST(nsm AS VARCHAR) END AS "NSM",
    CASE WHEN reading_id % 61 = 0 THEN 'Funday' ELSE day_of_week END AS "Day_of_week",
    CASE WHEN reading_id % 67 = 0 THEN 'Holiday' ELSE week_status END AS "WeekStatus",
    CASE WHEN reading_id % 71 = 0 THEN 'Extreme_Load' ELSE load_type END AS "Load_Type"
  FROM readings)"""


def error_cases_sql() -> str:
    cases = []
    for c in REQUEST_NUMERIC:
        v = S.qi(c)
        cases.append(f"CASE WHEN {v} IS NULL THEN '{c}: field required' END")
        cases.append(f"CASE WHEN isnan({v}) THEN '{c}: not a number' END")
    n = '"NSM"'
    as_int = f"(CASE WHEN regexp_matches({n}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim({n}) AS BIGINT) END)"
    cases += [f"CASE WHEN {n} IS NULL THEN 'NSM: field required' END",
              f"CASE WHEN {n} IS NOT NULL AND {as_int} IS NULL THEN 'NSM: not an integer' END",
              f"CASE WHEN {as_int} < 0 THEN 'NSM: must be >= 0' END",
              f"CASE WHEN {as_int} > 86399 THEN 'NSM: must be <= 86399' END"]
    for c, allowed in REQ_DOMAINS.items():
        v = S.qi(c)
        cases.append(f"CASE WHEN {v} IS NULL THEN '{c}: field required' END")
        cases.append(f"CASE WHEN {v} IS NOT NULL AND {v} NOT IN {S.in_list(allowed)} THEN '{c}: not a valid value' END")
    return "concat_ws('; ', " + ", ".join(cases) + ")"


@register("f9_row_validation", S.with_([S.READINGS, REQUESTS_CTE],
    f"SELECT request_id, {error_cases_sql()} = '' AS is_valid, {error_cases_sql()} AS errors FROM requests"))
def f9_row_validation(spark, sf_dir):
    checked = va.request_errors(va.require_non_empty(requests(spark, sf_dir)), REQUEST_NUMERIC, "NSM", REQ_DOMAINS)
    return checked.select("request_id", "is_valid", F.array_join("errors", "; ").alias("errors"))


REQUIRED = ["reading_id"] + SNAKE_COLUMNS
NON_NEG = ["lagging_current_power_factor", "leading_current_power_factor", "co2_tco2"]


def _f10_sql():
    rows = ["SELECT 'columns_present' AS check_name, CAST(0 AS BIGINT) AS violations"]
    rows += [f"SELECT 'castable:{c}', count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) "
             "IS NULL) FROM readings_clean" for c in NUMERIC_COLUMNS]
    rows += [f"SELECT 'not_null:{c}', count(*) FILTER (WHERE {c} IS NULL) FROM readings_clean" for c in REQUIRED]
    rows += ["SELECT 'range:nsm', count(*) FILTER (WHERE NOT (nsm BETWEEN 0 AND 86400)) FROM readings_clean"]
    rows += [f"SELECT 'non_negative:{c}', count(*) FILTER (WHERE {c} < 0) FROM readings_clean" for c in NON_NEG]
    rows += [f"SELECT 'domain:{c}', count(*) FILTER (WHERE NOT ({c} IN {S.in_list(v)})) FROM readings_clean"
             for c, v in CLEAN_DOMAINS.items()]
    return S.with_(CLEAN + ["ex AS (" + " UNION ALL ".join(rows) + ")"],
                   "SELECT check_name, violations, violations = 0 AS passed FROM ex")


@register("f10_expectation_suite", _f10_sql())
def f10_expectation_suite(spark, sf_dir):
    return va.expectation_suite(clean(spark, sf_dir), REQUIRED, NUMERIC_COLUMNS, "nsm", NON_NEG, CLEAN_DOMAINS)


F11_COLS = NUMERIC_COLUMNS


def _f11_sql():
    parts = []
    for c in F11_COLS:
        parts.append(
            f"SELECT '{c}' AS column_name, {S.r(f'avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c} BETWEEN lo AND hi THEN 0.0 ELSE 1.0 END END)', 9)} "
            f"AS outlier_rate, avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN {c} BETWEEN lo AND hi THEN 0.0 ELSE 1.0 END END) < 0.05 AS passed "
            f"FROM readings_clean, (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
            f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM readings_clean) b")
    return S.with_(CLEAN, " UNION ALL ".join(parts))


@register("f11_outlier_rate", _f11_sql())
def f11_outlier_rate(spark, sf_dir):
    from wattline.operators.quantiles import column_quantiles
    df = clean(spark, sf_dir)
    qs = column_quantiles(df, F11_COLS, [0.25, 0.75])
    bounds = {c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, q3) in qs.items()}
    return va.outlier_rate(df, F11_COLS, bounds)


@register("f12_prediction_sanity", S.with_(RESULT_CTES, "SELECT count(*) AS n_predictions, count(*) FILTER (WHERE isnan(yhat)) AS n_nan, "
                                           "count(*) FILTER (WHERE isinf(yhat)) AS n_inf, count(*) FILTER (WHERE yhat IS NULL) AS n_null, "
                                           f"(SELECT count(*) * {len(bl.FAMILY)} FROM te)::BIGINT AS n_inputs, "
                                           f"count(*) = (SELECT count(*) * {len(bl.FAMILY)} FROM te) AND count(*) = count(*) FILTER (WHERE isfinite(yhat)) AS passed FROM lp"))
def f12_prediction_sanity(spark, sf_dir):
    from wattline.operators.metrics import prediction_sanity
    split = bl.lineitem_split(spark, sf_dir)
    inputs = split.where(F.col("split") == "test").count() * len(bl.FAMILY)  # one prediction per row and configuration
    return prediction_sanity(bl.long_predictions(bl.family_predictions(split)), inputs, "yhat")
