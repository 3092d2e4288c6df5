"""Queries for set operations and data-set comparison (section 2.9, W3, X3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import compare as cp
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, RD, clean
from wattline.plans.registry import register
from wattline.schema import (CATEGORICAL_COLUMNS, DAY_OF_WEEK_VALUES, LOAD_TYPE_VALUES,
                             NUMERIC_COLUMNS, WEEK_STATUS_VALUES)
from wattline.sources.readings import readings

NUM = NUMERIC_COLUMNS
TAG = RD + [S.TAGGED]
A, B = "click", "view"


def tagged(spark, sf_dir):
    return readings(spark, sf_dir, with_tag=True)


@register("u1_union_by_name", S.with_(CLEAN, "SELECT reading_id, usage_kwh, co2_tco2, 'Original' AS dataset FROM readings "
                                             "UNION ALL SELECT reading_id, usage_kwh, NULL, 'Modified' FROM readings_clean"))
def u1_union_by_name(spark, sf_dir):
    a = readings(spark, sf_dir).select("reading_id", "usage_kwh", "co2_tco2", F.lit("Original").alias("dataset"))
    b = clean(spark, sf_dir).select("reading_id", "usage_kwh", F.lit("Modified").alias("dataset"))
    return cp.union_by_name([a, b])


U2_COLS = ["week_status", "day_of_week", "load_type"]


@register("u2_drop_duplicates", S.with_(CLEAN, "SELECT DISTINCT week_status, day_of_week, load_type, "
                                               "CAST(hour(date) AS BIGINT) AS hour FROM readings_clean"))
def u2_drop_duplicates(spark, sf_dir):
    df = clean(spark, sf_dir).select(*U2_COLS, F.hour("date").cast("bigint").alias("hour"))
    return cp.drop_duplicates(df)


DOMAINS = {"week_status": WEEK_STATUS_VALUES, "day_of_week": DAY_OF_WEEK_VALUES,
           "load_type": LOAD_TYPE_VALUES}


def _u3_sql():
    parts = []
    for c in CATEGORICAL_COLUMNS:
        dom = ", ".join(f"'{v}'" for v in DOMAINS[c])
        parts.append(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ({dom})) "
                     f"AS n_outside, count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ({dom})) = 0 AS passed "
                     "FROM readings_clean_hl")
    hl = ("readings_clean_hl AS (SELECT reading_id, week_status, day_of_week, CASE WHEN load_type = "
          "'Maximum_Load' THEN 'High_Load' ELSE load_type END AS load_type FROM readings_clean)")
    return S.with_(CLEAN + [hl], " UNION ALL ".join(parts))


@register("u3_domain_check", _u3_sql())
def u3_domain_check(spark, sf_dir):
    from wattline.operators.validate import domain_violations
    df = clean(spark, sf_dir).replace({"Maximum_Load": "High_Load"}, subset=["load_type"])
    return domain_violations(df, DOMAINS)


def _cdf_ctes(cols, src="readings_tagged"):
    lv = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, CASE WHEN dataset = '{A}' THEN 1 ELSE 0 END AS i1, "
        f"CASE WHEN dataset = '{B}' THEN 1 ELSE 0 END AS i2 FROM {src} WHERE dataset IN ('{A}', '{B}') "
        f"AND {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in cols)
    return [f"cnt AS (SELECT column_name, value, CAST(sum(i1) AS DOUBLE) AS c1, CAST(sum(i2) AS DOUBLE) AS c2 "
            f"FROM ({lv}) GROUP BY 1, 2)",
            "cdf AS (SELECT column_name, value, sum(c1) OVER w / sum(c1) OVER (PARTITION BY column_name) AS f1, "
            "sum(c2) OVER w / sum(c2) OVER (PARTITION BY column_name) AS f2, "
            "lead(value) OVER (PARTITION BY column_name ORDER BY value) AS next_value, "
            "sum(c1) OVER (PARTITION BY column_name) AS n1, sum(c2) OVER (PARTITION BY column_name) AS n2 FROM cnt "
            "WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"]


@register("w3_two_sample_cdf", S.with_(TAG + _cdf_ctes(NUM),
    f"SELECT column_name, value, {S.r('f1', 9)} AS f1, {S.r('f2', 9)} AS f2, next_value FROM cdf"))
def w3_two_sample_cdf(spark, sf_dir):
    cdf = cp.cdf_table(tagged(spark, sf_dir), NUM, "dataset", A, B)
    return cdf.select("column_name", "value", (F.round("f1", 9) + F.lit(0.0)).alias("f1"),
                      (F.round("f2", 9) + F.lit(0.0)).alias("f2"), "next_value")


@register("u5_wasserstein", S.with_(TAG + _cdf_ctes(NUM),
    "SELECT column_name, " + S.r("coalesce(sum(abs(f1 - f2) * (next_value - value)), 0.0)")
    + " AS wasserstein FROM cdf GROUP BY column_name HAVING max(n1) > 0 AND max(n2) > 0"))
def u5_wasserstein(spark, sf_dir):
    return cp.wasserstein(tagged(spark, sf_dir), NUM, "dataset", A, B)


@register("x3_ks_statistic", S.with_(TAG + _cdf_ctes(NUM),
    "SELECT column_name, " + S.r("max(abs(f1 - f2))") + " AS ks FROM cdf GROUP BY column_name"))
def x3_ks_statistic(spark, sf_dir):
    return cp.ks_statistic(tagged(spark, sf_dir), NUM, "dataset", A, B)


def _js_sql(cols, bins=30):
    lv = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, CASE WHEN dataset = '{A}' THEN 1 ELSE 0 END AS i1, "
        f"CASE WHEN dataset = '{B}' THEN 1 ELSE 0 END AS i2 FROM readings_tagged WHERE dataset IN ('{A}', '{B}') "
        f"AND {c} IS NOT NULL" for c in cols)
    fb = float(bins)
    ctes = [f"lv AS ({lv})",
            "rng0 AS (SELECT column_name, min(value) AS lo0, max(value) AS hi0 FROM lv WHERE i1 = 1 GROUP BY 1)",
            "rng AS (SELECT column_name, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
            "CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM rng0)",
            f"cnt AS (SELECT lv.column_name, least(CAST(floor((value - lo) * {fb!r} / (hi - lo)) AS BIGINT), {bins - 1}) AS bin, "
            "CAST(sum(i1) AS DOUBLE) AS c1, CAST(sum(i2) AS DOUBLE) AS c2 FROM lv JOIN rng ON lv.column_name = rng.column_name "
            "WHERE value BETWEEN lo AND hi GROUP BY 1, 2)",
            f"full_ AS (SELECT g.column_name, g.bin, lo, hi, coalesce(c1, 0.0) AS c1, coalesce(c2, 0.0) AS c2 FROM "
            f"(SELECT column_name, lo, hi, CAST(b AS BIGINT) AS bin FROM rng, range({bins}) t(b)) g LEFT JOIN cnt "
            "ON g.column_name = cnt.column_name AND g.bin = cnt.bin)",
            f"dens AS (SELECT column_name, c1 / (sum(c1) OVER (PARTITION BY column_name) * ((hi - lo) / {fb!r})) + 1e-10 AS p, "
            f"c2 / (sum(c2) OVER (PARTITION BY column_name) * ((hi - lo) / {fb!r})) + 1e-10 AS q FROM full_)",
            "nrm AS (SELECT column_name, p / sum(p) OVER (PARTITION BY column_name) AS p, "
            "q / sum(q) OVER (PARTITION BY column_name) AS q FROM dens)"]
    return S.with_(TAG + ctes, "SELECT column_name, round(sqrt((sum(p * ln(p / ((p + q) / 2))) + "
                               "sum(q * ln(q / ((p + q) / 2)))) / 2), 3) + 0.0 AS js_distance FROM nrm GROUP BY 1")


@register("u6_jensen_shannon", _js_sql(NUM))
def u6_jensen_shannon(spark, sf_dir):
    return cp.jensen_shannon(tagged(spark, sf_dir), NUM, "dataset", A, B)
