"""Queries for global order, splits and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import ordering as od
from wattline.operators.baselines import LINEITEM_KEYS, LINEITEM_ORDER, lineitem_split
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, clean
from wattline.plans.q_ranking import SPLIT_CTES
from wattline.plans.registry import register
from wattline.sources.tables import load

ORDER_SQL = ", ".join(LINEITEM_ORDER)
KEYS = ", ".join(LINEITEM_KEYS)


@register("w4_row_number", f"SELECT {KEYS}, row_number() OVER (ORDER BY {ORDER_SQL}) AS rn FROM lineitem")
def w4_row_number(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    return od.row_number(li, LINEITEM_ORDER, "rn").select(*LINEITEM_KEYS, "rn")


@register("l1_sort_by_date", S.with_(CLEAN, "SELECT reading_id, date, row_number() OVER (ORDER BY date, reading_id) "
                                            "AS position FROM readings_clean"))
def l1_sort_by_date(spark, sf_dir):
    df = clean(spark, sf_dir).select("reading_id", "date")
    return od.row_number(df, ["date", "reading_id"], "position")


@register("l2_time_split", S.with_(SPLIT_CTES, f"SELECT {KEYS}, split FROM sp"))
def l2_time_split(spark, sf_dir):
    return lineitem_split(spark, sf_dir).select(*LINEITEM_KEYS, "split")


L3_SQL = S.with_([
    f"h AS (SELECT {KEYS}, {S.hash60(42, 'split', 'l_orderkey * 100 + l_linenumber')} AS hv, "
    "l_orderkey * 100 + l_linenumber AS k FROM lineitem)",
    "o AS (SELECT *, row_number() OVER (ORDER BY hv, k, l_partkey) AS rn, count(*) OVER () AS n FROM h)"],
    f"SELECT {KEYS}, CASE WHEN rn <= CAST(ceil(CAST(0.2 AS DOUBLE) * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM o")


@register("l3_random_split", L3_SQL)
def l3_random_split(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select(*LINEITEM_KEYS, (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("_k"))
    return od.random_split(li, "_k", 42, 0.2, tie_break=["l_partkey"]).select(*LINEITEM_KEYS, "split")


@register("l8_head_tail", S.with_(CLEAN, "SELECT * FROM (SELECT 'head' AS part, reading_id, date FROM readings_clean "
                                         "ORDER BY date, reading_id LIMIT 5) UNION ALL SELECT * FROM (SELECT 'tail', "
                                         "reading_id, date FROM readings_clean ORDER BY date DESC, reading_id DESC LIMIT 5)"))
def l8_head_tail(spark, sf_dir):
    df = clean(spark, sf_dir).select("reading_id", "date")
    h = od.head(df, ["date", "reading_id"], 5).select(F.lit("head").alias("part"), "reading_id", "date")
    t = od.tail(df, ["date", "reading_id"], 5).select(F.lit("tail").alias("part"), "reading_id", "date")
    return h.unionByName(t)


@register("l9_sort_desc", S.with_(CLEAN, "SELECT reading_id, usage_kwh, row_number() OVER (ORDER BY usage_kwh DESC, "
                                         "reading_id) AS rank FROM readings_clean"))
def l9_sort_desc(spark, sf_dir):
    df = clean(spark, sf_dir).select("reading_id", "usage_kwh")
    return od.row_number(df, [F.col("usage_kwh").desc(), F.col("reading_id")], "rank")
