"""Queries for sampling and augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.operators import augment as ag
from wattline.operators import sampling as sm
from wattline.plans import sqlgen as S
from wattline.plans.q_cleaning import CLEAN, clean
from wattline.plans.registry import register
from wattline.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS

NUM = NUMERIC_COLUMNS
CAT = CATEGORICAL_COLUMNS
SEED = 42

BASE = CLEAN + [
    "base AS (SELECT *, row_number() OVER (ORDER BY reading_id) - 1 AS src, count(*) OVER () AS nsrc FROM readings_clean)",
    "stats AS (SELECT " + ", ".join(f"stddev_pop({c}) AS s_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}"
                                   for c in NUM) + " FROM readings_clean)",
]


def samp_cte(name="samp", stream="sample"):
    return (f"{name} AS (SELECT p.src AS i, p.nsrc, b.* EXCLUDE (src, nsrc) FROM base p JOIN base b "
            f"ON b.src = {S.hash60(SEED, stream, 'p.src')} % p.nsrc)")


@register("s1_sample_with_replacement", S.with_(BASE + [samp_cte()], "SELECT i, reading_id FROM samp"))
def s1_sample_with_replacement(spark, sf_dir):
    rows = sm.indexed(clean(spark, sf_dir).select("reading_id"), ["reading_id"])
    return sm.sample_with_replacement(rows, rows.count(), sm.positions(spark, like=rows), SEED).select("i", "reading_id")


@register("s11_shuffle", S.with_(CLEAN, "SELECT reading_id, row_number() OVER (ORDER BY "
                                        f"{S.hash60(SEED, 'shuffle', 'reading_id')}, reading_id) - 1 AS position "
                                        "FROM readings_clean"))
def s11_shuffle(spark, sf_dir):
    return sm.shuffle(clean(spark, sf_dir).select("reading_id"), "reading_id", SEED)


def _noise_sql():
    ex = {}
    for c in NUM:
        x = f"(CAST({c} AS DOUBLE) + (s_{c} * 0.05) * {S.normal(SEED, f'noise.{c}', 'reading_id')})"
        ex[c] = f"CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest({x}, lo_{c}), hi_{c}) END"
    cols = ", ".join(f"{S.r(ex[c])} AS {c}" for c in NUM)
    return S.with_(BASE, f"SELECT reading_id, {cols} FROM readings_clean, stats")


@register("s7_noise_augment", _noise_sql())
def s7_noise_augment(spark, sf_dir):
    out = ag.noisy(clean(spark, sf_dir), "reading_id", NUM, 0.05, SEED)
    return out.select("reading_id", *[(F.round(F.col(c).cast("double"), 6) + F.lit(0.0)).alias(c) for c in NUM])


def _mixup_sql(alpha=0.2):
    r1 = f"({S.hash60(SEED, 'pair.1', 'p.src')} % p.nsrc)"
    step = f"({S.hash60(SEED, 'pair.2', 'p.src')} % greatest(p.nsrc - 1, 1))"
    lam = S.beta_sym(SEED, "mixup.lam", "i", alpha)
    pairs = f"pairs AS (SELECT p.src AS i, {r1} AS r1, ({r1} + 1 + {step}) % p.nsrc AS r2 FROM base p)"
    j = "j AS (SELECT pairs.i, " + ", ".join(f"a.{c} AS a_{c}, b.{c} AS b_{c}" for c in NUM + CAT) + \
        " FROM pairs JOIN base a ON a.src = pairs.r1 JOIN base b ON b.src = pairs.r2)"
    lj = f"lj AS (SELECT *, {lam} AS lam FROM j)"
    num = ", ".join(f"{S.r(f'lam * a_{c} + (1.0 - lam) * b_{c}')} AS {c}" for c in NUM)
    cat = ", ".join(f"CASE WHEN {S.uniform(SEED, f'mixup.pick.{c}', 'i')} < lam THEN a_{c} ELSE b_{c} END AS {c}" for c in CAT)
    return S.with_(BASE + [pairs, j, lj], f"SELECT i, {num}, {cat} FROM lj")


@register("s8_mixup", _mixup_sql())
def s8_mixup(spark, sf_dir):
    out = ag.mixed_pairs(clean(spark, sf_dir), "reading_id", NUM, CAT, 0.2, SEED)
    return out.select("i", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in NUM], *CAT)
