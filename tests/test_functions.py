"""Scalar cleaning rules, parsing, rendering and reproducible draws."""


import pytest
from pyspark.sql import functions as F

from wattline.functions import (canonicalize, na_literals_to_null, numeric_lenient, numeric_strict,
                                params_to_string, parse_day_first, strict_integer, swapcase, uniform)
from wattline.functions.draws import beta_sym, normal
from wattline.schema import DAY_OF_WEEK_MAP, LOAD_TYPE_MAP, WEEK_STATUS_MAP


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_numeric_strict_tokens_and_padding(spark):
    df = one_col(spark, ["invalid", "?", " NAN ", " null ", " 12.5 ", "3", None])
    got = [r[0] for r in df.select(numeric_strict("v")).collect()]
    assert got == [None, None, None, None, 12.5, 3.0, None]


def test_numeric_strict_fails_on_unknown_token(spark):
    df = one_col(spark, ["NAN"])  # bare NAN is not in the token list
    with pytest.raises(Exception):
        df.select(numeric_strict("v")).collect()


def test_numeric_lenient_rejects_suffixes(spark):
    df = one_col(spark, ["12f", "12d", "NaN", "1e3", "abc", "error"])
    got = [r[0] for r in df.select(numeric_lenient("v")).collect()]
    assert got == [None, None, None, 1000.0, None, None]


def test_na_literals_exact_match(spark):
    df = one_col(spark, ["", "NA", "null", " null ", "n/a", " n/a "])
    got = [r[0] for r in df.select(na_literals_to_null("v")).collect()]
    assert got == [None, None, None, " null ", None, " n/a "]


def test_canonicalize_maps_inverted_case(spark):
    df = one_col(spark, ["  wEEKDAY ", "NAN", "Weekend", "odd"])
    got = [r[0] for r in df.select(canonicalize("v", WEEK_STATUS_MAP)).collect()]
    assert got == ["Weekday", None, "Weekend", "odd"]
    df2 = one_col(spark, ["mAXIMUM_lOAD", "sUNDAY"])
    assert df2.select(canonicalize("v", LOAD_TYPE_MAP)).first()[0] == "Maximum_Load"
    assert [r[0] for r in df2.select(canonicalize("v", DAY_OF_WEEK_MAP)).collect()][1] == "Sunday"


def test_swapcase(spark):
    assert one_col(spark, ["Light_Load"]).select(swapcase("v")).first()[0] == "lIGHT_lOAD"


def test_parse_day_first(spark):
    df = one_col(spark, [" 09/01/2024 01:09  ", "1/2/2018 0:15", None])
    got = [r[0] for r in df.select(parse_day_first("v")).collect()]
    assert str(got[0]) == "2024-01-09 01:09:00"
    assert str(got[1]) == "2018-02-01 00:15:00"
    assert got[2] is None
    with pytest.raises(Exception):
        one_col(spark, ["2024-01-09"]).select(parse_day_first("v")).collect()


def test_strict_integer(spark):
    df = one_col(spark, [1.0, 86399.0, None], "double")
    assert [r[0] for r in df.select(strict_integer("v")).collect()] == [1, 86399, None]
    with pytest.raises(Exception):
        one_col(spark, [1.5], "double").select(strict_integer("v")).collect()


def test_params_to_string(spark):
    df = spark.createDataFrame([(["k", "p"], ["5", "2"]), ([], [])], "k array<string>, v array<string>")
    got = [r[0] for r in df.select(params_to_string(F.map_from_arrays("k", "v"))).collect()]
    assert got == ["k=5, p=2", "default"]


def test_draws_do_not_depend_on_partitioning(spark):
    a = spark.range(2000).repartition(1).select("id", uniform(42, "s", F.col("id")).alias("u"))
    b = spark.range(2000).repartition(7).select("id", uniform(42, "s", F.col("id")).alias("u"))
    ja = dict((r["id"], r["u"]) for r in a.collect())
    jb = dict((r["id"], r["u"]) for r in b.collect())
    assert ja == jb
    us = list(ja.values())
    assert all(0.0 < u < 1.0 for u in us)
    assert abs(sum(us) / len(us) - 0.5) < 0.03


def test_normal_and_beta_moments(spark):
    alphas = [0.2, 1.0, 2.0, 5.0]
    df = spark.range(20000).select(normal(1, "n", F.col("id")).alias("z"), *[beta_sym(1, "b", F.col("id"), a).alias(f"b{i}") for i, a in enumerate(alphas)])
    r = df.agg(F.avg("z"), F.stddev("z"), *[f(f"b{i}") for i in range(4) for f in (F.avg, F.var_pop, F.min, F.max)]).first()
    assert abs(r[0]) < 0.05 and abs(r[1] - 1) < 0.05
    for i, a in enumerate(alphas):
        mean, var, lo, hi = r[2 + 4 * i:6 + 4 * i]
        assert abs(mean - 0.5) < 0.02 and 0 <= lo < hi <= 1
        assert abs(var / (1 / (4 * (2 * a + 1))) - 1) < 0.05   # Beta(a, a) variance


def test_numbers_and_dates_are_parsed_once(spark):
    assert str(numeric_strict("v")).count("rlike(") == 1
    assert str(parse_day_first("v")).count("try_to_timestamp(") == 1


def test_canonicalize_with_and_without_null_targets(spark):
    df = one_col(spark, [" a ", "b", "NAN", None, "c\t"])
    assert [r[0] for r in df.select(canonicalize("v", {"a": "A", "NAN": None})).collect()] == ["A", "b", None, None, "c"]
    assert [r[0] for r in df.select(canonicalize("v", {"b": "B"})).collect()] == ["a", "B", "NAN", None, "c"]
    assert [r[0] for r in df.select(canonicalize("v", {})).collect()] == ["a", "b", "NAN", None, "c"]
