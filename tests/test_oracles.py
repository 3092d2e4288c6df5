"""Spark query vs DuckDB oracle on the smallest scale factor.

A representative subset runs by default; WATTLINE_ALL_ORACLES=1 runs all.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from wattline.sources.tables import TABLES, table_path

SUBSET = ["c16_clean_usage_by_hour_load", "c16_clean_readings", "a2_na_literals", "f3_chained_iqr",
          "f4_chained_iqr_report", "g6_describe_extended", "g8_categorical_summary", "g17_histogram",
          "g21_box_by_group", "g24_kde", "u5_wasserstein", "u6_jensen_shannon", "x3_ks_statistic",
          "w1_rankings", "k2_classification_metrics", "l2_time_split", "l3_random_split", "e5_assembled_features",
          "f9_row_validation", "s7_noise_augment", "a5_csv_sink", "p1_batch_scoring", "t1_stream_validate_score", "s8_mixup", "m2_knn_regression", "x1_time_series_cv"]
ORACLES = E.oracle_sql()
NAMES = sorted(ORACLES) if os.environ.get("WATTLINE_ALL_ORACLES") else SUBSET


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "load_type", "avg_usage_kwh", "n_readings"]


def test_every_query_has_a_callable():
    qs = E.queries()
    assert len(qs) > 100 and all(callable(f) for f in qs.values())
    assert set(ORACLES) <= set(qs)
