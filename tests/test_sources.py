"""Sources and sinks: CSV scan failure rules, whitespace-preserving round trip,
date rendering, and the readings mapping."""

import pytest
from pyspark.sql import functions as F

from wattline.session import scratch_path
from wattline.sources import files
from wattline.sources.readings import readings


def test_csv_scan_missing_path_fails(spark):
    with pytest.raises(Exception):
        files.read_csv_strings(spark, scratch_path(spark, "nothing-here"), ["a"]).count()


def test_csv_scan_empty_file_fails(spark):
    path = scratch_path(spark, "empty")
    files.write_csv(spark.createDataFrame([], "a string"), path)
    with pytest.raises(ValueError):
        files.read_csv_strings(spark, path, ["a"])


def test_csv_round_trip_keeps_padding(spark):
    path = scratch_path(spark, "pad")
    df = spark.createDataFrame([(" NAN ",), ("  x ",), ("y",)], "a string")
    files.write_csv(df, path)
    back = sorted(r[0] for r in files.read_csv_strings(spark, path, ["a"]).collect())
    assert back == ["  x ", " NAN ", "y"]


def test_rendered_dates_skip_missing_and_non_dates(spark):
    df = spark.createDataFrame([("2024-01-09 01:09:00", 1.0)], "d string, x double") \
              .withColumn("d", F.to_timestamp_ntz("d"))
    out = files.with_rendered_dates(df, ["d", "x", "absent"]).first()
    assert out["d"] == "09/01/2024 01:09" and out["x"] == 1.0


def test_readings_mapping(spark, sf_dir):
    r = readings(spark, sf_dir)
    assert r.columns[:3] == ["reading_id", "date", "usage_kwh"]
    row = r.agg(F.min("nsm"), F.max("nsm"), F.countDistinct("week_status"), F.countDistinct("load_type")).first()
    assert 0 <= row[0] and row[1] <= 86399 and row[2] == 2 and row[3] == 3
    bad = r.where(F.abs(F.col("co2_tco2") * 1000 - F.col("usage_kwh")) > 1e-9).count()
    assert bad == 0


def test_swapped_header_ragged_rows_and_bad_cells_fail(spark):
    import pytest
    from wattline.session import scratch_path
    from wattline.sources import files

    def written(lines):
        path = scratch_path(spark, "csv")
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
        return path

    assert files.read_csv_strings(spark, written(["a,b", "1,2"]), ["a", "b"]).collect()[0]["b"] == "2"
    for lines in (["b,a", "1,2"], ["a,b", "1,2,3"]):
        with pytest.raises(Exception):
            files.read_csv_strings(spark, written(lines), ["a", "b"]).collect()
    with pytest.raises(Exception):
        files.read_csv_typed(spark, written(["a,b", "1,x"]), "a int, b int").collect()


def test_six_decimals_is_the_formatter_s_text(spark):
    """Numbers are only filled up with zeros where their plain text is short enough."""
    from wattline.sources.dirty_rules import six_decimals
    values = [None, 0.0, -0.0, 1.0, -2.5, 0.001, 0.00099999, 1e-7, -1e-9, 9999999.123456, 1e7, 1e22, 0.1 + 0.2, 2.0000005, 123.4567895,
              -0.0415, float("nan"), float("inf"), float("-inf"), *[i / 1000 for i in range(-50, 50)], *[i * 0.37 for i in range(100)]]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("p", F.col("v").cast("string"))
    got = df.select(F.expr(six_decimals("v", "p")).alias("a"), F.format_string("%.6f", "v").alias("b")).collect()
    assert len(got) == len(values) and all(r["a"] == r["b"] for r in got)


def test_dirty_rendering_keeps_its_rules(spark):
    """Every kind of number, also for negative and null ids (no token), and null values."""
    from wattline.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS
    from wattline.sources.dirty_rules import numeric_text
    from wattline.sources.readings import dirty_from_readings
    ids = F.when(F.col("id") < 3000, F.col("id") - 1000)
    df = spark.range(3001).select(ids.alias("reading_id"), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("date"),
                                  *[F.when(F.col("id") % 5 > 0, F.col("id") / 8).alias(c) for c in NUMERIC_COLUMNS if c != "nsm"],
                                  (F.col("id") * 7).alias("nsm"), *[F.lit("Monday").alias(c) for c in CATEGORICAL_COLUMNS])
    # the rule as SQL engines that format with printf are given it
    rules = {c: numeric_text(j, c, "duckdb").replace("printf", "format_string") for j, c in enumerate(NUMERIC_COLUMNS)}
    key = lambda r: tuple(str(x) for x in r)
    got = dirty_from_readings(df)
    numbers = [c for c in got.columns if c != "reading_id"][1:8]
    got = sorted(map(tuple, got.select("reading_id", *[F.col(f"`{c}`") for c in numbers]).collect()), key=key)
    want = sorted(map(tuple, df.select("reading_id", *[F.expr(x) for x in rules.values()]).collect()), key=key)
    assert got == want and any(r[1] is None for r in got) and any(r[1] == "n/a" for r in got)
