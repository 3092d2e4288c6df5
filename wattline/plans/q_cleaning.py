"""Queries for cleaning, projections and filters (sections 2.2-2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.functions.numeric import r
from wattline.operators import cleaning as cl
from wattline.plans import sqlgen as S
from wattline.plans.registry import register
from wattline.sources.readings import readings_dirty


def clean(spark, sf_dir):
    return cl.clean_readings(readings_dirty(spark, sf_dir))


# -- flagship: clean readings, then mean usage by hour and load type ----------------

FLAGSHIP_SQL = S.with_(S.clean_ctes(), f"""
SELECT CAST(hour(date) AS BIGINT) AS hour, load_type,
       {S.r('avg(usage_kwh)', 9)} AS avg_usage_kwh,
       count(*) AS n_readings
FROM readings_clean GROUP BY 1, 2""")


@register("c16_clean_usage_by_hour_load", FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    df = clean(spark, sf_dir)
    return (df.groupBy(F.hour("date").cast("bigint").alias("hour"), "load_type")
              .agg(r(F.avg("usage_kwh"), 9).alias("avg_usage_kwh"),
                   F.count(F.lit(1)).alias("n_readings")))


# -- shared pieces -------------------------------------------------------------------

from wattline.functions.dates import calendar_parts, format_day_first  # noqa: E402
from wattline.functions.numeric import clip  # noqa: E402
from wattline.operators.ordering import row_number  # noqa: E402
from wattline.schema import (CATEGORICAL_COLUMNS, JUNK_COLUMN, NUMERIC_COLUMNS,  # noqa: E402
                             OUTLIER_K_NOTEBOOK, OUTLIER_STEPS, RAW_COLUMNS, SNAKE_COLUMNS, q)
from wattline.sources import files  # noqa: E402
from wattline.sources.readings import (dirty_columns, readings,  # noqa: E402
                                       readings_dirty_csv)
from wattline.session import scratch_path  # noqa: E402

RD = [S.READINGS]
DIRTY = [S.READINGS, S.dirty()]
DNA = DIRTY + [S.dirty_na()]
SNAKE = DNA + [S.snake()]
TYPED = SNAKE + [S.typed()]
CLEAN = S.clean_ctes()
NUM = NUMERIC_COLUMNS
SNAKE_DIRTY = ["reading_id"] + SNAKE_COLUMNS + [JUNK_COLUMN]


def typed(spark, sf_dir):
    """A2 -> snake names -> C3 -> B1 -> C1 strict (before any row filter)."""
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    df = cl.drop_if_exists(cl.parse_dates(df), [JUNK_COLUMN])
    return cl.clean_numeric(df, NUM, strict=True)


def _dirty_cols_sql(cols):
    return ", ".join(S.qi(c) for c in cols)


# -- 2.1 sources and sinks ---------------------------------------------------------------

@register("a1_csv_scan", S.with_(DNA, f"SELECT {_dirty_cols_sql(['reading_id'] + RAW_COLUMNS)} "
                                       "FROM dirty_na"))
def a1_csv_scan(spark, sf_dir):
    path = readings_dirty_csv(spark, sf_dir)
    df = files.read_csv_strings(spark, path, dirty_columns())
    df = cl.na_literals(df).withColumn("reading_id", F.col("reading_id").cast("bigint"))
    return df.select(*[q(c) for c in ["reading_id"] + RAW_COLUMNS])


A2_SQL = S.with_(DNA, "SELECT column_name, CAST(n_null AS BIGINT) AS n_null FROM (UNPIVOT (SELECT "
                 + ", ".join(f"count(*) - count({S.qi(c)}) AS {S.qi(c)}" for c in RAW_COLUMNS)
                 + " FROM dirty_na) ON COLUMNS(*) INTO NAME column_name VALUE n_null)")


@register("a2_na_literals", A2_SQL)
def a2_na_literals(spark, sf_dir):
    df = cl.na_literals(readings_dirty(spark, sf_dir))
    wide = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(q(c)))).alias(c) for c in RAW_COLUMNS])
    return wide.unpivot([], [q(c) for c in RAW_COLUMNS], "column_name", "n_null")


CLEAN_COLS = ", ".join(["reading_id"] + SNAKE_COLUMNS)
CLEAN_SCHEMA = ("reading_id bigint, date timestamp_ntz, usage_kwh double, "
                "lagging_current_reactive_power_kvarh double, "
                "leading_current_reactive_power_kvarh double, co2_tco2 double, "
                "lagging_current_power_factor double, leading_current_power_factor double, "
                "nsm bigint, week_status string, day_of_week string, load_type string")


@register("a3_typed_csv_scan", S.with_(CLEAN, f"SELECT {CLEAN_COLS} FROM readings_clean"))
def a3_typed_csv_scan(spark, sf_dir):
    path = files.write_csv(clean(spark, sf_dir), scratch_path(spark, "clean_csv"))
    return files.read_csv_typed(spark, path, CLEAN_SCHEMA)


@register("a4_processed_scan", S.with_(RD, f"SELECT {CLEAN_COLS} FROM readings"))
def a4_processed_scan(spark, sf_dir):
    path = files.write_parquet(readings(spark, sf_dir), scratch_path(spark, "processed"))
    return spark.read.parquet(path)


@register("a5_csv_sink", S.with_(CLEAN, "SELECT * FROM readings_clean"))
def a5_csv_sink(spark, sf_dir):
    """The cleaned table as read back from the CSV file."""
    df = clean(spark, sf_dir)
    path = files.write_csv(df, scratch_path(spark, "clean_sink"))
    return files.read_csv_typed(spark, path, df.schema)


@register("a6_csv_date_render", S.with_(CLEAN, "SELECT reading_id, strftime(date, '%d/%m/%Y %H:%M') "
                                               "AS date, usage_kwh FROM readings_clean"))
def a6_csv_date_render(spark, sf_dir):
    df = files.with_rendered_dates(clean(spark, sf_dir).select("reading_id", "date", "usage_kwh"),
                                   ["date", "not_a_column", "usage_kwh"])
    path = files.write_csv(df, scratch_path(spark, "dates_csv"))
    return files.read_csv_typed(spark, path, "reading_id bigint, date string, usage_kwh double")


A10_SQL = S.with_(CLEAN, "SELECT date, reading_id, usage_kwh, CAST(year(date) AS BIGINT) AS year, "
                         "CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day, "
                         "CAST(hour(date) AS BIGINT) AS hour, CAST(minute(date) AS BIGINT) AS minute "
                         "FROM readings_clean")


@register("a10_indexed_sink", A10_SQL)
def a10_indexed_sink(spark, sf_dir):
    df = clean(spark, sf_dir)
    df = df.select("date", "reading_id", "usage_kwh",
                   *[v.alias(k) for k, v in calendar_parts("date").items()])
    path = files.write_parquet(df, scratch_path(spark, "indexed"))
    return spark.read.parquet(path)


# -- 2.2 projections, renames, casts -------------------------------------------------------

B1_COLS = ["reading_id"] + RAW_COLUMNS


@register("b1_drop_if_exists", S.with_(DIRTY, f"SELECT {_dirty_cols_sql(B1_COLS)} FROM readings_dirty"))
def b1_drop_if_exists(spark, sf_dir):
    return cl.drop_if_exists(readings_dirty(spark, sf_dir), [JUNK_COLUMN, "not_a_column"])


B2_SQL = S.with_(DIRTY, "SELECT " + ", ".join(
    f"{S.qi(a)} AS {b}" for a, b in zip(["reading_id"] + RAW_COLUMNS + [JUNK_COLUMN], SNAKE_DIRTY))
    + " FROM readings_dirty")


@register("b2_positional_rename", B2_SQL)
def b2_positional_rename(spark, sf_dir):
    return cl.rename_positional(readings_dirty(spark, sf_dir), SNAKE_DIRTY)


TEST_RENAME = {"Lagging_Current_Reactive.Power_kVarh": "Lagging_Current_Reactive_Power_kVarh"}
B3_SQL = S.with_(DIRTY, "SELECT " + ", ".join(
    f"{S.qi(c)} AS {S.qi(TEST_RENAME.get(c, c))}" for c in ["reading_id"] + RAW_COLUMNS)
    + " FROM readings_dirty")


@register("b3_rename_map", B3_SQL)
def b3_rename_map(spark, sf_dir):
    df = readings_dirty(spark, sf_dir).drop(JUNK_COLUMN)
    return cl.rename_map(df, {**TEST_RENAME, "no_such_column": "x"})


FEATURES = [c for c in ["reading_id"] + SNAKE_COLUMNS if c != "usage_kwh"]


@register("b4_features_target", S.with_(CLEAN, f"SELECT {', '.join(FEATURES)} FROM readings_clean"))
def b4_features_target(spark, sf_dir):
    X, _y = cl.features_target(clean(spark, sf_dir), "usage_kwh")
    return X


NUMERIC_KINDS = ["reading_id"] + NUM


@register("b5_select_numeric", S.with_(CLEAN, f"SELECT {', '.join(NUMERIC_KINDS)} FROM readings_clean"))
def b5_select_numeric(spark, sf_dir):
    return cl.select_by_kind(clean(spark, sf_dir), "numeric")


CONFIGURED = NUM + ["not_in_table"] + CATEGORICAL_COLUMNS


@register("b6_configured_columns", S.with_(RD, "SELECT " + ", ".join(NUM + CATEGORICAL_COLUMNS)
                                               + " FROM readings"))
def b6_configured_columns(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.select(*cl.existing_columns(df, CONFIGURED))


B7_SQL = S.with_(CLEAN, "SELECT reading_id, usage_kwh, 'Original' AS dataset FROM readings "
                        "UNION ALL SELECT reading_id, usage_kwh, 'Modified' AS dataset FROM readings_clean")


@register("b7_tag_column", B7_SQL)
def b7_tag_column(spark, sf_dir):
    a = readings(spark, sf_dir).select("reading_id", "usage_kwh").withColumn("dataset", F.lit("Original"))
    b = clean(spark, sf_dir).select("reading_id", "usage_kwh").withColumn("dataset", F.lit("Modified"))
    return a.unionByName(b)


@register("b8_total_power_factor", S.with_(CLEAN, "SELECT reading_id, lagging_current_power_factor + "
                                                  "leading_current_power_factor AS total_power_factor "
                                                  "FROM readings_clean"))
def b8_total_power_factor(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.select("reading_id", (F.col("lagging_current_power_factor")
                                    + F.col("leading_current_power_factor")).alias("total_power_factor"))


@register("b10_whole_to_int", S.with_(SNAKE, "SELECT reading_id, CAST(" + S.numeric_strict("nsm")
                                             + " AS BIGINT) AS nsm FROM dirty_snake"))
def b10_whole_to_int(spark, sf_dir):
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    return cl.clean_numeric(df, ["nsm"], strict=True).select("reading_id", "nsm")


# -- 2.3 cleaning and scalar functions ------------------------------------------------------

@register("c1_numeric_strict", S.with_(SNAKE, "SELECT reading_id, " + ", ".join(
    f"{S.numeric_strict(c)} AS {c}" for c in NUM[:-1]) + " FROM dirty_snake"))
def c1_numeric_strict(spark, sf_dir):
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    return cl.clean_numeric(df, NUM[:-1], strict=True).select("reading_id", *NUM[:-1])


@register("c2_numeric_lenient", S.with_(SNAKE, "SELECT reading_id, " + ", ".join(
    f"{S.numeric_lenient(c)} AS {c}" for c in NUM) + " FROM dirty_snake"))
def c2_numeric_lenient(spark, sf_dir):
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    return cl.clean_numeric(df, NUM, strict=False, integer_cols=()).select("reading_id", *NUM)


@register("c3_parse_dates", S.with_(SNAKE, f"SELECT reading_id, {S.parse_date('date')} AS date "
                                           "FROM dirty_snake"))
def c3_parse_dates(spark, sf_dir):
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    return cl.parse_dates(df).select("reading_id", "date")


@register("c4_trim_whitespace", S.with_(SNAKE, "SELECT reading_id, " + ", ".join(
    f"{S.trim_ws(c)} AS {c}" for c in CATEGORICAL_COLUMNS) + " FROM dirty_snake"))
def c4_trim_whitespace(spark, sf_dir):
    from wattline.functions.text import btrim_ws
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    return df.select("reading_id", *[btrim_ws(c).alias(c) for c in CATEGORICAL_COLUMNS])


def _canon_query(col):
    sql = S.with_(SNAKE, f"SELECT reading_id, {S.canon(col, S.CATEGORY_MAPS[col])} AS {col} "
                         "FROM dirty_snake")

    def run(spark, sf_dir):
        df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
        return cl.canonicalize_categoricals(df, [col]).select("reading_id", col)
    return sql, run


for _key, _col in [("c5_week_status", "week_status"), ("c6_day_of_week", "day_of_week"),
                   ("c7_load_type", "load_type")]:
    _sql, _run = _canon_query(_col)
    register(_key, _sql)(_run)


@register("c8_replace_value", S.with_(CLEAN, "SELECT reading_id, CASE WHEN load_type = 'Maximum_Load' "
                                             "THEN 'High_Load' ELSE load_type END AS load_type "
                                             "FROM readings_clean"))
def c8_replace_value(spark, sf_dir):
    df = clean(spark, sf_dir).select("reading_id", "load_type")
    return cl.replace_values(df, "load_type", {"Maximum_Load": "High_Load"})


@register("c9_calendar_parts", S.with_(CLEAN, "SELECT reading_id, CAST(year(date) AS BIGINT) AS year, "
                                              "CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day, "
                                              "CAST(hour(date) AS BIGINT) AS hour, CAST(minute(date) AS BIGINT) AS minute "
                                              "FROM readings_clean"))
def c9_calendar_parts(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.select("reading_id", *[v.alias(k) for k, v in calendar_parts("date").items()])


@register("c10_format_timestamp", S.with_(CLEAN, "SELECT reading_id, strftime(date, '%d/%m/%Y %H:%M') AS "
                                                 "date_text, strftime(date, '%Y-%m-%d') AS day_text "
                                                 "FROM readings_clean"))
def c10_format_timestamp(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.select("reading_id", format_day_first("date").alias("date_text"),
                     F.date_format("date", "yyyy-MM-dd").alias("day_text"))


@register("c11_fill_zero", S.with_(SNAKE, "SELECT reading_id, " + ", ".join(
    f"coalesce({S.numeric_lenient(c)}, 0.0) AS {c}" for c in NUM) + " FROM dirty_snake"))
def c11_fill_zero(spark, sf_dir):
    df = cl.raw_to_snake(cl.na_literals(readings_dirty(spark, sf_dir)))
    df = cl.clean_numeric(df, NUM, strict=False, integer_cols=()).select("reading_id", *NUM)
    return df.na.fill(0.0, subset=NUM)


@register("c12_round_half_even", S.with_(CLEAN, "SELECT reading_id, round_even(lagging_current_power_factor "
                                                "/ 16.0, 3) AS pf_16th, round_even(usage_kwh, 0) AS usage_units "
                                                "FROM readings_clean"))
def c12_round_half_even(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.select("reading_id",
                     F.bround(F.col("lagging_current_power_factor") / F.lit(16.0), 3).alias("pf_16th"),
                     F.bround("usage_kwh", 0).alias("usage_units"))


C13_SQL = S.with_(CLEAN, "SELECT r.reading_id, CASE WHEN r.usage_kwh IS NULL THEN NULL ELSE "
                         "greatest(b.lo, least(r.usage_kwh, b.hi)) END AS usage_clipped FROM readings r, "
                         "(SELECT min(usage_kwh) AS lo, max(usage_kwh) * 1.2 AS hi FROM readings_clean) b")


@register("c13_clip", C13_SQL)
def c13_clip(spark, sf_dir):
    base = clean(spark, sf_dir).agg(F.min("usage_kwh").alias("lo"), F.max("usage_kwh").alias("hi")).first()
    df = readings(spark, sf_dir)
    return df.select("reading_id", clip("usage_kwh", base["lo"], base["hi"] * 1.2).alias("usage_clipped"))


C15_SQL = S.with_(CLEAN + ["""pos AS (SELECT reading_id, usage_kwh,
    row_number() OVER (ORDER BY date, reading_id) - 1 AS i, count(*) OVER () AS n,
    avg(usage_kwh) OVER () AS mu FROM readings_clean)"""],
    f"""SELECT reading_id, i, {S.r("CASE WHEN n = 1 THEN 0.0 ELSE i / (n - 1.0) END", 9)} AS ramp,
       {S.r("sin(2 * pi() * i / 96.0)", 9)} AS daily_wave, {S.r("abs(usage_kwh - mu)")} AS abs_dev,
       {S.r("sqrt(usage_kwh)", 9)} AS root_usage FROM pos""")


@register("c15_math", C15_SQL)
def c15_math(spark, sf_dir):
    import math
    df = clean(spark, sf_dir).select("reading_id", "date", "usage_kwh")
    pos = row_number(df, ["date", "reading_id"], name="i", base=0)
    stats = pos.agg(F.count(F.lit(1)).alias("n"), F.avg("usage_kwh").alias("mu"))
    out = pos.crossJoin(F.broadcast(stats))  # one-row table
    n = F.col("n")
    return out.select(
        "reading_id", "i",
        r(F.when(n == 1, F.lit(0.0)).otherwise(F.col("i") / (n - F.lit(1.0))), 9).alias("ramp"),
        r(F.sin(F.lit(2 * math.pi) * F.col("i") / F.lit(96.0)), 9).alias("daily_wave"),
        r(F.abs(F.col("usage_kwh") - F.col("mu")), 6).alias("abs_dev"),
        r(F.sqrt("usage_kwh"), 9).alias("root_usage"))


@register("c16_clean_readings", S.with_(CLEAN, f"SELECT {CLEAN_COLS} FROM readings_clean"))
def c16_clean_readings(spark, sf_dir):
    return clean(spark, sf_dir)


# -- 2.4 filters ------------------------------------------------------------------------------

def _iqr_sql(src_ctes, src, col, k, body):
    kk = f"CAST({float(k)!r} AS DOUBLE)"
    return S.with_(src_ctes + [f"bq AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) "
                               f"AS q3 FROM {src})",
                               f"bb AS (SELECT q1 - {kk} * (q3 - q1) AS lo, q3 + {kk} * (q3 - q1) AS hi FROM bq)"],
                   body)


@register("f1_iqr_filter", _iqr_sql(RD, "readings", "usage_kwh", 1.5,
                                    "SELECT t.reading_id, t.usage_kwh FROM readings t, bb WHERE "
                                    "t.usage_kwh IS NULL OR t.usage_kwh BETWEEN bb.lo AND bb.hi"))
def f1_iqr_filter(spark, sf_dir):
    df, _ = cl.iqr_filter(readings(spark, sf_dir).select("reading_id", "usage_kwh"), "usage_kwh", 1.5)
    return df


@register("f2_iqr_mask", _iqr_sql(RD, "readings", "usage_kwh", 1.5,
                                  "SELECT t.reading_id, coalesce(t.usage_kwh IS NULL OR t.usage_kwh BETWEEN "
                                  "bb.lo AND bb.hi, false) AS is_inlier FROM readings t, bb"))
def f2_iqr_mask(spark, sf_dir):
    df, _ = cl.iqr_mask(readings(spark, sf_dir).select("reading_id", "usage_kwh"), "usage_kwh", 1.5)
    return df.select("reading_id", "is_inlier")


_F3_CHAIN, _F3_LAST = S.iqr_chain("readings", OUTLIER_STEPS)


@register("f3_chained_iqr", S.with_(RD + _F3_CHAIN, f"SELECT reading_id, {', '.join(NUM[:-1])} FROM {_F3_LAST}"))
def f3_chained_iqr(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", *NUM[:-1])
    out, _ = cl.chained_iqr(df, OUTLIER_STEPS)
    return out


NOTEBOOK_STEPS = [(c, k) for (c, _), k in zip(OUTLIER_STEPS, OUTLIER_K_NOTEBOOK)]
_F4_CHAIN, _ = S.iqr_chain("readings", NOTEBOOK_STEPS)
F4_SQL = S.with_(RD + _F4_CHAIN, " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS step, '{c}' AS col, CAST({float(k)!r} AS DOUBLE) AS k, "
    f"{S.r(f'q1 - {float(k)!r} * (q3 - q1)', 9)} AS lo, {S.r(f'q3 + {float(k)!r} * (q3 - q1)', 9)} AS hi, "
    f"(SELECT count(*) FROM o{i - 1}) AS rows_in, (SELECT count(*) FROM o{i}) AS rows_out FROM ob{i}"
    for i, (c, k) in enumerate(NOTEBOOK_STEPS, start=1)))


@register("f4_chained_iqr_report", F4_SQL)
def f4_chained_iqr_report(spark, sf_dir):
    df = readings(spark, sf_dir).select("reading_id", *NUM[:-1])
    rep = cl.chained_iqr_report(df, NOTEBOOK_STEPS)
    return rep.select("step", "col", "k", r("lo", 9).alias("lo"), r("hi", 9).alias("hi"), "rows_in", "rows_out")


@register("f5_nsm_range", S.with_(TYPED, "SELECT reading_id, nsm FROM typed WHERE nsm <= 86399"))
def f5_nsm_range(spark, sf_dir):
    return cl.nsm_range(typed(spark, sf_dir)).select("reading_id", "nsm")


TYPED_COLS = ["reading_id"] + SNAKE_COLUMNS


@register("f6_drop_nulls", S.with_(TYPED, "SELECT reading_id FROM typed WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in TYPED_COLS)))
def f6_drop_nulls(spark, sf_dir):
    return cl.drop_nulls(typed(spark, sf_dir)).select("reading_id")


@register("f7_tag_filter", S.with_(CLEAN, "SELECT * FROM (SELECT reading_id, 'Original' AS dataset FROM readings "
                                          "UNION ALL SELECT reading_id, 'Modified' FROM readings_clean) "
                                          "WHERE dataset = 'Modified' OR reading_id % 2 = 0"))
def f7_tag_filter(spark, sf_dir):
    a = readings(spark, sf_dir).select("reading_id").withColumn("dataset", F.lit("Original"))
    b = clean(spark, sf_dir).select("reading_id").withColumn("dataset", F.lit("Modified"))
    both = a.unionByName(b)
    return both.where((F.col("dataset") == "Modified") | (F.col("reading_id") % 2 == 0))


@register("f8_calendar_filter", S.with_(CLEAN, "SELECT reading_id, date FROM readings_clean "
                                               "WHERE month(date) = 1 AND day(date) BETWEEN 1 AND 14"))
def f8_calendar_filter(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.where((F.month("date") == 1) & F.dayofmonth("date").between(1, 14)).select("reading_id", "date")
