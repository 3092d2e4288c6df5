"""The readings table, derived from the driver's ``events`` table.

Mapping (one reading per event): reading_id = event_id, date = ts,
usage_kwh = value, k = props.k, lagging reactive power = k, leading reactive
power = user_id % 40, co2 = value / 1000, lagging power factor = 50 + k / 2,
leading power factor = 100 - user_id % 50, nsm = seconds from midnight,
day_of_week = day name, week_status from Saturday/Sunday, load_type by
event_id % 3. ``readings_dirty`` renders it as the dirty text file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.numeric import nan_to_null
from wattline.schema import LOAD_TYPE_VALUES, NUMERIC_COLUMNS
from wattline.session import scratch_path
from wattline.sources.dirty_rules import corrupt_nsm, dirty_select_list, numeric_kind, six_decimals
from wattline.sources.files import write_csv, write_parquet
from wattline.sources.tables import load, table_version


def readings(spark: SparkSession, sf_dir: str, with_tag: bool = False) -> DataFrame:
    """Clean readings; `with_tag` keeps the event type as a data-set tag."""
    return readings_from_events(load(spark, sf_dir, "events"), with_tag)


def readings_from_events(events: DataFrame, with_tag: bool = False) -> DataFrame:
    """The mapping as a projection (works on batch and streaming frames)."""
    # A NaN is a missing value from here on: aggregates would count it otherwise.
    ev = events.select("event_id", "ts", "user_id", nan_to_null(F.col("value").cast("double")).alias("value"), "props", "event_type")
    k = F.regexp_extract("props", r'"k":\s*(-?[0-9.]+)', 1).try_cast("double")
    uid = F.col("user_id")
    day = F.date_format("ts", "EEEE")
    load_type = (F.when(F.col("event_id") % 3 == 0, F.lit(LOAD_TYPE_VALUES[0]))
                  .when(F.col("event_id") % 3 == 1, F.lit(LOAD_TYPE_VALUES[1]))
                  .otherwise(F.lit(LOAD_TYPE_VALUES[2])))
    return ev.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp_ntz").alias("date"),
        F.col("value").cast("double").alias("usage_kwh"),
        k.alias("lagging_current_reactive_power_kvarh"),
        (uid % 40).cast("double").alias("leading_current_reactive_power_kvarh"),
        (F.col("value") / F.lit(1000.0)).alias("co2_tco2"),
        (F.lit(50.0) + k / F.lit(2.0)).alias("lagging_current_power_factor"),
        (F.lit(100.0) - (uid % 50).cast("double")).alias("leading_current_power_factor"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("bigint").alias("nsm"),
        F.when(day.isin("Saturday", "Sunday"), F.lit("Weekend"))
         .otherwise(F.lit("Weekday")).alias("week_status"),
        day.alias("day_of_week"),
        load_type.alias("load_type"),
        *([F.col("event_type").alias("dataset")] if with_tag else []),
    )


def render_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string dirty rendering with the raw column names (dotted one included)."""
    return dirty_from_readings(readings(spark, sf_dir))


def dirty_from_readings(clean: DataFrame) -> DataFrame:
    """The dirty rendering of clean readings; the numbers' texts and kinds are made first."""
    doubles = [c for c in NUMERIC_COLUMNS if c != "nsm"]
    kinds = {f"{c}_kind": F.expr(numeric_kind(j)) for j, c in enumerate(NUMERIC_COLUMNS)}
    rows = clean.withColumns({f"{c}_plain": F.col(c).cast("string") for c in doubles} | kinds)
    rows = rows.withColumns({c: F.expr(six_decimals(c, f"{c}_plain")) for c in doubles} | {"nsm": F.expr(f"CAST({corrupt_nsm()} AS STRING)")})
    return rows.select(*[F.expr(e).alias(name) for e, name in dirty_select_list("spark")])


def dirty_columns() -> list[str]:
    return [name for _, name in dirty_select_list("spark")]


# Where this application has stored the dirty readings of a table with this content.
_STORED: dict[tuple, str] = {}


def readings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty readings as a stored all-string table: the stand-in for the raw file, so
    it is written once per application and version of the files of ``events``."""
    key = (spark.sparkContext.applicationId, sf_dir, table_version(spark, sf_dir, "events"))
    if key not in _STORED:
        # As one method the rendering of a row is over the 8,000 bytes up to which the JVM compiles one.
        limit = "spark.sql.codegen.hugeMethodLimit"
        before = spark.conf.get(limit)
        spark.conf.set(limit, "8000")
        try:
            _STORED[key] = write_parquet(render_dirty(spark, sf_dir), scratch_path(spark, "readings_dirty"))
        finally:
            spark.conf.set(limit, before)
    return spark.read.parquet(_STORED[key])


def readings_dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Path of the dirty readings written as a CSV text file (A1)."""
    return write_csv(render_dirty(spark, sf_dir), scratch_path(spark, "readings_dirty_csv"))

