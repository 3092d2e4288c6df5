"""Scoring requests derived from the readings (the request/response stand-in).

Field names follow the request schema. A deterministic share of rows carries
each invalid case: missing field, NSM above range, negative NSM, unknown
day, unknown week status, unknown load type, NSM as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.sources.readings import readings

REQUEST_NUMERIC = ["Lagging_Current_Reactive_Power_kVarh", "Leading_Current_Reactive_Power_kVarh",
                   "CO2(tCO2)", "Lagging_Current_Power_Factor", "Leading_Current_Power_Factor"]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_readings(readings(spark, sf_dir))


def requests_from_readings(r: DataFrame) -> DataFrame:
    rid = F.col("reading_id")
    nsm = (F.when(rid % 53 == 0, (F.col("nsm") + 86400).cast("string"))
            .when(rid % 59 == 0, F.lit("-100"))
            .when(rid % 79 == 0, F.lit("noon"))
            .otherwise(F.col("nsm").cast("string")))
    return r.select(
        rid.alias("request_id"),
        F.when(rid % 73 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("lagging_current_reactive_power_kvarh")).alias(REQUEST_NUMERIC[0]),
        F.col("leading_current_reactive_power_kvarh").alias(REQUEST_NUMERIC[1]),
        F.col("co2_tco2").alias(REQUEST_NUMERIC[2]),
        F.col("lagging_current_power_factor").alias(REQUEST_NUMERIC[3]),
        F.col("leading_current_power_factor").alias(REQUEST_NUMERIC[4]),
        nsm.alias("NSM"),
        F.when(rid % 61 == 0, F.lit("Funday")).otherwise(F.col("day_of_week")).alias("Day_of_week"),
        F.when(rid % 67 == 0, F.lit("Holiday")).otherwise(F.col("week_status")).alias("WeekStatus"),
        F.when(rid % 71 == 0, F.lit("Extreme_Load")).otherwise(F.col("load_type")).alias("Load_Type"),
    )
