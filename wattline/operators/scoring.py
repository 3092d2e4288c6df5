"""Scoring: request rows -> model rows -> predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.features import ReadingsEncoder
from wattline.operators.models import fit_ols
from wattline.schema import q

# request field -> model column (the model was trained on these names)
REQUEST_TO_MODEL = [
    ("Lagging_Current_Reactive_Power_kVarh", "lagging_current_reactive_power_kvarh"),
    ("Leading_Current_Reactive_Power_kVarh", "leading_current_reactive_power_kvarh"),
    ("CO2(tCO2)", "co2_tco2"),
    ("Lagging_Current_Power_Factor", "lagging_current_power_factor"),
    ("Leading_Current_Power_Factor", "leading_current_power_factor"),
    ("NSM", "nsm"),
    ("Day_of_week", "day_of_week"),
    ("WeekStatus", "week_status"),
    ("Load_Type", "load_type"),
]
DUMMY_DATE = "2024-01-01 00:00:00"


def request_to_model_row(df: DataFrame, key: str = "request_id") -> DataFrame:
    """One columnar select: rename, reorder, integer NSM, dummy date first."""
    sel = [F.col(key), F.lit(DUMMY_DATE).cast("timestamp_ntz").alias("date")]
    for src, dst in REQUEST_TO_MODEL:
        c = F.col(q(src))
        sel.append(c.cast("string").try_cast("bigint").alias(dst) if dst == "nsm" else c.alias(dst))
    return df.select(*sel)


class UsageModel:
    """A stored pipeline: encoder (train statistics), then least squares on the 14
    encoded features."""

    def __init__(self, pipeline: PipelineModel):
        self.pipeline = pipeline

    @classmethod
    def fit(cls, train: DataFrame, label: str = "usage_kwh") -> "UsageModel":
        encoder = ReadingsEncoder.fit_on(train)
        return cls(PipelineModel([encoder, fit_ols(encoder.transform(train), label)]))

    def save(self, path: str) -> str:
        self.pipeline.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str) -> "UsageModel":
        return cls(PipelineModel.load(path))

    def predict(self, rows: DataFrame, out: str = "prediction") -> DataFrame:
        return self.pipeline.transform(rows).withColumnRenamed("prediction", out).drop("features")


def score_batch(model: UsageModel, valid_requests: DataFrame, key: str = "request_id") -> DataFrame:
    """One prediction per valid request (the count is a cheap aggregate of it)."""
    rows = request_to_model_row(valid_requests, key)
    return model.predict(rows).select(key, F.col("prediction").alias("Usage_kWh"))
