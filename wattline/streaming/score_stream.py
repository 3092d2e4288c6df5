"""Streaming validate + score.

Events arrive as files; each micro-batch is mapped to readings and scoring
requests, validated (F9) and split into predictions and a quarantine, both
appended to tables by ``foreachBatch``. Stateless: no watermark needed. The
checkpoint location lives under the shared checkpoint folder, so a restarted
query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.scoring import UsageModel, score_batch
from wattline.operators.validate import request_errors
from wattline.schema import DAY_OF_WEEK_VALUES, LOAD_TYPE_VALUES, WEEK_STATUS_VALUES
from wattline.session import scratch_path
from wattline.sources.readings import readings_from_events
from wattline.sources.requests import REQUEST_NUMERIC, requests_from_readings

DOMAINS = {"Day_of_week": DAY_OF_WEEK_VALUES, "WeekStatus": WEEK_STATUS_VALUES, "Load_Type": LOAD_TYPE_VALUES}


def event_stream(spark: SparkSession, source_dir: str) -> DataFrame:
    """The Parquet files of the `events` table: those of the folder `events.parquet`, also
    if added later, or the one file of that name."""
    path = f"{source_dir.rstrip('/')}/events.parquet"
    table = spark.read.parquet(path)
    first = table.select(F.input_file_name().alias("f")).first()
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
    if first is not None and first["f"].rsplit("/", 1)[-1] == "events.parquet":
        return reader.option("pathGlobFilter", "events.parquet").parquet(source_dir)
    return reader.parquet(path)


def run(spark: SparkSession, source_dir: str, model: UsageModel | None, out_root: str | None = None):
    """Drain the available files (availableNow) and return the three table paths."""
    out_root = out_root or scratch_path(spark, "stream")
    paths = {"batch": f"{out_root}/batch", "checked": f"{out_root}/checked", "predictions": f"{out_root}/predictions",
             "quarantine": f"{out_root}/quarantine", "checkpoint": f"{out_root}/_checkpoint"}
    checked = request_errors(requests_from_readings(readings_from_events(event_stream(spark, source_dir))),
                             REQUEST_NUMERIC, "NSM", DOMAINS)

    def sink(batch: DataFrame, epoch: int) -> None:
        # foreachBatch may re-run an epoch after a failure: each epoch owns one
        # partition directory and overwrites it, so a retry replaces, not duplicates.
        part = f"epoch={epoch}"
        # The batch is read and checked once; the other tables come from its stored rows.
        batch.write.mode("overwrite").parquet(f"{paths['batch']}/{part}")
        stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{paths['batch']}/{part}")
        stored.select("request_id", "is_valid", F.array_join("errors", "; ").alias("errors")) \
              .write.mode("overwrite").parquet(f"{paths['checked']}/{part}")
        stored.where(~F.col("is_valid")).write.mode("overwrite").parquet(f"{paths['quarantine']}/{part}")
        if model is not None:
            score_batch(model, stored.where(F.col("is_valid"))).write.mode("overwrite") \
                .parquet(f"{paths['predictions']}/{part}")

    q = (checked.writeStream.foreachBatch(sink).option("checkpointLocation", paths["checkpoint"])
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return paths


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A sink table without its epoch partition column."""
    return spark.read.parquet(path).drop("epoch")
