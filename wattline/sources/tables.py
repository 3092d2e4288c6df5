"""Parquet table scans of the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def table_version(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Names the present files of a table (path, size, time of change); no file is read."""
    files = spark.read.format("binaryFile").load(table_path(sf_dir, name))
    one = F.xxhash64(F.col("path"), F.col("length"), F.unix_micros("modificationTime")).cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(one)).first()
    return f"{n}-{total}"
