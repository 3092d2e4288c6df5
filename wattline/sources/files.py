"""File sources and sinks (A1-A10).

CSV is read with an explicit schema (no inference pass), leading/trailing
whitespace preserved (it carries meaning in the dirty file), and missing-value
literals handled after the read because Spark's ``nullValue`` takes one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.dates import format_day_first
from wattline.schema import q

CSV_TEXT_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}

#: The header must name the expected columns, and a row with too many or too few
#: fields fails the read instead of shifting or losing values.
CSV_STRICT_OPTIONS = {"mode": "FAILFAST", "enforceSchema": "false"}


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A1: every column as STRING; fails if the path is missing, has no rows, or its
    header or a row doesn't fit the columns."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = spark.read.schema(schema).options(**CSV_TEXT_OPTIONS, **CSV_STRICT_OPTIONS).csv(path)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   timestamp_format: str | None = None) -> DataFrame:
    """A3 / A4: typed CSV scan (dates parsed by the reader); a cell that can't be read
    as its type fails the read."""
    reader = spark.read.schema(schema).option("header", "true").options(**CSV_STRICT_OPTIONS)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A5: header, no index column; the directory is created by the writer."""
    df.write.mode(mode).options(**CSV_TEXT_OPTIONS).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Default sink (A5, A7-A10): Parquet, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def with_rendered_dates(df: DataFrame, date_cols: list[str]) -> DataFrame:
    """Render the listed timestamp columns as ``dd/MM/yyyy HH:mm`` text;
    names that are missing or not timestamps are skipped."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    todo = [c for c in date_cols
            if c in kinds and isinstance(kinds[c], (T.TimestampType, T.TimestampNTZType,
                                                    T.DateType))]
    return df.withColumns({c: format_day_first(F.col(q(c))) for c in todo})
