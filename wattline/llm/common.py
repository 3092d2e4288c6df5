"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.session import checkpoint_root

#: Text handled together inside one Python task, in characters.
GROUP_CHARS = 1_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit for Arrow batches: long texts fill the default of 64 MB,
    of which JVM and worker hold several copies for each task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.conf.get(name).rstrip("b")
    if not size.isdigit() or int(size) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) with null texts as empty; every other column is left out."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def is_held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.sha2(text.cast("binary"), 256))


def keep_rows(docs: DataFrame, keys: DataFrame, key: Column, text_col: str) -> DataFrame:
    """The rows of `docs`, all columns, whose `key` is in keys.key; of rows with the
    same key, the one with the least hash of its other columns."""
    other = [c for c, kind in docs.dtypes if c != text_col and "map<" not in kind]
    order = Window.partitionBy("__llm_key").orderBy(F.xxhash64(*other))
    return (docs.withColumn("__llm_key", key).join(keys.select(F.col("key").alias("__llm_key")).distinct(), "__llm_key", "left_semi")
            .withColumn("__llm_no", F.row_number().over(order)).filter("__llm_no = 1").select(*docs.columns))


def text_groups(batch: pa.RecordBatch, chars: int = GROUP_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of a (doc_id, text) batch in groups of about `chars` characters."""
    ids, col = batch.column("doc_id"), batch.column("text")
    size = 0
    first, texts = 0, []
    for i in range(len(col)):
        t = col[i].as_py() or ""
        texts.append(t)
        size += len(t)
        if size >= chars:
            yield ids.slice(first, i + 1 - first), texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield ids.slice(first, len(col) - first), texts


def map_texts(docs: DataFrame, per_group: Callable, schema: str) -> DataFrame:
    """Apply ``per_group(texts) -> {column: arrow array}`` to groups of texts of
    (doc_id, text) rows; the result is doc_id and those columns."""
    names = [c.strip().split(" ")[0] for c in schema.split(";")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_groups(batch):
                out = per_group(texts)
                yield pa.RecordBatch.from_arrays([ids, *[out[n] for n in names]], names=["doc_id", *names])

    ddl = "doc_id long, " + ", ".join(c.strip() for c in schema.split(";"))
    return docs.select("doc_id", "text").mapInArrow(run, ddl)
