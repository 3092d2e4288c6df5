"""Sharding over fixed virtual slots, in DataFrame functions only (operator 7).

Every record hashes into one of SLOTS virtual slots, for good. Bytes and rows are
summed per slot, and a versioned map says which shard holds which slot. The map is
edited, never recomputed: shards keep their slots up to the mean, and only what
exceeds it, or lacks a shard, is dealt to the shards that hold least. Tables about
slots have SLOTS rows at most, whatever the input, so they may be broadcast and
dealt in one task; records are only ever grouped by slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut
from wattline.session import scratch_path

SLOTS, SHARDS, ROW_BYTES = 8192, 24, 8


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot): size is the text's UTF-8 bytes plus 8;
    a null text has no bytes. The hash takes id and checksum, so rows that share one
    of them still spread."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + F.lit(ROW_BYTES)).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_table(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, n_rows) of the slots in use."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _dealt(loose: DataFrame, loads: Column) -> DataFrame:
    """(virtual_slot, shard): largest slot first, each to the shard with least bytes.
    `loads` is the array of the shards' bytes so far."""
    slots = F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("minus"), F.col("virtual_slot"))))
    picks = F.array().cast("array<struct<virtual_slot:int,shard:int>>")

    def put(acc, slot):
        least = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return _let(least, lambda k: F.struct(
            F.transform(acc["loads"], lambda x, i: F.when(i == k, x - slot["minus"]).otherwise(x)).alias("loads"),
            F.concat(acc["picks"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), k.alias("shard")))).alias("picks")))

    start = F.struct(loads.alias("loads"), picks.alias("picks"))
    return (loose.agg(slots.alias("slots"))
            .select(F.explode(F.aggregate("slots", start, put, lambda acc: acc["picks"])).alias("pick"))
            .select("pick.virtual_slot", "pick.shard"))


#: Share by which a shard may exceed the mean before a stored map is edited.
TOLERANCE = 0.05


def first_map(slots: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: (version, virtual_slot, shard)."""
    dealt = _dealt(slots, F.array_repeat(F.lit(0).cast("long"), shards))
    return dealt.select(F.lit(1).alias("version"), "virtual_slot", "shard")


def edited_map(old: DataFrame, slots: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, for `shards` shards and the slots' present bytes.

    A shard keeps its slots, in order of their numbers, while they fit under the mean
    of all shards; the rest, slots new to the map and slots of shards that are no more
    are dealt to the shards with least bytes. One more shard takes slots only into
    itself when the others are even.
    """
    version = old.agg(F.max("version")).first()[0] + 1
    now = slots.join(F.broadcast(old.select("virtual_slot", "shard")), "virtual_slot", "left")
    mean = (slots.agg(F.sum("bytes")).first()[0] or 0) / shards
    w = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = cut(now.withColumn("stays", F.coalesce((F.col("shard") < shards) & (F.sum("bytes").over(w) <= F.lit(mean)), F.lit(False))))
    held = {r["shard"]: r["n"] for r in now.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("n")).collect()}  # one row a shard
    loads = F.array(*[F.lit(held.get(k, 0)).cast("long") for k in range(shards)])
    dealt = _dealt(now.filter("not stays").select("virtual_slot", "bytes"), loads)
    return now.filter("stays").select("virtual_slot", "shard").union(dealt).select(F.lit(version).alias("version"), "virtual_slot", "shard")


def save_map(slot_map: DataFrame, path: str) -> None:
    """Append a version to the stored map."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the last by default."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == F.lit(version)).select("version", "virtual_slot", "shard")


def place(rows: DataFrame, slots: DataFrame, slot_map: DataFrame) -> DataFrame:
    """`rows` with shard and slot, the record's number within its shard, from 0
    without gaps: the records of a shard's earlier virtual slots, then the number
    within the own one by doc_id and checksum."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (slots.join(F.broadcast(slot_map), "virtual_slot")
               .select("virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_no", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(offsets), "virtual_slot").withColumn("slot", (F.col("_offset") + F.col("_no")).cast("long")).drop("_offset", "_no")


def largest_shard(slots: DataFrame, slot_map: DataFrame) -> int:
    """Bytes of the shard that has most of them."""
    sums = slots.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("n"))
    return sums.agg(F.max("n")).first()[0] or 0


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, n_slots: int = SLOTS, map_path: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, map_version, shard, slot) of every
    document, sizes near equal between shards. The map is stored under `map_path`
    (the shared scratch folder by default); a map found there is edited if it has
    another number of shards, lacks a slot, or if a shard's present bytes exceed the mean
    by more than `tolerance` and an edit makes the largest shard smaller; it is used as
    it is otherwise. Equal texts are records of their own and may go to several shards.

    Null texts have no bytes; null ids and repeated rows are records like others; an
    empty table gives no rows; columns other than the two named are ignored.
    """
    spark = docs.sparkSession
    rows = cut(records(docs, n_slots, id_col, text_col))
    slots = cut(slot_table(rows))
    if map_path is None:
        map_path = scratch_path(spark, "slot-map")
        save_map(first_map(slots, shards), map_path)
    else:
        old = read_map(spark, map_path)
        lacks = slots.join(F.broadcast(old), "virtual_slot", "left_anti").limit(1).count()
        if lacks or old.agg(F.max("shard")).first()[0] != shards - 1:
            save_map(cut(edited_map(old, slots, shards)), map_path)
        else:
            most, mean = largest_shard(slots, old), (slots.agg(F.sum("bytes")).first()[0] or 0) / shards
            if most > mean * (1 + tolerance):
                new = cut(edited_map(old, slots, shards))
                if largest_shard(slots, new) < most:
                    save_map(new, map_path)
    slot_map = read_map(spark, map_path)
    version = slot_map.agg(F.max("version")).first()[0]
    return place(rows, slots, slot_map.drop("version")).withColumn("map_version", F.lit(version))
