"""Exact dedup by content-defined chunk recipes, in DataFrame functions only (operator 2).

A normalised text is cut where its own characters say so, so equal stretches give
equal chunks wherever they stand. A chunk's identifier is its SHA-256 digest, and
the identifiers are verified: the distinct (digest, chunk) pairs are gathered once
(each map task sends a chunk once, however often it occurs) and a digest with two
contents gets a variant number from the contents themselves. A document is then
its recipe, the ordered list of identifiers, and only recipes are grouped,
compared and joined: long texts don't move again.

Hot groups: the recipes are pre-aggregated before their shuffle, and the join that
brings a group's survivor back is a plain equi-join, which AQE splits on skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut, keep_rows, row_key

#: A chunk ends at the first mark from MIN_CHUNK characters on, or at MAX_CHUNK.
MIN_CHUNK, MAX_CHUNK, MARK = 1024, 16384, r"[.,;!?\n][ \n]?[^a-m]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z in lower case, all else as it is (lower() does just that to ASCII)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def chunks(text: Column) -> Column:
    """Ordered chunks whose concatenation is the text; none for an empty one."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{MARK}|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def variants(chunked: DataFrame, digest=sha256) -> DataFrame:
    """(digest, chunk, variant) of chunks whose digest is also another content's; the
    least of the contents has variant 0 and isn't listed. Empty unless digests collide."""
    distinct = chunked.select(F.explode("_chunks").alias("chunk")).select(digest(F.col("chunk")).alias("digest"), "chunk").distinct()
    shared = distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("chunk").alias("least")).filter("n > 1")
    order = Window.partitionBy("digest").orderBy("chunk")
    return (distinct.join(shared, "digest").select("digest", "chunk", F.row_number().over(order).alias("variant"))
            .filter("variant > 1").withColumn("variant", F.col("variant") - 1))


def _named_apart(recipes: DataFrame, chunked: DataFrame, doubtful: DataFrame, digest) -> DataFrame:
    """`recipes` with the variant of each doubtful chunk appended to its digest."""
    rows = chunked.select("doc_id", "text_sha256", F.posexplode("_chunks").alias("at", "chunk")).distinct()
    named = rows.withColumn("digest", digest(F.col("chunk"))).join(doubtful, ["digest", "chunk"], "left").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "at",
        F.concat("digest", F.coalesce(F.col("variant").cast("string"), F.lit("")).cast("binary")).alias("name"))
    lists = named.groupBy("_id", "_sha").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("_names"))
    same = recipes["doc_id"].eqNullSafe(lists["_id"]) & (recipes["text_sha256"] == lists["_sha"])
    return recipes.join(lists, same, "left").select("doc_id", "text_sha256", F.coalesce("_names", "recipe").alias("recipe"), "row_no")


def with_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty, and all empty texts are one group. The row with the largest doc_id stays;
    null ids rank lowest, and of rows that repeat an id and a text exactly one stays.
    An empty table gives no rows; columns other than the two named are ignored,
    whatever their names.
    """
    chunked = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("_text")).select(
        "doc_id", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"), chunks(F.col("_text")).alias("_chunks"))
    recipes = cut(chunked.select("doc_id", "text_sha256", F.transform("_chunks", digest).alias("recipe"),
                                 F.monotonically_increasing_id().alias("row_no")))
    doubtful = cut(variants(chunked, digest))
    if not doubtful.isEmpty():
        recipes = _named_apart(recipes, chunked, doubtful, digest)
    groups = cut(recipes.groupBy("recipe").agg(F.max(F.struct("doc_id", "row_no")).alias("_best"), F.count(F.lit(1)).alias("_n"))
                 .filter("_n > 1"))
    alone = F.col("_n").isNull()
    return recipes.join(groups, "recipe", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_no") == F.col("_best.row_no"))).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with one row of each group of equal texts: the one with the
    largest id. A null text is equal to an empty one; of rows that repeat id and text one
    stays; null ids come last; an empty table gives no rows."""
    kept = with_groups(docs, id_col, text_col).filter("kept")
    keys = kept.select(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256").alias("key"))
    return keep_rows(docs, keys, row_key(F.col(id_col).cast("long"), normalised(F.col(text_col))), text_col)
