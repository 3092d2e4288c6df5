"""Corpus pipeline: from `documents` to encoded training text, one operator a stage.

Each stage works on all that the one before it kept. Between stages the documents
are written as Parquet and read again, so no stage computes an earlier one anew.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.llm import exact_dedup, jaccard_join, lang_id, piece_codec, source_mix
from wattline.llm.common import load
from wattline.session import scratch_path


def identify_language(spark, docs, sf_dir):
    """Documents without a letter, whose language can't be told, go; the others carry the
    identified language in `lang`."""
    return lang_id.with_language(docs)


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of documents linked by shared 5-word shingles the one with the least id stays."""
    return jaccard_join.drop_near_copies(docs)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix takes it: not at all, once or twice."""
    return source_mix.mixed_documents(docs)


def encode(spark, docs, sf_dir):
    """SentencePiece ids of every row that is left: doc_id, n_tokens, ids."""
    return piece_codec.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can't learn a language model or encode; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The result of the last stage: doc_id, n_tokens, ids. Documents with a null text or
    without a letter go in the first stage, so no later one meets them; repeated rows go in
    the second; null ids stay; an empty table gives no rows."""
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
