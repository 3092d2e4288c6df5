"""Spelling variants: words one edit apart, by Bloom-guided neighbourhoods (operator 12).

The vocabulary is counted by Spark and put into blocked Bloom filters, one shard of
blocks for each word length, of a bounded total size. Every word's possible edits are
hashed in numpy (a polynomial hash makes an edit's hash from the word's) and probed;
only the edits that the filter knows become strings, and an equi-join with the
vocabulary removes those that it knew falsely. Nearness is symmetric, so only
deletions and replacements by a greater letter are probed: each pair is met once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.bitmaps import bit_set, holds, mixed
from wattline.llm.common import cut, id_and_text

#: A run of letters; every one of them is a Latin-1 character.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form occurs at least so many times as often as its variant.
RATIO = 2
#: One in so many (document, run) pairs loses a letter before words are counted.
ONE_IN = 97

BITS_PER_WORD = 16
#: Most bits of all filters (32 MB); more words only mean more probes that the join removes.
MOST_BITS = 1 << 28
BLOCK = 512
#: Lengths from this one on share a shard.
LAST_SHARD = 64
#: Hashes that a probe holds at a time.
PROBES = 1 << 20

BASE = 0x9E3779B97F4A7C15


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """(word, n): the words of at least `min_letters` letters that occur `min_count` times.

    With h the crc32 of `<id>:<run>`, a run loses its letter h mod length where `one_in`
    divides h (0: never). A null id counts as empty, a null text holds no run.
    """
    run = id_and_text(docs, id_col, text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), 0)).alias("run"))
    run = run.where(F.length("run") >= min_letters).select("id", _lower(F.col("run")).alias("run"))
    word = F.col("run")
    if one_in:
        run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % one_in == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    words = run.select(word.alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class Filters:
    """Where the words of each length have their blocks: `first[shard]`, `blocks[shard]`."""

    def __init__(self, per_shard: dict[int, int], bits_per_word: int = BITS_PER_WORD, most_bits: int = MOST_BITS):
        total = sum(per_shard.values())
        share = min(1.0, most_bits / max(1, total * bits_per_word))
        self.first, self.blocks = np.zeros(LAST_SHARD + 1, np.int64), np.zeros(LAST_SHARD + 1, np.int64)
        at = 0
        for shard, n in sorted(per_shard.items()):
            self.first[shard], self.blocks[shard] = at, max(1, int(n * bits_per_word * share) // BLOCK)
            at += self.blocks[shard]
        self.bits = max(1, at) * BLOCK
        self.packed = np.zeros(0, np.uint8)

    def positions(self, h: np.ndarray, shard: int) -> list[np.ndarray]:
        """Three bits of one block for every hash; the shard holds at least a word."""
        h = mixed(h)
        block = self.first[shard] + ((h >> np.uint64(32)) % np.uint64(self.blocks[shard])).astype(np.int64)
        return [block * BLOCK + ((h >> np.uint64(9 * k)) & np.uint64(BLOCK - 1)).astype(np.int64) for k in range(3)]

    def hits(self, h: np.ndarray, shard: int) -> np.ndarray:
        """Indices of the hashes that the filter knows."""
        one, two, three = self.positions(h, shard)
        left = np.flatnonzero(holds(self.packed, one))
        left = left[holds(self.packed, two[left])]
        return left[holds(self.packed, three[left])]


def _shard(length: int) -> int:
    return min(length, LAST_SHARD)


def _powers(length: int, base: int) -> np.ndarray:
    out = np.full(length, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _by_length(words: list[str], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, letters as a matrix) of the words of one length, in bounded parts."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths):
        if length < least:
            continue
        rows = np.flatnonzero(lengths == length)
        step = max(1, PROBES // int(length))
        for i in range(0, len(rows), step):
            some = rows[i:i + step]
            letters = np.frombuffer("".join(words[r] for r in some).encode("latin-1"), dtype=np.uint8).reshape(len(some), int(length))
            yield some, letters


def _hashes(letters: np.ndarray) -> np.ndarray:
    return letters.astype(np.uint64) @ _powers(letters.shape[1], BASE)


def build_filters(words: DataFrame, bits_per_word: int = BITS_PER_WORD, most_bits: int = MOST_BITS) -> Filters:
    shard = F.least(F.length("word"), F.lit(LAST_SHARD))
    counts = words.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most LAST_SHARD rows
    filters = Filters({r["shard"]: r["n"] for r in counts}, bits_per_word, most_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch.column(0).to_pylist(), 1):
                at = filters.positions(_hashes(letters), _shard(letters.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at))], names=["at"])

    filters.packed = bit_set(words.select("word").mapInArrow(run, "at long"), F.col("at"), filters.bits)
    return filters


def _edits(letters: np.ndarray, alphabet: np.ndarray, filters: Filters, min_letters: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row numbers, edited words) of the edits that the filters know."""
    m, length = letters.shape
    one = letters.astype(np.uint64)
    power = _powers(length, BASE)
    whole = one @ power
    shard = _shard(length)
    step = max(1, PROBES // len(alphabet))
    for i in range(length):
        for start in range(0, m, step):
            old = letters[start:start + step, i]
            h = whole[start:start + step, None] + (alphabet.astype(np.uint64)[None, :] - one[start:start + step, i, None]) * power[i]
            row, letter = np.nonzero(alphabet[None, :] > old[:, None])
            known = filters.hits(h[row, letter], shard)
            if len(known):
                row, new = row[known] + start, alphabet[letter[known]]
                edited = letters[row].copy()
                edited[:, i] = new
                yield row, [x.tobytes().decode("latin-1") for x in edited]
    shorter = _shard(length - 1)
    if length > min_letters and filters.blocks[shorter]:
        inverse = np.uint64(pow(BASE, -1, 1 << 64))
        before = np.zeros(m, dtype=np.uint64)
        for i in range(length):
            upto = before + one[:, i] * power[i]
            # of a run of equal letters only the first one goes: the results are the same
            row = np.arange(m) if i == 0 else np.flatnonzero(letters[:, i] != letters[:, i - 1])
            known = row[filters.hits((before + (whole - upto) * inverse)[row], shorter)]
            if len(known):
                yield known, [x.tobytes().decode("latin-1") for x in np.delete(letters[known], i, axis=1)]
            before = upto


def near_pairs(words: DataFrame, min_letters: int = MIN_LETTERS, bits_per_word: int = BITS_PER_WORD, most_bits: int = MOST_BITS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of vocabulary words one edit apart.
    `words` is a stored table (word, n) of distinct Latin-1 words."""
    spark = words.sparkSession
    # at most 90 letters: those of RUN after lower-casing
    found = [r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()]
    if not found:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    alphabet = np.array(sorted(map(ord, found)), dtype=np.uint8)
    shared = spark.sparkContext.broadcast((alphabet, build_filters(words, bits_per_word, most_bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters_used, filters = shared.value
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1)
            for rows, letters in _by_length(texts, 1):
                for row, edits in _edits(letters, letters_used, filters, min_letters):
                    at = pa.array(rows[row])
                    yield pa.RecordBatch.from_arrays([pa.array(edits, pa.string()), batch.column(0).take(at), counts.take(at)], names=["near", "word", "n"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    probes = words.select("word", "n").repartition(parts, "word").mapInArrow(run, "near string, word string, n long")
    pairs = probes.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    both = F.array(F.struct("word", "n", "near", "near_n"),
                   F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): every form followed to the last one, by pointer
    doubling. Counts at least double along a chain, so its length is at most their
    logarithm and the number of rounds the logarithm of that."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        at = cut(moved)
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, one_in: int = ONE_IN) -> DataFrame:
    """One row per vocabulary word: word, form, root (string), n, n_near, form_n (long).

    `form` is the near word with the largest n (ties: first in code-point order), if that
    is at least `ratio` times the word's; `root` is the last form of the chain, the word
    itself if it has none. Null texts and empty tables have no words; repeated rows count
    each time; other columns are left out.
    """
    words = cut(vocabulary(docs, id_col, text_col, min_letters, min_count, one_in))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    near = near_pairs(words, min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    far = -F.col("best.order")
    has_form = far >= ratio * F.col("n")
    told = cut(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, far).alias("form_n")))
    last = roots(told.where("form is not null").select("word", "form"))
    return told.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
