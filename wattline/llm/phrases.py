"""Phrase collocations by Rabin-Karp fingerprints (operator 11).

A task cuts its texts into words and hashes every n-gram with prefix polynomials in
numpy: one over the bytes for words, one over the words for n-grams, modulo 2^64. In a
task the occurrences of a fingerprint are held as a count and a pointer into the task's
text; only fingerprints and counts are shuffled, level by level: an n-gram can be
frequent only if both (n-1)-grams in it are. The frequent fingerprints come back as a
bit set of fixed size. In a last pass the tasks follow the pointers of frequent
fingerprints to the text, after words that share a fingerprint have been compared byte
by byte, and phrases are counted by their text. Fingerprints that collide or are
falsely known in the bit set cost time but change no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.bitmaps import bit_set, holds, mixed
from wattline.llm.common import cut, small_batches

#: Fixed by the task: what separates pieces, and words inside them.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
UNKNOWN_LANG = "und"
MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
#: A phrase goes if a longer one around it has this share of its occurrences, in percent.
ABSORBED = 50

#: Bytes of text that a task holds at a time (longer only where a single piece is), and
#: that it hashes at a time (longer only where a single word is).
CHUNK = 4 << 20
HASHED = 1 << 18
#: Bits of a set of frequent fingerprints: 2^27 are 16 MB.
SET_BITS = 27
#: Bits of a fingerprint that are shuffled. They only tell which n-grams may be frequent.
SENT_BITS = 48
#: Words with at least this share of all words are at most that many; they meet the most phrases.
HOT_WORDS = 10_000

#: Input partitions that a task takes (as long as every core has a task): the more text
#: in a task, the fewer n-grams are sent by several of them.
SPLITS = 4
#: Fingerprints that a task holds with their counts before it sends them.
HELD = 2_000_000

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_END = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_KIND = np.zeros(256, dtype=np.uint8)  # 0 letter of a word, 1 between words, 2 between pieces
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2^64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(max(n, 1 << 16), b, dtype=np.uint64)
            out[0] = 1
            both.append(np.cumprod(out, dtype=np.uint64))
        made = (both[0], both[1])
        if n > CHUNK:
            return made  # a single huge word or piece: not kept
        _POWERS[base] = made
    up, down = _POWERS[base]
    return up[:n], down[:n]


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomial of the values and the inverse powers that shift a stretch to 0."""
    up, down = _powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(up[:len(values)] * values, dtype=np.uint64, out=out[1:])
    return out, down


class Chunk:
    """Words of some texts: bytes, piece, language and fingerprint of each."""

    def __init__(self, texts: list[tuple[str, bytes]]):
        self.langs = sorted({lang for lang, _ in texts})
        number = {lang: i for i, lang in enumerate(self.langs)}
        raw = np.frombuffer(b"\n".join(t for _, t in texts), dtype=np.uint8)
        self.bytes = _LOWER[raw]
        kind = _KIND[raw]
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        step = np.diff(inside)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.piece = np.cumsum(kind == 2)[self.start] if len(raw) else np.zeros(0, dtype=np.int64)
        text_at = np.cumsum([0] + [len(t) + 1 for _, t in texts[:-1]])
        lang_of = np.array([number[lang] for lang, _ in texts], dtype=np.int64)
        self.lang = lang_of[np.searchsorted(text_at, self.start, "right") - 1]
        self.salt = np.array([_hash(lang.encode()) for lang in self.langs], dtype=np.uint64)
        self.word = np.zeros(len(self.start), dtype=np.uint64)
        edges = np.unique(np.searchsorted(self.start, np.arange(0, len(raw) + HASHED, HASHED)))
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            low = self.start[i]
            sums, shift = _sums(self.bytes[low:self.end[j - 1]].astype(np.uint64) + np.uint64(1), BYTE_BASE)
            self.word[i:j] = mixed((sums[self.end[i:j] - low] - sums[self.start[i:j] - low]) * shift[self.start[i:j] - low])
        self.sums, self.shift = _sums(self.word, WORD_BASE)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per first word: the fingerprint of the n-gram, and whether it stays in a piece."""
        m = max(0, len(self.start) - n + 1)
        first = np.arange(m)
        h = (self.sums[n:n + m] - self.sums[:m]) * self.shift[:m]
        h = mixed(h + self.salt[self.lang[:m]] + np.uint64(n * BYTE_BASE % (1 << 64)))
        return h, self.piece[first] == self.piece[first + n - 1]

    def word_ids(self) -> np.ndarray:
        """A number per distinct (word, language) of the chunk; words with one
        fingerprint are compared with the first of them, byte by byte."""
        if not len(self.word):
            return np.zeros(0, dtype=np.int64)
        _, first, ids = np.unique(self.word, return_index=True, return_inverse=True)
        length, other = self.end - self.start, first[ids]
        same = length == length[other]
        if same.all():
            at = np.repeat(self.start - np.cumsum(length) + length, length) + np.arange(length.sum())
            same = (self.bytes[at] == self.bytes[at + np.repeat(self.start[other] - self.start, length)]).all()
        if not np.all(same):
            known: dict[bytes, int] = {}
            ids = np.array([known.setdefault(self.bytes[a:b].tobytes(), len(known)) for a, b in zip(self.start, self.end, strict=True)])
        return ids * len(self.langs) + self.lang

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        """Texts of the n-grams at these pointers, words joined by one space."""
        length = self.end - self.start
        if not hasattr(self, "joined"):
            self.at = np.cumsum(length + 1) - length - 1
            self.joined = np.full(int((length + 1).sum()), ord(" "), dtype=np.uint8)
            src = np.repeat(self.start - np.cumsum(length) + length, length) + np.arange(length.sum())
            self.joined[src + np.repeat(self.at - self.start, length)] = self.bytes[src]
        begin = self.at[first]
        size = self.at[first + n - 1] + length[first + n - 1] - begin
        offsets = np.zeros(len(first) + 1, dtype=np.int64)
        np.cumsum(size, out=offsets[1:])
        data = self.joined[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def _hash(text: bytes) -> np.uint64:
    h = 0
    for b in text:
        h = (h * BYTE_BASE + b + 1) % (1 << 64)
    return mixed(np.array([h], dtype=np.uint64))[0]


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes, cut only between pieces."""
    at = 0
    while len(text) - at > CHUNK:
        end = _END.search(text, at + CHUNK - 1)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:] if at else text


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    held, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for part in _parts(text.as_py()):
                if size + len(part) > CHUNK and held:
                    yield Chunk(held)
                    held, size = [], 0
                held.append((lang, part))
                size += len(part) + 1
    if held:
        yield Chunk(held)


def _known(packed: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    return holds(packed, h >> np.uint64(64 - bits))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    tasks = max(spark.sparkContext.defaultParallelism, -(-docs.rdd.getNumPartitions() // SPLITS))
    return docs.coalesce(tasks).select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.col(text_col).cast("string").cast("binary").alias("text")).where("octet_length(text) > 0")


class _Counts:
    """Sorted fingerprints with counts; `add` returns those to send once there are too many."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.merged = 0

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        h, c = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
        return h[first], np.add.reduceat(c, first) if len(first) else c

    def add(self, h: np.ndarray, c: np.ndarray) -> list[pa.RecordBatch]:
        self.parts.append((h, c))
        self.size += len(h)
        if self.size < self.merged + HELD // 2:
            return []
        both = self.merge()
        self.parts, self.size, self.merged = [both], len(both[0]), len(both[0])
        return self.rows() if self.size > HELD else []

    def rows(self) -> list[pa.RecordBatch]:
        h, c = self.merge() if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.parts, self.size, self.merged = [], 0, 0
        step = 200_000
        return [pa.RecordBatch.from_arrays([pa.array(h[i:i + step].view(np.int64)), pa.array(c[i:i + step])], names=["h", "c"]) for i in range(0, len(h), step)]


def frequent_fingerprints(texts: DataFrame, n: int, below, min_count: int, bits: int = SET_BITS) -> np.ndarray:
    """Bit set of the n-gram fingerprints that occur `min_count` times; `below` is the
    broadcast set of the (n-1)-grams (None for n = 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for chunk in chunks(batches):
            h, wanted = chunk.grams(n)
            if below is not None:
                shorter, _ = chunk.grams(n - 1)
                known = _known(below.value, shorter, bits)
                wanted = wanted & known[:len(h)] & known[1:len(h) + 1]
            yield from held.add(*np.unique(h[wanted] >> np.uint64(64 - SENT_BITS), return_counts=True))
        yield from held.rows()

    # The tasks have added up what they hold, so the rows are dealt out as they are.
    counted = texts.mapInArrow(run, "h long, c long").repartition("h").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= min_count)
    return bit_set(counted, F.shiftrightunsigned("h", SENT_BITS - bits), 1 << bits)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT, bits: int = SET_BITS) -> DataFrame:
    """(lang, words, phrase, f): the phrases of 1 to `max_words` words that occur at
    least `min_count` times in their language, and per language a row (lang, 0, '', n)
    with the number of all its words."""
    texts = _texts(docs, text_col, lang_col)
    sets: list = []
    for n in range(1, max_words + 1):
        below = sets[-1] if sets else None
        sets.append(texts.sparkSession.sparkContext.broadcast(frequent_fingerprints(texts, n, below, min_count, bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            langs = pa.array(chunk.langs, pa.string())
            total = np.bincount(chunk.lang, minlength=len(chunk.langs))
            yield pa.RecordBatch.from_arrays([langs, pa.array(np.zeros(len(langs), np.int32)), pa.array([""] * len(langs)), pa.array(total)], names=["lang", "words", "phrase", "c"])
            one = shorter = chunk.word_ids()
            for n in range(1, max_words + 1):
                h, wanted = chunk.grams(n)
                if n > 1:  # exact numbers of n-grams from those of (n-1)-grams and words
                    wanted &= shorter[:len(h)] >= 0
                at = np.flatnonzero(wanted)
                at = at[_known(sets[n - 1].value, h[at], bits)]
                if not len(at):
                    break
                key = one[at] if n == 1 else (shorter[at] << 32) | one[at + n - 1]
                _, first, ids, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                if n == 1:
                    one = shorter = np.full(len(h), -1, dtype=np.int64)
                    one[at] = ids
                else:
                    shorter = np.full(len(h), -1, dtype=np.int64)
                    shorter[at] = ids
                first = at[first]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(chunk.lang[first])), pa.array(np.full(len(first), n, np.int32)), chunk.phrases(first, n), pa.array(count)],
                                                 names=["lang", "words", "phrase", "c"])

    rows = texts.mapInArrow(run, "lang string, words int, phrase string, c long")
    counted = rows.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f"))
    return counted.where((F.col("words") == 0) | (F.col("f") >= min_count))


def _with_count(rows: DataFrame, grams: DataFrame, hot: DataFrame, part: str, name: str) -> DataFrame:
    """`rows` with `name`, the count of the phrase in column `part`. The rows of the words
    in `hot` are answered by it, and spread over keys that match nothing in the join."""
    known = hot.select("lang", F.col("phrase").alias(part), F.col("f").alias("_hot"))
    keyed = rows.join(F.broadcast(known), ["lang", part], "left")
    keyed = keyed.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(part)).otherwise(F.concat(F.lit(" "), F.xxhash64("phrase").cast("string"))))
    side = grams.select("lang", F.col("phrase").alias("_key"), F.col("f").alias("_f"))
    return keyed.join(side, ["lang", "_key"], "left").withColumn(name, F.coalesce("_hot", "_f")).drop("_key", "_hot", "_f")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 top: int = TOP, absorbed: int = ABSORBED, bits: int = SET_BITS) -> DataFrame:
    """The best phrases of 2 to `max_words` words of each language: lang, rank, phrase, a, l, r, n, score.

    a, l, r are the occurrences of the phrase and of its two parts at the weakest cut
    (ties: the first), score is floor(10^6 a a / (l r)) there, n the words of the
    language. Phrases inside a longer one with at least `absorbed` percent of their
    occurrences go; then the `top` by score, a (both descending) and phrase (bytes) stay.
    Texts are lower-cased in A-Z only; null and empty texts have no words, a null
    language is `und`; repeated rows count each time; other columns are left out.
    Counts may reach 5 * 10^15. An empty table gives no rows.
    """
    all_grams = cut(frequent_phrases(docs, text_col, lang_col, max_words, min_count, bits))
    totals = all_grams.where("words = 0").select("lang", F.col("f").alias("n"))
    grams = all_grams.where("words > 0")
    found = grams.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    k = F.col("k")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "k", F.array_join(F.slice("w", 1, k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.col("words") - k), " ").alias("right"))
    words = totals.agg(F.sum("n").alias("all"))
    hot = grams.where("words = 1").crossJoin(F.broadcast(words)).where(F.col("f") * HOT_WORDS >= F.col("all"))  # at most HOT_WORDS rows
    cuts = _with_count(cuts, grams, hot, "left", "l")
    cuts = _with_count(cuts, grams, hot, "right", "r")
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", (big["a"] * big["a"] * F.lit(1_000_000).cast("decimal(7,0)")).alias("top"), (big["l"] * big["r"]).alias("bottom"))
    cuts = cuts.withColumn("score", F.expr("top div bottom"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    # contiguous parts of 2 words or more, with the largest count of a phrase around each
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    around = found.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(~F.coalesce(F.col("longer") * 100 >= F.col("a") * absorbed, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
