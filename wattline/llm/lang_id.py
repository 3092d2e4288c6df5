"""Language identification, word first with n-gram backoff (operator 5).

A known word scores by its log frequency in each language; an unseen one by the
mean log frequency of its longest character n-grams that are known, tried from
NGRAM characters down to one. A document's scores are the sums over its words; the
language with the highest sum wins and its softmax share is the score.

Training counts words and n-grams of a bounded sample of labelled documents
(TRAIN_DOCS a language, chosen by a hash of the id) with Spark; the model that goes
to the workers is bounded too (WORDS words, GRAMS n-grams).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import cut, id_and_text, is_held_out, map_texts, small_batches, text_groups

#: Bounds of the training sample (documents a language, on average; most frequent
#: languages) and of the model.
TRAIN_DOCS, LANGUAGES, WORDS, GRAMS, NGRAM = 3000, 1000, 100_000, 60_000, 4
UNKNOWN = "und"
#: Unseen words whose scores a worker remembers.
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    """languages, most frequent first; words and grams: text -> row of `logs`."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    logs: np.ndarray

    def __post_init__(self):
        self.seen: dict[str, int] = {}
        self.table = self.logs

    def __getstate__(self):
        return (self.languages, self.words, self.grams, self.logs)

    def __setstate__(self, state):
        self.__init__(*state)

    def _backoff(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of an unseen word; none if no part is known."""
        padded = f"^{word}$"
        for n in range(NGRAM, 0, -1):
            hits = [g for i in range(len(padded) - n + 1) if (g := self.grams.get(padded[i:i + n])) is not None]
            if hits:
                return hits
        return []

    def _learn(self, words: set[str]) -> None:
        """Score unseen words, all at once, and give each a row of the table."""
        new = [w for w in words if w not in self.words and w not in self.seen]
        if len(self.seen) + len(new) > CACHE_WORDS:
            self.seen, self.table = {}, self.logs
            new = [w for w in words if w not in self.words]
        if not new:
            return
        rows = [self._backoff(w) for w in new]
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        flat = np.fromiter((g for r in rows for g in r), dtype=np.int64, count=int(sizes.sum()))
        scores = np.zeros((len(new), len(self.languages)), dtype=np.float32)
        np.add.at(scores, np.repeat(np.arange(len(new)), sizes), self.logs[flat])
        scores /= np.maximum(sizes, 1)[:, None]
        first = len(self.table)
        self.table = np.vstack([self.table, scores])
        self.seen.update((w, first + i) for i, w in enumerate(new))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        words = [_WORD.findall(t.lower()) for t in texts]
        words = [w if any(c.isalpha() for x in w for c in x) else [] for w in words]
        self._learn({x for w in words for x in w})
        known, seen = self.words, self.seen
        out = []
        for w in words:
            if not w:
                out.append((UNKNOWN, 0.0))
                continue
            rows = np.fromiter((known[x] if x in known else seen[x] for x in w), dtype=np.int64, count=len(w))
            total = self.table[rows].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            out.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from text and non-null language of the rows that aren't held out."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~is_held_out(F.col(id_col))).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    sizes = F.broadcast(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    share = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.join(sizes, "lang").filter(share * F.col("n") < F.lit(TRAIN_DOCS))
    words = cut(sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
                .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(NGRAM)), lambda n: F.transform(
        F.when(F.char_length(padded) >= n, F.sequence(F.lit(1), F.char_length(padded) - n + 1)).otherwise(F.array().cast("array<int>")),
        lambda i: padded.substr(i, n))))
    counted = words.select("lang", "n", F.explode(grams).alias("word")).groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def top(table, limit, least):
        best = table.groupBy("word").agg(F.sum("n").alias("total")).filter(F.col("total") >= least).orderBy(F.desc("total"), "word").limit(limit)
        return table.join(best, "word").select("word", "lang", "n").collect()

    sums = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    word_rows, gram_rows = top(words, WORDS, 2), top(counted, GRAMS, 2)
    languages = sorted(sums, key=lambda x: (-sums[x], x))
    place = {lang: i for i, lang in enumerate(languages)}
    tables, index = [], []
    for found, sized in ((word_rows, lambda w: 0), (gram_rows, len)):
        names = {w: i for i, w in enumerate(dict.fromkeys(sorted(r["word"] for r in found)))}
        n = np.zeros((len(names), len(languages)))
        for r in found:
            n[names[r["word"]], place[r["lang"]]] = r["n"]
        logs = np.zeros_like(n)
        kinds = np.array([sized(w) for w in names], dtype=np.int64)  # n-grams of a length are one distribution
        for kind in set(kinds.tolist()):
            at = kinds == kind
            logs[at] = np.log((n[at] + 0.1) / (n[at].sum(axis=0) + 0.1 * at.sum()))
        tables.append(logs)
        index.append(names)
    shift = len(index[0])
    return LanguageModel(languages, index[0], {g: i + shift for g, i in index[1].items()},
                         np.vstack(tables).astype(np.float32).reshape(-1, max(1, len(languages))))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    A null text, or one without a letter, is `und` with score 0, as is every text
    if nothing could be learned; a text none of whose parts is known goes to the most
    frequent language, ties to the more frequent one. Repeated rows and null ids are
    predicted row by row; an empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_group(texts):
        found = shared.value.predict(texts)
        return {"lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([x if math.isfinite(x) else 0.0 for _, x in found], pa.float64())}

    return map_texts(id_and_text(docs, id_col, text_col), per_group, "lang_pred string; score double")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`docs`, all columns, with the identified language in `lang_col` (a string), and
    without the rows whose language can't be told: null texts and those without a letter.
    A text with a letter stays even if nothing could be learned, or if `und` is one of
    the labels; it keeps its label if the prediction is `und`."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col))
    typed = docs.withColumn(lang_col, F.col(lang_col).cast("string")).select(*docs.columns)
    place = docs.columns.index(lang_col)

    def keep(batches):
        for batch in batches:
            named = pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(text_col)], names=["doc_id", "text"])
            told = [(x, x != UNKNOWN or has_letter(t)) for _, texts in text_groups(named)
                    for t, (x, _) in zip(texts, shared.value.predict(texts), strict=True)]
            labels = batch.column(lang_col).to_pylist()
            found = pa.array([old if x == UNKNOWN else x for old, (x, _) in zip(labels, told, strict=True)], pa.string())
            yield batch.set_column(place, lang_col, found).filter(pa.array([k for _, k in told], pa.bool_()))

    return typed.mapInArrow(keep, typed.schema)
