"""Toxicity by a weighted lexicon (operator 6).

Texts are folded (lower case, look-alike letters, digits and signs used as letters,
accents, invisible characters), then one Aho-Corasick automaton finds the lexicon's
entries: whole words, and word beginnings (written `stem*`). A match inside an
exception phrase doesn't count. The sum of the weights, divided by the square root
of the length, against a threshold gives the score.

The lexicon is learned from a bounded sample of labelled documents: Spark counts
words and stems per class, and entries are chosen greedily until each toxic document
that can be covered is, then a few times more by entries whose log odds are sure, so
that words which only happen to stand in copied toxic documents stay out.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import cut, id_and_text, is_held_out, map_texts

#: Bounds of the training sample (documents of each class), of the candidates and the lexicon.
TRAIN_TOXIC, TRAIN_CLEAN, CANDIDATES, ENTRIES = 4000, 8000, 20_000, 500
#: Least log odds of an entry, and toxic documents it stands in, whatever the sample's size;
#: covers wanted of a toxic document; stem lengths.
LEAST_WEIGHT, LEAST_TOXIC, COVERS, STEMS = 2.0, 2, 3, (4, 5, 6)
#: Standard errors by which the log odds of an entry for a further cover exceed 0.
SURE = 2.0
#: Words that may turn into candidates by their exception phrases.
DOUBTFUL = 2000

# Signs and letters that stand for Latin letters. i, l and 1 are one.
_LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i",
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g", "ʟ": "i",
}


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(k): v for k, v in _LOOKALIKES.items()}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(c)).lower() if not unicodedata.combining(x))
        if base != chr(c) and len(base) == 1:
            table[c] = _LOOKALIKES.get(base, base)
    for c in [0xAD, *range(0x300, 0x370), *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFE0E, 0xFE0F, 0xFEFF]:
        table[c] = None
    return table


_FOLD = _fold_table()
_WORD = re.compile(r"[^\W\d_]+")


#: Signs that also end a sentence or a cell stand for letters only before one.
_END = re.compile(r"[!|](?!\w)")


def fold(text: str) -> str:
    if "!" in text or "|" in text:
        text = _END.sub(" ", text)
    return text.lower().translate(_FOLD)


def _phrases(folded: str, start: int, end: int) -> list[str]:
    """The word at start:end with the word before it, and with the one after it."""
    before, after = re.search(r"([^\W\d_]+) $", folded[max(0, start - 40):start]), re.match(r" ([^\W\d_]+)", folded[end:end + 40])
    return ([f"{before[1]} {folded[start:end]}"] if before else []) + ([f"{folded[start:end]} {after[1]}"] if after else [])


def _entries(word: str) -> list[str]:
    """Lexicon entries that a folded word can match."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


@dataclass
class Lexicon:
    """weights: entry -> log odds; exceptions: folded phrases of words one space apart."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    threshold: float = 1.0
    _automaton: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self):
        return (self.weights, self.exceptions, self.threshold)

    def __setstate__(self, state):
        self.__init__(*state)

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries found: of those at one word, the
        heaviest; none inside an exception phrase."""
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for entry, w in self.weights.items():
                text = entry.rstrip("*")
                a.add_word(text, [*a.get(text, []), (len(text), entry.endswith("*"), w)])
            for phrase in self.exceptions:
                a.add_word(phrase, [*a.get(phrase, []), (len(phrase), False, None)])
            a.make_automaton()
            self._automaton = a
        if not len(self._automaton):
            return []
        found: dict[int, tuple[int, float]] = {}
        spared, n = [], len(folded)
        for last, entries in self._automaton.iter(folded):
            for size, stem, w in entries:
                start, end = last - size + 1, last + 1
                if start and folded[start - 1].isalpha() or end < n and folded[end].isalpha() and not stem:
                    continue
                if w is None:
                    spared.append((start, end))
                elif start not in found or w > found[start][1]:
                    found[start] = (end, w)
        return [(s, e, w) for s, (e, w) in sorted(found.items()) if not any(a <= s < b for a, b in spared)]

    def density(self, text: str) -> float:
        """Summed weights over the square root of the length in units of 100 characters."""
        folded = fold(text)
        return sum(w for _, _, w in self.hits(folded)) / math.sqrt(max(1.0, len(folded) / 100))

    def score(self, text: str) -> float:
        x = 4 * (self.density(text) / self.threshold - 1)
        return 1 / (1 + math.exp(-x)) if x < 700 else 1.0

    def phrases(self, text: str) -> set[str]:
        """Each hit's whole word with each of its neighbours."""
        folded = fold(text)
        words = (_WORD.match(folded, s) for s, _, _ in self.hits(folded))
        return {p for m in words if m for p in _phrases(folded, m.start(), m.end())}


def _is_sure(weight: float, bad: float, good: float) -> bool:
    return weight >= SURE * math.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))


def _greedy(docs: list[list[list[int]]], weight: list[float], sure: list[bool]) -> list[int]:
    """Candidates chosen one by one. docs: per toxic document, per word, the candidates
    that match it. Each choice covers most words, at one word a document, weighed by log
    odds: first in documents without a covered word, until none of them can be covered;
    then, `sure` candidates that cover two or more, in those with one, and so on to COVERS."""
    open_words = [list(words) for words in docs]
    covered = [0] * len(docs)
    having: dict[int, list[int]] = {}
    for d, words in enumerate(docs):
        for x in {x for w in words for x in w}:
            having.setdefault(x, []).append(d)
    chosen: list[int] = []
    for want in range(1, COVERS + 1):
        gain: Counter = Counter()
        for words, c in zip(open_words, covered, strict=True):
            if c < want:
                gain.update({x for w in words for x in w if want == 1 or sure[x]})
        while len(chosen) < ENTRIES:
            best = max(gain, key=lambda x: (gain[x] * weight[x], -x), default=None)
            if best is None or gain[best] < min(want, 2):
                break
            chosen.append(best)
            for d in having[best]:
                rest = [w for w in open_words[d] if best not in w]
                if len(rest) == len(open_words[d]):
                    continue
                if covered[d] < want:
                    before = {x for w in open_words[d] for x in w}
                    covered[d] += 1
                    gain.subtract(before - {x for w in rest for x in w} if covered[d] < want else before)
                else:
                    covered[d] += 1
                open_words[d] = rest
    return chosen


def _with_exceptions(sample: DataFrame, known: DataFrame, candidates: list[tuple[str, float, bool]], n_toxic: int, n_clean: int):
    """Candidates and, per word, its harmless phrases. A word of the toxic documents that
    clean ones use mostly in the same few phrases, never found in toxic ones, is a
    candidate without them."""
    doubtful = (known.filter((F.col("weight") > 0) & (F.col("weight") < LEAST_WEIGHT) & ~F.col("entry").endswith("*"))
                .orderBy(F.desc(F.col("weight") * F.col("bad")), "entry").limit(DOUBTFUL).collect())
    good = {r["entry"]: (r["bad"], r["good"]) for r in doubtful}
    if not good:
        return candidates, {}
    shared = sample.sparkSession.sparkContext.broadcast(frozenset(good))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                folded = fold(t)
                counts.update({(m[0], p, toxic) for m in _WORD.finditer(folded) if m[0] in shared.value for p in _phrases(folded, m.start(), m.end())})
            columns = [pa.array([k[i] for k in counts], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], names=["entry", "phrase", "toxic", "n"])

    phrases = (sample.select("text", "toxic").mapInArrow(run, "entry string, phrase string, toxic int, n long").groupBy("entry", "phrase")
               .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
               .filter("bad = 0 and good >= 3").join(known.select("entry", F.col("good").alias("all_good")), "entry")
               .filter(F.col("good") >= F.col("all_good") / 4).select("entry", "phrase", "good").collect())  # at most 8 for each doubtful word
    harmless: dict[str, list[str]] = {}
    spared: Counter = Counter()
    for r in phrases:
        harmless.setdefault(r["entry"], []).append(r["phrase"])
        spared[r["entry"]] += r["good"]
    for entry in sorted(harmless):
        bad, all_good = good[entry]
        rest = max(0, all_good - spared[entry])
        weight = math.log((bad + 0.5) / (n_toxic + 1)) - math.log((rest + 0.5) / (n_clean + 1))
        if weight >= LEAST_WEIGHT:
            candidates.append((entry, weight, _is_sure(weight, bad, rest)))
    return candidates, harmless


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """Learn from the labelled rows that aren't held out; without a toxic or a clean
    one the lexicon is empty and every score 0 or next to it."""
    marks = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))

    def some(toxic: int, n: int) -> DataFrame:
        return marks.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    chosen = some(1, TRAIN_TOXIC).union(some(0, TRAIN_CLEAN))  # ids, of a fixed bound
    texts = id_and_text(docs, id_col, text_col)
    sample = cut(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic].update({e for w in set(_WORD.findall(fold(t))) for e in _entries(w)})
            for toxic in (0, 1):
                yield pa.RecordBatch.from_arrays([pa.array(counts[toxic].keys(), pa.string()), pa.array([toxic] * len(counts[toxic]), pa.int32()),
                                                  pa.array(counts[toxic].values(), pa.int64())], names=["entry", "toxic", "n"])

    counted = sample.mapInArrow(count, "entry string, toxic int, n long").groupBy("entry").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    counted = cut(counted)
    odds = F.log((F.col("bad") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(n_clean + 1.0))
    known = counted.withColumn("weight", odds).filter(F.col("bad") >= LEAST_TOXIC)
    candidates = (known.filter(F.col("weight") >= LEAST_WEIGHT)
                  .orderBy(F.desc(F.col("weight") * F.col("bad")), "entry").limit(CANDIDATES).select("entry", "weight", "bad", "good").collect())
    candidates = [(r["entry"], r["weight"], _is_sure(r["weight"], r["bad"], r["good"])) for r in candidates]
    candidates, harmless = _with_exceptions(sample, known, candidates, n_toxic, n_clean)
    number = {entry: i for i, (entry, *_) in enumerate(candidates)}
    weight, sure = [w for _, w, _ in candidates], [x for *_, x in candidates]
    shared = sample.sparkSession.sparkContext.broadcast(number)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            rows = []
            for t in batch.column("text").to_pylist():
                words = ([number[e] for e in _entries(w) if e in number] for w in sorted(set(_WORD.findall(fold(t)))))
                rows.append([w for w in words if w])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.list_(pa.int32())))], names=["words"])

    found = sample.filter("toxic = 1").select("doc_id", "text").mapInArrow(matched, "words array<array<int>>").collect()
    chosen = _greedy(sorted(r["words"] for r in found), weight, sure)
    entries = {candidates[i][0]: weight[i] for i in chosen}
    lexicon = Lexicon(entries, tuple(sorted(p for e in entries for p in harmless.get(e, ()))))

    def judged(lexicon: Lexicon):
        model = sample.sparkSession.sparkContext.broadcast(lexicon)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([model.value.density(t) for t in texts], pa.float64()),
                                                  pa.array([sorted(model.value.phrases(t)) for t in texts], pa.list_(pa.string()))],
                                                 names=["toxic", "density", "phrases"])

        return sample.mapInArrow(run, "toxic int, density double, phrases array<string>").collect()

    rows = judged(lexicon)
    clean, bad = (Counter(p for r in rows if r["toxic"] == t for p in r["phrases"]) for t in (0, 1))
    more = {p for p, n in clean.items() if n >= 2 and p not in bad}
    if more:
        lexicon = Lexicon(entries, tuple(sorted(more.union(lexicon.exceptions))))
        rows = judged(lexicon)
    # The threshold with the fewest errors; of equal ones, the middle of the widest gap.
    points = sorted((r["density"], r["toxic"]) for r in rows)
    wrong, best = n_clean, []
    for i, (x, toxic) in enumerate(points):
        wrong += 1 if toxic else -1
        above = points[i + 1][0] if i + 1 < len(points) else x + 1
        if above > x:
            best.append((wrong, x - above, (x + above) / 2))
    lexicon.threshold = max(min(best)[2], 1e-6)
    return Lexicon(lexicon.weights, lexicon.exceptions, lexicon.threshold)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text; predicted is 1 from 0.5 on.

    A null or empty text has no hit and the least score; repeated rows and null ids
    are scored row by row; an empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def per_group(texts):
        return {"score": pa.array([shared.value.score(t) for t in texts], pa.float64())}

    scored = map_texts(id_and_text(docs, id_col, text_col), per_group, "score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
