"""Token counts by rank-synchronous array merging (operator 3).

A group's distinct pre-tokens are laid out as one ragged numpy array of symbol
ids. Each round looks up the rank of every adjacent pair, finds the lowest rank
of each sequence with a segmented minimum and applies that pair everywhere in
the sequence at once; what survives is counted. Finished sequences leave the
arrays. Merging all places of a pair at once equals merging them one by one
from the left unless a merge can create a pair of lower rank; the pieces for
which the vocabulary allows that are merged one place a round. A pre-token of
over LONG characters (no space for that long) would need about as many rounds as
it has characters: it is merged in the same order with a heap instead.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import id_and_text, map_texts
from wattline.llm.pieces import SPACE, Vocab, pretokens, read_model, run_and_core, vocab

_NONE = np.iinfo(np.int64).max
#: Bytes of pre-tokens and counts that a worker remembers, estimated; the longest one that
#: it does, in characters; and characters merged in one go.
CACHE_BYTES, CACHE_LONGEST, MERGE_CHARS = 80 << 20, 64, 1_000_000
#: Longest stretch, in characters, that goes into the arrays: their rounds are as many as
#: a stretch has different merges.
LONG = 2048


class RankMerger:
    def __init__(self, v: Vocab):
        self.v, n = v, len(v.rank)
        pairs = {}
        for piece, rank in v.rank.items():
            for i in range(1, len(piece)):
                a, b = v.rank.get(piece[:i]), v.rank.get(piece[i:])
                if a is not None and b is not None:
                    pairs[a * n + b] = rank
        self.n = n
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        # A symbol is the rank of its piece, so a pair's rank is also its product.
        self.one_by_one = np.zeros(n, dtype=bool)
        for side in (self.keys // n, self.keys % n):
            self.one_by_one[side[self.made < side]] = True
        self.counts: dict[str, int] = {}
        self.held = 0
        #: characters that stand side by side in a piece; no merge crosses other places
        self.side = {piece[i:i + 2] for piece in v.rank for i in range(len(piece) - 1)}

    def stretches(self, word: str) -> list[str]:
        """A word cut where no piece holds both neighbours: its merges are those of the parts."""
        at = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.side), len(word)]
        return [word[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _ranks(self, sym: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place; _NONE where there is none."""
        out = np.full(len(sym), _NONE, dtype=np.int64)
        left = np.flatnonzero(~last & (sym >= 0))
        left = left[sym[left + 1] >= 0]
        key = sym[left] * self.n + sym[left + 1]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[left[hit]] = self.made[at[hit]]
        return out

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that survive in each word (non-empty, at most one space mark),
        and whether the first of them is the space mark alone."""
        total = np.zeros(len(words), dtype=np.int64)
        alone = np.zeros(len(words), dtype=bool)
        if not words:
            return total, alone
        chars = "".join(words)
        points = np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32)
        known, where = np.unique(points, return_inverse=True)
        sym = np.array([self.v.rank.get(chr(c), -1) for c in known.tolist()], dtype=np.int64)[where]
        # An unknown character falls back to its UTF-8 bytes.
        extra = np.where(points < 0x80, 0, np.where(points < 0x800, 1, np.where(points < 0x10000, 2, 3)))
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        seq = np.repeat(np.arange(len(words)), lengths)
        np.add.at(total, seq[sym < 0], extra[sym < 0])
        while len(sym):
            last = np.append(seq[1:] != seq[:-1], True)
            first = np.flatnonzero(np.append(True, last[:-1]))
            rank = self._ranks(sym, last)
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            done = low == _NONE
            total[seq[first[done]]] += size[done]
            alone[seq[first[done]]] = sym[first[done]] == self.v.rank[SPACE]
            best = np.repeat(low, size)
            pick = (rank == best) & (best != _NONE)
            # A place that overlaps its predecessor's merge is skipped: every second of a run.
            at = np.flatnonzero(pick)
            head = np.append(True, np.diff(at) != 1) if len(at) else np.zeros(0, dtype=bool)
            start = np.maximum.accumulate(np.where(head, at, 0)) if len(at) else at
            at = at[(at - start) % 2 == 0]
            new = np.append(True, seq[at][1:] != seq[at][:-1]) if len(at) else np.zeros(0, dtype=bool)
            at = at[new | ~self.one_by_one[rank[at]]]
            sym[at] = rank[at]
            keep = np.repeat(~done, size)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return total, alone

    def merge_long(self, word: str) -> tuple[int, bool]:
        """merge() of one word, by a heap of pairs."""
        rank, n = self.v.rank, len(word)
        sym: list[str] = [*word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(word[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if not sym[i] or j >= n or len(sym[i]) + len(sym[j]) != size:
                continue  # one of the two has been merged since
            sym[i], sym[j], after[i] = sym[i] + sym[j], "", after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank.get(sym[a] + sym[b])) is not None:
                    heappush(heap, (r, a, len(sym[a]) + len(sym[b])))
        left = [s for s in sym if s]
        return sum(1 if s in rank else len(s.encode()) for s in left), left[0] == SPACE

    def count(self, pre: list[str]) -> int:
        get = self.counts.__getitem__
        return sum(map(get, pre))

    def learn(self, words: set[str]) -> None:
        """Count the words not met before, a bounded number of characters at a time."""
        if self.held > CACHE_BYTES:
            self.counts, self.held = {}, 0
        new = [w for w in words if w not in self.counts]
        at = 0
        while at < len(new):
            end, chars = at, 0
            while end < len(new) and (end == at or chars + len(new[end]) <= MERGE_CHARS):
                chars += len(new[end])
                end += 1
            part = [run_and_core(w) for w in new[at:end]]
            pieces = [self.stretches(c) if c else [] for _, c in part]
            flat = [x for some in pieces for x in some]
            counts, alone = self.merge([x for x in flat if len(x) <= LONG])
            short = zip(counts.tolist(), alone.tolist(), strict=True)
            merged = (next(short) if len(x) <= LONG else self.merge_long(x) for x in flat)
            for word, (run, _), some in zip(new[at:end], part, pieces, strict=True):
                n, free = 0, False
                for i in range(len(some)):
                    size, first = next(merged)
                    n, free = n + size, first if i == 0 else free
                if run and free:  # the word left its space mark alone: it joins the run
                    run, n = run + 1, n - 1
                self.counts[word] = n + len(self.v.run_ids(run))
                self.held += 150 + 4 * len(word)
            at = end

    def forget_long(self, words: set[str]) -> None:
        """Long pre-tokens are remembered for one group of texts only."""
        for w in words:
            if len(w) > CACHE_LONGEST and self.counts.pop(w, None) is not None:
                self.held -= 150 + 4 * len(w)


@lru_cache(maxsize=2)
def merger(model: bytes) -> RankMerger:
    """One merger per worker process."""
    return RankMerger(vocab(model))


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    A null or empty text has 0 bytes and 0 tokens; repeated rows and null ids are
    counted row by row; an empty table gives no rows; columns other than the two
    named are ignored, whatever their names. The result has no begin, end or
    added special ids.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def per_group(texts):
        m = merger(model.value)
        words = [list(pretokens(t)) for t in texts]
        distinct = {w for lists in words for pre in lists for w in pre}
        m.learn(distinct)
        totals = [sum(m.count(pre) for pre in lists) for lists in words]
        m.forget_long(distinct)
        return {"n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(totals, pa.int64())}

    out = map_texts(id_and_text(docs, id_col, text_col), per_group, "n_bytes long; n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
