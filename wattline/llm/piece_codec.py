"""SentencePiece encoding and decoding by backtracking (operator 8).

For a merge-type vocabulary, a cover of a word by pieces is the library's
encoding exactly if each two adjacent pieces are compatible: re-merging their
joint text from single characters gives those two pieces again. The encoder
takes the longest piece at each place (found by Aho-Corasick over the whole
word), checks it against the piece before, tries shorter ones, and steps back
when none fits; a bitfield of places from which no cover exists keeps it
linear. Characters outside the vocabulary fall back to their UTF-8 bytes and
merge with nothing, so they end a stretch.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import id_and_text, map_texts, small_batches, text_groups
from wattline.llm.pieces import SPACE, Vocab, pretokens, read_model, run_and_core, vocab

#: Bytes of pre-tokens with their ids (twice as many) that a worker remembers, estimated;
#: the longest one that it does, in characters; and piece pairs.
CACHE_BYTES, CACHE_LONGEST, CACHE_PAIRS = 80 << 20, 64, 400_000


class PieceCodec:
    def __init__(self, v: Vocab):
        self.v = v
        #: pieces that re-merge to themselves; no other one can stand in an encoding
        self.whole = {p for p in v.rank if self.remerge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.whole:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.text = [p.replace(SPACE, " ") for p in v.piece]
        for i in v.control:
            self.text[i] = v.unknown if i == v.unknown_id else ""
        self.byte_of = {i: b for b, i in enumerate(v.byte_id)}
        for i, b in self.byte_of.items():
            self.text[i] = chr(b) if b < 0x80 else ""
        self.high = {i for i, b in self.byte_of.items() if b >= 0x80}

    # -- encoding

    def remerge(self, text: str) -> list[str]:
        """Pieces of a short text, merging the pair of lowest rank first."""
        symbols, rank = [*text], self.v.rank
        while len(symbols) > 1:
            low, at = min((rank.get(a + b, self.v.size), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)))
            if low == self.v.size:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        ok = self.fits[left, right] = self.remerge(left + right) == [left, right]
        return ok

    def cover(self, word: str, longest: list[int]) -> list[str]:
        """Pieces of a word, all of whose characters are pieces."""
        whole, fits, pieces = self.whole, self.fits, []
        failed = 0  # bit n: word[n:] has no cover after any piece tried before it
        at, end, size, before = 0, len(word), longest[0], ""
        while at < end:
            while size:
                piece = word[at:at + size]
                if piece in whole and not failed >> (at + size) & 1:
                    if not before:
                        break
                    ok = fits.get((before, piece))
                    if ok or ok is None and self.compatible(before, piece):
                        break
                size -= 1
            if size:
                pieces.append(piece)
                before = piece
                at += size
                size = longest[at] if at < end else 0
            else:
                failed |= 1 << at
                size = len(pieces.pop())
                at -= size
                before = pieces[-1] if pieces else ""
        return pieces

    def encode_core(self, word: str) -> list[int]:
        """Ids of a word with at most one space mark, at its start."""
        longest = [0] * len(word)
        for stop, size in self.automaton.iter(word):
            longest[stop - size + 1] = size  # of those that begin here, longer ones end later
        id_of = self.v.id_of
        if 0 not in longest:
            return [id_of[p] for p in self.cover(word, longest)]
        ids, begin = [], 0
        for unknown, part in groupby(range(len(word)), lambda i: not longest[i] and word[i] not in self.whole):
            begin, end = (n := [*part])[0], n[-1] + 1
            if unknown:
                ids += [self.v.byte_id[b] for b in word[begin:end].encode()]
            else:
                ids += [id_of[p] for p in self.cover(word[begin:end], longest[begin:end])]
        return ids

    def encode_word(self, pretoken: str) -> tuple[int, ...]:
        run, core = run_and_core(pretoken)
        ids = self.encode_core(core) if core else []
        if run and ids and ids[0] == self.v.id_of[SPACE]:  # left alone, the mark joins the run
            run, ids = run + 1, ids[1:]
        return (*self.v.run_ids(run), *ids)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for pre in pretokens(text):
            new = set(pre).difference(self.words)
            if new and self.held > CACHE_BYTES:
                self.older, self.words, self.held, new = self.words, {}, 0, set(pre)
            long: dict[str, tuple[int, ...]] = {}  # kept for this list only
            for w in new:
                if len(w) > CACHE_LONGEST:
                    long[w] = self.encode_word(w)
                    continue
                ids = self.words[w] = self.older.get(w) or self.encode_word(w)
                self.held += 200 + 4 * len(w) + 8 * len(ids)
            words = self.words if not long else ChainMap(long, self.words)
            out.extend(chain.from_iterable(map(words.__getitem__, pre)))
        return out

    # -- decoding

    def decode(self, ids: list[int]) -> str:
        """Text of ids; like the library, without the leading space of the dummy
        prefix, control ids as nothing, malformed bytes as U+FFFD each."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.text.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for i in ids:
                if (b := self.byte_of.get(i)) is not None:
                    run.append(b)
                    continue
                if run:
                    parts.append(_from_bytes(bytes(run)))
                    run.clear()
                parts.append(self.text[i])
            text = "".join(parts) + _from_bytes(bytes(run))
        first = next((i for i in ids if i not in self.v.control or i == self.v.unknown_id), None)
        return text[1:] if first is not None and self.v.piece[first].startswith(SPACE) else text


def _from_bytes(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[i:i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes) -> PieceCodec:
    """One codec per worker process."""
    return PieceCodec(vocab(model))


def _lists(rows: list[list[int]]) -> pa.Array:
    flat = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=sum(map(len, rows)))
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, as the library encodes it
    without begin or end ids and without sampling.

    A null or empty text gives an empty array; repeated rows and null ids are
    encoded row by row; an empty table gives no rows; columns other than the two
    named are ignored, whatever their names.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def per_group(texts):
        return {"ids": _lists([codec(model.value).encode(t) for t in texts])}

    return map_texts(id_and_text(docs, id_col, text_col), per_group, "ids array<int>")


def decode(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of rows of ids; null or empty ids give an empty text."""
    small_batches(encoded.sparkSession)
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            texts = [codec(model.value).decode(ids[i].values.tolist()) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")


def encode_decode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): encode(), then decode() of those ids, in one pass over
    the batches, so that the ids don't cross into the JVM and back."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model.value)
        for batch in batches:
            for doc_ids, texts in text_groups(batch):
                rows = [c.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays([doc_ids, _lists(rows), pa.array([c.decode(r) for r in rows], pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, text string")
