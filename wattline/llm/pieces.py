"""Vocabulary of a SentencePiece merge-type (BPE) model, as used by the token
counter and the codec.

The model file is read once on the driver (half a megabyte) and broadcast, so
executors need no local copy of it. Only models with the identity normaliser, a
dummy prefix, byte fallback and unique merge scores outside runs of the space
mark are accepted; anything else raises ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

SPACE = "▁"
#: A run of space marks with the text up to the next one; no piece has a mark
#: after another character, so no merge crosses such a boundary.
PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_SLICE = 1 << 20


class Vocab:
    """rank: piece -> merge order (low first), without the runs of space marks."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if (proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback
                or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces):
            raise ValueError("only BPE models with byte fallback, identity normaliser and dummy prefix are supported")
        sp = SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(self.size)]
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) or proto.pieces[i].type == 4 for i in range(self.size)):
            raise ValueError("unused and user-defined pieces are not supported")
        self.unknown_id, self.unknown = sp.unk_id(), proto.trainer_spec.unk_surface
        self.control = {i for i in special if i not in set(self.byte_id)}
        normal = [i for i in range(self.size) if i not in special]
        #: length of a run of space marks -> id
        self.runs = {len(self.piece[i]): i for i in normal if not self.piece[i].strip(SPACE)}
        words = [i for i in normal if self.piece[i].strip(SPACE) or len(self.piece[i]) == 1]
        score = {i: sp.get_score(i) for i in words}
        merged = [score[i] for i in words if len(self.piece[i]) > 1]
        low = {sp.get_score(i) for n, i in self.runs.items() if n > 1}
        if 1 not in self.runs or len(set(merged)) != len(merged) or len(low) > 1 or any(s <= x for s in merged for x in low):
            raise ValueError("merge scores must be unique, and runs of the space mark share the lowest")
        if any(SPACE in self.piece[i].lstrip(SPACE) or self.piece[i].startswith(SPACE * 2) for i in words):
            raise ValueError("a piece has a space mark after its first character")
        order = sorted(words, key=lambda i: -score[i])
        self.rank = {self.piece[i]: r for r, i in enumerate(order)}
        self.id_of = {self.piece[i]: i for i in words}

    def run_ids(self, n: int) -> list[int]:
        """Ids of n space marks that no other merge has taken. Their merges have
        equal scores, so the library takes the leftmost possible one each time."""
        settled: list[int] = []
        while n:
            now, n = 1, n - 1
            while True:
                if settled and settled[-1] + now in self.runs:
                    now += settled.pop()
                elif n and now + 1 in self.runs:
                    now, n = now + 1, n - 1
                else:
                    break
            settled.append(now)
        return [self.runs[k] for k in settled]


@lru_cache(maxsize=2)
def vocab(model: bytes) -> Vocab:
    """One vocabulary per worker process."""
    return Vocab(model)


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str | None) -> bytes:
    with open(path or default_model_path(), "rb") as f:
        return f.read()


def pretokens(text: str) -> Iterator[list[str]]:
    """Lists of pre-tokens of a text, about a megabyte at a time."""
    if not text:
        return
    text = SPACE + text.replace(" ", SPACE)
    at = 0
    while len(text) - at > _SLICE:
        end = text.find(SPACE, at + _SLICE)
        while end > 0 and text[end - 1] == SPACE:  # never inside a run
            end = text.find(SPACE, end + 1)
        if end < 0:
            break
        yield PRETOKEN.findall(text, at, end)
        at = end
    yield PRETOKEN.findall(text, at)


def run_and_core(pretoken: str) -> tuple[int, str]:
    """Space marks in front that can't take part in a word's merges, and the
    rest: at most one mark and the word."""
    core = pretoken.lstrip(SPACE)
    n = len(pretoken) - len(core)
    return (n, "") if not core else (0, core) if n == 0 else (n - 1, SPACE + core)
