"""Operators 3 and 8 against the sentencepiece library."""
import random

import pytest

from wattline.llm import piece_codec as C
from wattline.llm import token_count as T
from wattline.llm.pieces import default_model_path, pretokens, read_model


@pytest.fixture(scope="module")
def model():
    return read_model(None)


@pytest.fixture(scope="module")
def library(model):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_proto=model)


def texts(n, seed):
    rng = random.Random(seed)
    alphabet = " ▁  abcdetnhi\n\t0=éß\U0001f600漢字ー​\x00Ａ"
    for k in range(n):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if k % 3 == 0:
            t = " " * rng.randint(0, 70) + t
        if k % 5 == 0:
            t = "a" * rng.randint(0, 30) + rng.choice(["an", "ha", "the"]) * rng.randint(0, 20) + t
        if k % 7 == 0:
            t = "".join(rng.choice("etaonihsrdl") for _ in range(rng.randint(0, 700)))
        yield t


def count(m, text):
    pre = list(pretokens(text))
    m.learn({w for part in pre for w in part})
    return sum(m.count(part) for part in pre)


def test_counts_equal_library(model, library):
    m = T.merger(model)
    for t in texts(3000, 1):
        assert count(m, t) == len(library.encode(t)), repr(t)


def test_ids_and_decoding_equal_library(model, library):
    c = C.codec(model)
    for t in texts(3000, 2):
        ids = library.encode(t)
        assert c.encode(t) == ids, repr(t)
        assert c.decode(ids) == library.decode(ids)


def test_decoding_of_any_ids_equals_library(model, library):
    rng, c = random.Random(3), C.codec(model)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(0, 300), rng.randint(3, 258), 28705]) for _ in range(rng.randint(0, 8))]
        assert c.decode(ids) == library.decode(ids), ids


def test_long_words_and_runs(model, library):
    rng = random.Random(4)
    for t in ["".join(rng.choice("etaoinshrdlu") for _ in range(20_000)), " " * 5000 + "x", "ab" * 4000, "漢" * 3000, "a " * 600_000]:
        assert count(T.merger(model), t) == len(library.encode(t))
        assert C.codec(model).encode(t) == library.encode(t)


def test_small_caches_change_nothing(model, library, monkeypatch):
    monkeypatch.setattr(C, "CACHE_BYTES", 1000)
    monkeypatch.setattr(C, "CACHE_LONGEST", 8)
    monkeypatch.setattr(C, "CACHE_PAIRS", 5)
    monkeypatch.setattr(T, "CACHE_BYTES", 1000)
    monkeypatch.setattr(T, "CACHE_LONGEST", 8)
    monkeypatch.setattr(T, "MERGE_CHARS", 7)
    c, m = C.PieceCodec(C.vocab(model)), T.RankMerger(T.vocab(model))
    for t in texts(300, 5):
        assert c.encode(t) == library.encode(t) and count(m, t) == len(library.encode(t))


def test_operators_on_odd_rows(spark, table, odd_rows, library):
    docs = table(odd_rows)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in T.count_tokens(docs, default_model_path()).collect())
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in odd_rows)
    assert got == want
    rows = C.encode_decode(docs).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in rows) == sorted(
        (str(i), ids := library.encode(t or ""), library.decode(ids)) for i, t in odd_rows)
    twice = C.decode(C.encode(docs)).collect()
    assert sorted(map(str, twice)) == sorted(map(str, rows))
    assert T.count_tokens(table([])).count() == 0 and C.encode(table([])).count() == 0


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        C.vocab(b"not a model")
