import random
import re
from collections import Counter

import numpy as np

from wattline.llm import phrases


def plain(rows, max_words=3, min_count=10, top=2000, absorbed=50):
    """The contract with Python dictionaries and integers."""
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    count[lang, tuple(words[i:i + m])] += 1
    found = {g: a for g, a in count.items() if len(g[1]) > 1 and a >= min_count}
    around = {}
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                part = lang, w[i:i + m]
                around[part] = max(a, around.get(part, 0))
    rows = {}
    for (lang, w), a in found.items():
        if 100 * around.get((lang, w), -1) >= absorbed * a:
            continue
        score, k = min((10 ** 6 * a * a // (count[lang, w[:k]] * count[lang, w[k:]]), k) for k in range(1, len(w)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]]))
    return {(lang, i + 1, p.decode(), -a, le, r, total[lang], -s) for lang, some in rows.items() for i, (s, a, p, le, r) in enumerate(sorted(some)[:top])}


def found(df):
    rows = [(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "漢字", "a-b", "x"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "! "]
    return [("".join(rng.choice(words) + rng.choices(ends, [9, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und"]))
            for _ in range(n)]


def test_equals_dictionaries(spark, table):
    rows = made(200, 3)
    docs = table([(i, t, lang, None) for i, (t, lang) in enumerate(rows)])
    assert found(phrases.collocations(docs)) == plain(rows)
    assert found(phrases.collocations(docs, max_words=4, min_count=3, top=7, absorbed=80)) == plain(rows, 4, 3, 7, 80)


def test_full_bit_sets_change_nothing(spark, table):
    rows = made(120, 4)
    docs = table([(i, t, lang, None) for i, (t, lang) in enumerate(rows)])
    assert found(phrases.collocations(docs, bits=3)) == plain(rows)


def test_words_with_one_fingerprint_are_told_apart():
    chunk = phrases.Chunk([("en", b"aa bb aa cc bb"), ("fr", b"aa zz")])
    right = chunk.word_ids()
    chunk.word[:] = 7
    forced = chunk.word_ids()
    assert len(set(zip(right.tolist(), forced.tolist()))) == len(set(forced.tolist())) == len(set(right.tolist())) == 5
    chunk.word[:] = [1, 1, 1, 2, 1, 1, 2]  # equal lengths, other bytes
    assert len(set(chunk.word_ids().tolist())) == 5


def test_fingerprints_do_not_depend_on_the_place():
    a = phrases.Chunk([("en", b"one two three. two three")])
    b = phrases.Chunk([("fr", b"x"), ("en", b"Two  THREE")])
    h, inside = a.grams(2)
    assert inside.tolist() == [True, True, False, True]
    assert h[1] == h[3] == b.grams(2)[0][1] and h[0] != h[1]


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "HASHED", 33)
    text = b"several words here, and more. " * 20 + b"w" * 200 + b" end without a stop " * 5
    parts = list(phrases._parts(text))
    assert b"".join(parts) == text and all(p[-1:] in phrases.PIECE_ENDS.decode().encode() for p in parts[:-1]) and len(parts) > 10
    assert len(list(phrases._parts(b"a " * 100))) == 1
    chunk = phrases.Chunk([("en", text)])
    cut = phrases.Chunk([("en", p) for p in parts])
    for n in (1, 2, 3):
        (h, ok), (g, fine) = chunk.grams(n), cut.grams(n)
        assert sorted(h[ok].tolist()) == sorted(g[fine].tolist())
    first = np.flatnonzero(chunk.grams(2)[1])
    assert chunk.phrases(first, 2).to_pylist()[:3] == ["several words", "words here", "and more"]


def test_odd_rows(spark, table, odd_rows):
    docs = table([(*r[:2], None, None) for r in odd_rows])
    assert found(phrases.collocations(docs, min_count=2)) == plain([(r[1], None) for r in odd_rows], min_count=2)
    assert phrases.collocations(table([])).count() == 0
    assert phrases.collocations(table([(None, None), (1, "")])).count() == 0


def test_oracle(spark, sf_dir):
    import duckdb
    from wattline.llm import queries
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op11_phrases']})").fetchall()
    assert found(queries.op11_phrases(spark, sf_dir)) == set(want) and len(want) > 50


def test_held_counts_add_up(monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 40)
    rng, held, got, want = np.random.default_rng(1), phrases._Counts(), Counter(), Counter()
    batches = []
    for _ in range(60):
        h, c = np.unique(rng.integers(0, 90, 25).astype(np.uint64), return_counts=True)
        want.update(dict(zip(h.tolist(), c.tolist())))
        batches += held.add(h, c)
    batches += held.rows()
    for b in batches:
        for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            got[h] += c
    assert got == want and held.rows() == []
