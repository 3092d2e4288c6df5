import random
import re
import zlib
from collections import Counter

from wattline.llm import spelling


def plain(rows, min_letters=5, min_count=3, one_in=97):
    """The contract, word by word: every pair of words is compared."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= min_letters:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w in n:
        around = [v for v in n if near(w, v)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (form, n[w], len(around), n[form] if form else None)
    result = set()
    for w, (form, count, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result.add((w, form, root, count, n_near, form_n))
    return result


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_comparison_of_all_pairs(spark, table):
    rng = random.Random(5)
    letters = "abcéÿÀ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(60)]
    for w in list(words):
        at = rng.randrange(len(w))
        words += [w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w.upper()]
    rows = [(i % 40, " ".join(rng.choices(words, k=120, weights=[1 + i % 9 for i in range(len(words))]))) for i in range(50)]
    assert found(spelling.spelling_variants(table(rows))) == plain(rows)
    assert found(spelling.spelling_variants(table(rows), one_in=3)) == plain(rows, one_in=3)


def test_full_filters_lose_no_pair(spark, table):
    """Filters of a few bits know every edit; the join removes what they know falsely."""
    rows = [(i, "spelling speling spellings sperling smelling swelling dwelling welling") for i in range(9)]
    words = spelling.vocabulary(table(rows), one_in=0).checkpoint()
    full = spelling.near_pairs(words, most_bits=512)
    usual = spelling.near_pairs(words)
    pairs = {(r["word"], r["near"]) for r in usual.collect()}
    assert pairs == {(r["word"], r["near"]) for r in full.collect()}
    assert ("spelling", "speling") in pairs and ("speling", "spelling") in pairs and ("dwelling", "welling") in pairs


def test_chain_of_forms(spark, table):
    text = " ".join(["abcdefgh"] * 48 + ["abcdefg"] * 24 + ["abcdef"] * 12 + ["abcde"] * 6)
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_variants(table([(1, text)]), one_in=0).collect()}
    assert got == {"abcdefgh": (None, "abcdefgh"), "abcdefg": ("abcdefgh", "abcdefgh"), "abcdef": ("abcdefg", "abcdefgh"), "abcde": ("abcdef", "abcdefgh")}


def test_odd_rows(spark, table, odd_rows):
    assert found(spelling.spelling_variants(table(odd_rows))) == plain([r[:2] for r in odd_rows])
    assert spelling.spelling_variants(table([])).count() == 0
    assert spelling.spelling_variants(table([(None, None), (1, "")])).count() == 0


def test_whole_small_table(spark, sf_dir):
    from wattline.llm import queries
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = found(queries.op12_spelling_variants(spark, sf_dir))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert any(r[1] for r in got)
