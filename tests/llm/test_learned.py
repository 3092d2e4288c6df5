"""Operators 5, 6 and 10: held-out accuracy, recall, odd rows."""
import random
import zlib

import numpy as np
import pytest

from wattline.llm import ann_tree as A
from wattline.llm import lang_id as L
from wattline.llm import queries as Q
from wattline.llm import toxicity as X
from wattline.llm.common import is_held_out, load
from pyspark.sql import functions as F


def test_held_out_rows(spark):
    got = {r["doc_id"]: r["h"] for r in spark.range(50).select(F.col("id").alias("doc_id"), is_held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_language_accuracy_on_held_out(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in load(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    got = [r for r in Q.op5_language_id(spark, sf_dir).collect()]
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(spark, table, odd_rows):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("die katze auf der matte", "de")] * 20)] + odd_rows
    docs = table(rows)
    model = L.fit(docs)
    got = L.identify(docs, model).collect()
    assert len(got) == len(rows)
    want_und = sum(1 for _, t, *_ in rows if not any(c.isalpha() for c in t or ""))
    assert sum(r["lang_pred"] == "und" for r in got) == want_und and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in got} == {"en", "de", "und"}
    assert [x for x, _ in model.predict(["the mat", "der matte", "catter", "½ 12", "", "漢字"])] == ["en", "de", "en", "und", "und", model.languages[0]]
    kept = L.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - want_und
    told = {(r["doc_id"], r["text"]): r["lang"] for r in kept.collect()}
    assert told == {(r["doc_id"], t): r["lang_pred"] for r, t in zip(got, [x[1] for x in rows], strict=True) if r["lang_pred"] != "und"}
    nothing = table([])
    assert L.identify(nothing, L.fit(nothing)).count() == 0
    assert {r["lang_pred"] for r in L.identify(docs, L.fit(nothing)).collect()} == {"und"}


@pytest.mark.parametrize("lang", [None, "und"])
def test_stage_drops_only_texts_without_a_letter(spark, table, odd_rows, lang):
    rows = [(i, "the cat sat on the mat", lang) for i in range(20)] + odd_rows
    want = sorted(str(r[:2]) for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert sorted(str((r["doc_id"], r["text"])) for r in L.with_language(table(rows)).collect()) == want
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert L.with_language(table([(i, "die katze", "de") for i in held])).count() == len(held)


def test_backoff_takes_the_longest_known_ngrams():
    model = L.LanguageModel(["a", "b"], {"word": 0}, {"^w": 1, "w": 2, "q": 3}, np.zeros((4, 2), dtype=np.float32))
    assert model._backoff("wq") == [1] and model._backoff("q") == [3] and model._backoff("zz") == []


def test_toxicity_on_held_out(spark, sf_dir):
    truth = {r["doc_id"]: r["toxic"] for r in load(spark, sf_dir, "labels").collect()}
    got = {r["doc_id"]: r for r in Q.op6_toxicity(spark, sf_dir).collect()}
    assert len(got) == load(spark, sf_dir, "documents").count()
    known = [i for i in truth if i in got and got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in known) >= 0.9 * len(known)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_folding_and_exceptions():
    lexicon = X.Lexicon({X.fold("idiot"): 5.0, X.fold("trash"): 4.0, "stup*": 4.0}, (X.fold("trash can"),), 0.5)
    for text in ["you IDIOT", "an 1d10t!", "іdіot", "i​diot", "ｉdiot", "ídiot", "$tupidest"]:
        assert lexicon.score(text) > 0.5, text
    for text in ["", "a trash can", "idiots", "nothing here", "astupid"]:
        assert lexicon.score(text) < 0.5, text
    assert lexicon.score("idiot " + "plain words " * 2000) < 0.5 < lexicon.score("idiot " + "plain words " * 20)


def test_lexicon_is_learned_and_odd_rows_are_scored(spark, table, odd_rows):
    rng = random.Random(6)
    plain = ["p%s" % "".join(rng.choice("bcdf") for _ in range(4)) for _ in range(200)]
    rows, marks = [], []
    for i in range(300):
        words = rng.choices(plain, k=30)
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["vile", "rotten", "lousyish", "lousyness"])
        elif i % 10 == 1:
            words[4:6] = ["rotten", "apple"]  # harmless phrase
        rows.append((1000 + i, " ".join(words)))
        marks.append((1000 + i, 1, int(i % 4 == 0)))
    docs, labels = table(rows + odd_rows), spark.createDataFrame([*marks, (None, 0, 1), (1005, 1, None)], "doc_id long, quality int, toxic int")
    lexicon = X.fit(docs, labels)
    assert "rotten appie" in lexicon.exceptions  # folded
    got = {r["doc_id"]: r["predicted"] for r in X.score_toxicity(table(rows), lexicon).collect()}
    assert sum(got[i] == t for i, _, t in marks) >= 0.97 * len(marks)
    assert X.score_toxicity(docs, lexicon).count() == len(rows) + len(odd_rows)
    empty = X.fit(table([]), labels)
    assert [r["predicted"] for r in X.score_toxicity(table([(1, "vile"), (2, None)]), empty).collect()] == [0, 0]
    assert X.score_toxicity(table([]), lexicon).count() == 0


def test_rare_terms_are_learned_whatever_the_sample(spark, table):
    rng = random.Random(9)
    plain = ["p%s" % "".join(rng.choice("bcdf") for _ in range(3)) for _ in range(40)]
    terms = [f"{a}{b}{c}" for a in "vwxyz" for b in "vwxyz" for c in "vwxyzk"]  # 150, three toxic documents each
    rows = [(i, " ".join(rng.choices(plain, k=20) + ([terms[i // 4 % 150]] if i % 4 == 0 else []))) for i in range(2250)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    lexicon = X.fit(table(rows), labels)
    got = {r["doc_id"]: r["predicted"] for r in X.score_toxicity(table(rows), lexicon).collect()}
    learned = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    times = {t: sum(rows[i][1].endswith(t) for i in learned) for t in terms}
    known = [i for i in learned if i % 4 or times[terms[i // 4 % 150]] >= 2]
    assert sum(n >= 2 for n in times.values()) > 140
    assert all(got[i] == (i % 4 == 0) for i in known)


def test_greedy_covers_every_document_that_can_be():
    docs = [[[0], [1]], [[0], [1]], [[1], [2]], [[2]], [[3]], []]
    assert X._greedy(docs, [9.0, 9.0, 3.0, 3.0], [True] * 4) == [1, 2, 3, 0]
    assert X._greedy(docs, [9.0, 9.0, 3.0, 3.0], [False] * 4) == [1, 2, 3]


# -- nearest neighbours


def brute(rows, k=10):
    rows = [(i, np.array(v, dtype=float)) for i, v in rows]
    out = []
    for q, x in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in rows if i != q)[:k]
            out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string, score string, leaf string")


def row(i, v):
    return (i, v, 0, "a", "b", "c")


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    data = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in A.search(vectors(spark, [row(*x) for x in data])).collect()]
    want = brute(data)
    assert len(got) == len(want) == 300
    score = {(q, i): d for q, _, i, d in want}
    hits = [(q, i) for q, _, i, d in got if (q, i) in score]
    assert len(hits) >= 0.9 * len(want)
    assert all(d == pytest.approx(score[q, i], rel=1e-12) for q, _, i, d in got if (q, i) in score)


def test_odd_vectors_and_ties(spark):
    same = [1.0, 2.0]
    rows = [row(100, same)] + [row(i, same) for i in range(1, 60)] + [row(200, [5.0, 5.0]), row(201, None), row(202, [0.0, 0.0]), row(203, [None, 1.0]),
            row(204, [float("nan"), 1.0]), row(205, [float("inf"), 1.0]), row(206, [1.0]), row(207, []), row(None, same), row(300, [0.0, 0.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in A.search(vectors(spark, rows)).collect())
    assert [x[:3] for x in got if x[0] == 100] == [(100, k, k) for k in range(1, 11)]
    assert {x[0] for x in got} == {100, 200}
    assert [x[2] for x in got if x[0] == 200] == list(range(1, 11))


def test_few_or_no_candidates(spark):
    assert A.search(vectors(spark, [])).count() == 0
    assert A.search(vectors(spark, [row(0, [1.0])])).count() == 0
    got = A.search(vectors(spark, [row(0, [1.0]), row(1, [3.0]), row(1, [2.0])])).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 1, 1.0), (2, 1, 2.0)]


def test_every_vector_is_in_a_leaf_and_visits_reach_all():
    rng = np.random.default_rng(8)
    data = rng.normal(size=(2000, 8))
    tree = A.grow(data)
    leaf = tree.descend(data)
    assert set(leaf) <= set(range(tree.n_leaves))
    assert sorted(tree.visits(data[0])) == list(range(tree.n_leaves))
