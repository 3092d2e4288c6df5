import hashlib
import random
import re

import pytest

from wattline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PATTERNS[k], text or "") if passes(k, m.group(0))]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def found(df):
    return [(r["doc_id"], [(s["kind"], s["start"], s["end"], s["strict"]) for s in r["spans"]]) for r in df.collect()]


PARTS = ["a.b@c.de", "x@y@z.co.uk", "a@b.c_d@e.f", "a@b-c%d@e.f", "@", "a@b", "a@b..c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.002.3.255", "1..2.3.4.5",
         "4111111111111111", "4111 1111-1111 1111", "4111111111111112", "12", "7", "+1 (743) 555-3824", "+12345678", "+1 2 3 4 5 6 7 8 9", "+1((((((", "+1+123456789 0",
         "\U0001f600", "é", " ", "  ", "-", ".", "word", "\n", "\x01", "00000000000000", "5 5 5"]


def test_strict_spans_equal_plain_patterns(spark, table):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(PARTS) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 30)))) for i in range(400)]
    got = dict(found(pii.find_pii(table(rows))))
    for i, text in rows:
        assert [s[:3] for s in got[i] if s[3]] == base(text), text


def test_many_matches_in_a_text(spark, table):
    """Beyond one block of pieces, whose lengths are summed blockwise."""
    text = "".join(f"é n{i}@h{i}.example.com \U0001f600 " for i in range(700))
    assert [s[:3] for s in found(pii.find_pii(table([(1, text)])))[0][1]] == base(text)


def test_long_runs_end(spark, table):
    """Long runs without a match cost no quadratic time and no deep recursion."""
    texts = ["9" * 300_000, "a" * 300_000, "a@" + "b." * 100_000, "1." * 150_000, "+1" + "(" * 200_000, "+1" * 100_000, "1 " * 150_000, "a@b" * 100_000]
    rows = list(enumerate(texts))
    got = dict(found(pii.find_pii(table(rows))))
    for i in (0, 1, 4):
        assert got[i] == []
    assert [s[:3] for s in got[2]] == [("email", 0, 200_001)]
    assert len(got[3]) == 37_500


def test_reliabilities_and_added_spans(spark, table):
    """Loose emails in approving contexts are added, numbers that fail their check are not."""
    rng = random.Random(2)
    rows = []
    for i in range(320):
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        number = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        good = next(number + c for c in "0123456789" if luhn(number + c))
        bad = number + str((int(good[-1]) + 1 + i % 9) % 10)
        rows.append((i, [f"write to {name}@mail.example.com today", f"order {bad} is shipped", f"my e-mail: {name}(at)example(dot)org thanks", f"by card {good} please"][i % 4]))
    docs = table(rows)
    classifier, models = pii.fit(pii.candidates(docs).checkpoint())
    check = models["card"].chance[pii.VOTERS.index("check")]
    assert check[1][1] > 0.9 and check[0][0] > 0.9  # personal numbers pass, the others fail
    got = dict(found(pii.find_pii(docs)))
    for i, text in rows:
        loose = [s for s in got[i] if not s[3]]
        assert [s[:3] for s in got[i] if s[3]] == base(text)
        assert [(text[a:b], k) for k, a, b, _ in loose] == ([(re.search(r"\w+\(at\)\S+", text).group(0), "email")] if i % 4 == 2 else [])


def test_estimate_tells_good_labelers_from_bad_ones():
    rng = random.Random(3)
    patterns = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = "".join(str(int(truth if rng.random() < good else not truth)) if rng.random() < 0.9 else "2" for good in (0.95, 0.9, 0.85, 0.55, 0.5))
        patterns[votes] = patterns.get(votes, 0) + 1
    model = pii.estimate(patterns)
    assert model.share == pytest.approx(0.4, abs=0.05)
    for j, good in enumerate((0.95, 0.9, 0.85, 0.55, 0.5)):
        yes, no = model.chance[j][1], model.chance[j][0]
        assert yes[1] / (yes[0] + yes[1]) == pytest.approx(good, abs=0.06)
        assert no[0] / (no[0] + no[1]) == pytest.approx(good, abs=0.06)


def test_odd_rows(spark, table, odd_rows):
    got = found(pii.find_pii(table(odd_rows)))
    assert sorted(repr(g) for g in got) == sorted(repr((r[0], [])) for r in odd_rows)
    assert pii.find_pii(table([])).count() == 0


def test_query_on_the_whole_small_table(spark, sf_dir):
    from wattline.llm import queries
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op13_pii(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = base(docs[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == w[0] for w in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        assert set(joined(want).split(",")) <= set(r["spans"].split(","))


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    from wattline.llm import queries
    queries.op13_pii(spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
