"""Operator 1 against Python's regexes."""
import random
import re

import pytest

from wattline.llm import secret_scan as S

BASE = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(BASE)
             for m in re.finditer(p, text or "") if len(m[g]) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def base(spans):
    return [x for x in spans if x[0] in ("assign", "access", "hex")]


def test_base_spans_equal_regex_on_random_texts():
    rng = random.Random(5)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abc", "AKIA", "ABCDEFGH1234",
             "0123456789abcdef", "deadbeef", "é", "\n", "漢", ".", "-", "/", "gh", "ghp_", "eyJ", "xoxb-", "a" * 30, "Z" * 20]
    a = S.automaton(S.BASE_RULES + S.MORE_RULES)
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 12))]
        for text, spans in zip(texts, a.scan(texts), strict=True):
            assert base(spans) == brute(text), text


def test_consumed_matches_are_dropped_not_rescanned():
    a = S.automaton(S.BASE_RULES)
    for text in ['password="token"=abcdefgh', "token=abc token=abcdef", "secret: token=abcdef", "tokentoken:abcdef", "AKIA" * 6]:
        assert a.scan([text])[0] == brute(text)


def test_added_rules_and_ascii_long_runs():
    a = S.automaton(S.BASE_RULES + S.MORE_RULES)
    text = "x ghp_" + "Zq" * 20 + " -----BEGIN RSA PRIVATE KEY----- AIza" + "z" * 36
    assert [k for k, _, _ in a.scan([text])[0]] == ["github", "pem", "google"]
    text = "é" * 5 + "f" * 200_000 + " end"
    assert a.scan([text])[0] == [("hex", 5, 200_005)]


def test_rules_that_need_looking_back_are_refused():
    with pytest.raises(ValueError):
        S.Automaton((S.Rule("bad", "a(bc)?"),))
    with pytest.raises(ValueError):
        S.Automaton((S.Rule("bad", "a*"),))


def test_minimal_automaton_has_no_equivalent_states():
    table, out = S._minimal(*S._search_dfa(S.Rule("w", "(cat|bat)x+"), [ord(c) for c in "abctx"]))
    assert len(S._minimal(table, out)[0]) == len(table)


def test_operator_on_odd_rows(spark, table, odd_rows):
    rows = [*odd_rows, (9, "token=abcdefgh"), (9, "token=abcdefgh")]
    got = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in S.find_secrets(table(rows)).collect()]
    assert len(got) == len(rows)
    assert sorted(got, key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert S.find_secrets(table([])).count() == 0
