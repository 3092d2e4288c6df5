"""Personal data by weak supervision (operator 13): emails, IP addresses, card and phone numbers.

Every text is scanned once by DataFrame functions. What looks like personal data is a
candidate: strict matches, which are always reported, and looser forms (written-out
emails, numbers without a plus sign, numbers that fail a check). Five labelers vote on
each candidate (1 personal, 0 not, 2 no opinion): form, check (Luhn, ranges), gazetteer
(top-level domains, dialling codes, card issuers), context words, and neighbouring
characters. Expectation-maximisation estimates each labeler's reliability from the
counts of the vote patterns, without labels; its posteriors then train a span
classifier (naive Bayes over the votes' probability and further features of the span)
by weighted counts. Loose candidates that it accepts are added to the strict ones.

The number of vote patterns and of features is fixed, so what reaches the driver is
bounded whatever the number of rows; texts and candidates never do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import cut

KINDS = ["email", "ip", "card", "phone"]

# The four strict patterns of the contract, written with possessive
# quantifiers (they match the same spans: the next character is never in the class
# before it) so that a long run is neither retried from inside nor recursed into.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap condition that a text with a match fulfils.
GATE = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Looser forms; a part of a strict match is none.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-])",
}
LOOSE_GATE = {"email": "at", "ip": ":", "phone": None}

PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Gazetteers and context words (lower case).
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "biz", "io", "eu", "de", "fr", "es", "it", "uk", "us", "ca", "au", "nl", "ch", "at", "be",
           "pl", "se", "no", "dk", "fi", "pt", "br", "mx", "ru", "cn", "jp", "kr", "in"]
DIALLING = r"^(?:\+|00)?(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|30[0-5])"
RESERVED = r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": r"(?:e-?mail|mailto|contact|correo|courriel|write to|reply)",
    "ip": r"(?:\bip\b|address|host|server|login|client|adresse)",
    "card": r"(?:card|visa|master|amex|credit|debit|karte|carte|tarjeta)",
    "phone": r"(?:phone|tel\b|tel[:.]|call|mobile|fax|cell|telefon|t[ée]l[ée]phone|m[óo]vil|handy)",
}
AGAINST = r"(?:version|order|invoice|isbn|issn|serial|part no|article|section|build|release|ticket|number of|token|hash|id[:=# ])"

#: Characters before a span that the context labeler reads.
CONTEXT = 32
VOTERS = ["form", "check", "gazetteer", "context", "edges"]
NO_OPINION = 2
ROUNDS = 40
#: Least probability at which a loose candidate is added.
THRESHOLD = 0.9
#: Pieces whose lengths are summed together.
BLOCK = 128
MARK = "\u0001"


def pieces(text: Column, pattern: str, gate: Column | None) -> Column:
    """The text cut at its matches: odd places (from 0) hold them. Empty if `gate` fails."""
    found = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    return found if gate is None else F.when(gate, found).otherwise(F.array().cast("array<string>"))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def block_starts(lengths: Column) -> Column:
    """Sum of the lengths before each block of BLOCK pieces."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)))
    before = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.when(F.size(lengths) > 1, before).otherwise(F.array().cast("array<long>"))


def start_of(lengths: Column, starts: Column, place: Column) -> Column:
    """Code points before the piece at `place` (from 0): its block's start and the pieces of
    the block before it, so a text with many matches costs BLOCK additions for each."""
    block = F.floor(place / BLOCK).cast("int")
    return F.get(starts, block) + _sum(F.slice(lengths, block * BLOCK + 1, place - block * BLOCK))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, F.lit("[^0-9]+"), F.lit(""))


def is_strict(kind: str, s: Column) -> Column:
    """Whether a match of the strict pattern passes its check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return s.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    n = F.length(_digits(s))
    if kind == "card":
        return F.when(n.between(13, 19), F.call_function("luhn_check", _digits(s))).otherwise(F.lit(False))
    return n.between(9, 15)


def may_be(kind: str, s: Column) -> Column:
    """Whether a match is a candidate at all."""
    return {"card": F.length(s).between(13, 37) & F.length(_digits(s)).between(13, 19), "phone": F.length(_digits(s)).between(7, 15)}.get(kind, F.lit(True))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(NO_OPINION)


def votes(kind: str, s: Column, before: Column, after: Column, loose: bool, strict: Column) -> Column:
    """One vote of each labeler (VOTERS) on a span and the text around it."""
    low, left = F.lower(s), F.lower(F.right(before, F.lit(CONTEXT)))
    digits = _digits(s)
    form = F.lit(NO_OPINION if loose else 1)
    if kind == "email":
        gazetteer = F.element_at(F.split(F.regexp_replace(low, F.lit(r"[\[({ ]+dot[\]) }]+"), F.lit(".")), r"\."), -1).isin(DOMAINS)
        check = _vote(low.rlike(r"[a-z]{2,}$"), low.rlike(r"[0-9-]$"))
        gazetteer = _vote(gazetteer, F.lit(False))
    elif kind == "ip":
        check = _vote(strict if not loose else F.lit(True), F.lit(not loose))
        gazetteer = _vote(F.lit(False), s.rlike(RESERVED))
    elif kind == "card":
        check = _vote(strict, F.lit(True))
        gazetteer = _vote(digits.rlike(ISSUERS), F.lit(True))
    else:
        check = _vote(F.length(digits).between(9, 15), F.lit(True))
        gazetteer = _vote(F.concat(F.when(s.startswith("+"), "+").otherwise(""), digits).rlike(DIALLING) & ~F.lit(loose), F.lit(False))
    context = _vote(left.rlike(CUES[kind]), left.rlike(AGAINST))
    glued = F.right(before, F.lit(1)).rlike(r"[\p{L}\p{N}_/=#]") | F.substring(after, 1, 1).rlike(r"[\p{L}\p{N}_/=#]")
    return F.array(form, check, gazetteer, context, _vote(F.lit(False), glued))


def span_features(kind: str, s: Column, before: Column, after: Column, loose: bool) -> Column:
    """Further features of a span, each `name=value` with a fixed number of values."""
    def edge(c: Column) -> Column:
        return (F.when(c == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike(r"[\p{L}]"), "letter").when(c.rlike(r"[\p{N}]"), "digit")
                .when(c.rlike(r"[.,;:!?)\]}\"']"), "stop").otherwise("sign"))

    return F.array(F.concat(F.lit("digits="), F.least(F.length(_digits(s)), F.lit(20)).cast("string")),
                   F.concat(F.lit("size="), F.least(F.floor(F.length(s) / 4), F.lit(16)).cast("string")),
                   F.concat(F.lit("before="), edge(F.right(before, F.lit(1)))), F.concat(F.lit("after="), edge(F.substring(after, 1, 1))),
                   F.concat(F.lit("gaps="), F.least(F.length(F.regexp_replace(s, F.lit("[^ ().-]+"), F.lit(""))), F.lit(6)).cast("string")),
                   F.lit(f"loose={int(loose)}"))


def _matches(kind: str, name: str, loose: bool) -> Column:
    """Candidates of one kind from the columns `{name}_p` (pieces), `{name}_l`, `{name}_b`."""
    p, lengths, starts = F.col(f"{name}_p"), F.col(f"{name}_l"), F.col(f"{name}_b")

    def one(i: Column) -> Column:
        s, before, after = F.get(p, i), F.get(p, i - 1), F.get(p, i + 1)
        strict = F.lit(False) if loose else is_strict(kind, s)
        at = start_of(lengths, starts, i)
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), at.alias("start"), (at + F.length(s)).alias("end"), strict.alias("strict"),
                        votes(kind, s, before, after, loose, strict).alias("votes"),
                        span_features(kind, s, before, after, loose).alias("features"))

    places = F.when(F.size(p) > 1, F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(F.filter(places, lambda i: may_be(kind, F.get(p, i))), one)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): per row its candidates, strict and loose; a loose one that
    touches a strict match or an earlier loose one of its kind is none."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), MARK, "\u0002")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
    t = F.col("t")
    names = []
    cutting = {}
    for kind in KINDS:
        gate = t.rlike("[0-9]") if GATE[kind] is None else t.contains(GATE[kind])
        if kind in ("ip", "phone"):
            gate = gate & t.rlike("[0-9]")
        cutting[f"s_{kind}_p"] = pieces(t, STRICT[kind], gate)
        names.append((kind, f"s_{kind}", False))
        if kind in LOOSE:
            gate = t.rlike("[0-9]{3,4}[ .-][0-9]{3,4}") if LOOSE_GATE[kind] is None else t.contains(LOOSE_GATE[kind])
            if kind == "email":
                gate = t.rlike(r"[(\[{]at[)\]}]")
            if kind == "ip":
                gate = t.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]")
            cutting[f"w_{kind}_p"] = pieces(t, LOOSE[kind], gate)
            names.append((kind, f"w_{kind}", True))
    rows = rows.select("doc_id", *[c.alias(n) for n, c in cutting.items()])
    rows = rows.withColumns({f"{n}_l": F.transform(F.col(f"{n}_p"), lambda x: F.length(x)) for _, n, _ in names})
    rows = rows.withColumns({f"{n}_b": block_starts(F.col(f"{n}_l")) for _, n, _ in names})
    rows = rows.select("doc_id", F.concat(*[_matches(k, n, loose) for k, n, loose in names if not loose]).alias("base"),
                       F.concat(*[_matches(k, n, loose) for k, n, loose in names if loose]).alias("wide"))
    touching = lambda w: F.exists("base", lambda b: (b["start"] < w["end"]) & (b["end"] > w["start"]) & (b["strict"] | (b["kind"] == w["kind"])))
    wide = F.when(F.size("wide") > 0, F.filter("wide", lambda w: ~touching(w))).otherwise(F.col("wide"))
    found = F.transform(F.concat("base", wide), lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["strict"].alias("strict"),
                                                                   F.array_join(m["votes"].cast("array<string>"), "").alias("votes"), m["features"].alias("features")))
    return rows.select("doc_id", found.alias("found"))


class Reliability:
    """Of one kind: share of personal spans, and per labeler the chance of each vote (0, 1, 2) given the truth."""

    def __init__(self, share: float, chance: list[list[list[float]]]):
        self.share, self.chance = share, chance

    def posterior(self, pattern: str) -> float:
        odds = math.log(self.share) - math.log(1 - self.share)
        for j, v in enumerate(pattern):
            odds += math.log(self.chance[j][1][int(v)]) - math.log(self.chance[j][0][int(v)])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> Reliability:
    """Expectation-maximisation (labelers independent given the truth) over the counts of
    vote patterns, from the share of approving votes, with one made-up vote of each value."""
    total = sum(patterns.values())

    def majority(p: str) -> float:
        yes, no = p.count("1"), p.count("0")
        return (yes + 0.5) / (yes + no + 1)

    belief = {p: majority(p) for p in patterns}
    model = Reliability(0.5, [])
    for _ in range(rounds):
        share = (sum(belief[p] * n for p, n in patterns.items()) + 1) / (total + 2)
        chance = []
        for j in range(len(VOTERS)):
            table = [[1.0] * 3, [1.0] * 3]
            for p, n in patterns.items():
                table[1][int(p[j])] += belief[p] * n
                table[0][int(p[j])] += (1 - belief[p]) * n
            chance.append([[x / sum(side) for x in side] for side in table])
        model = Reliability(share, chance)
        belief = {p: model.posterior(p) for p in patterns}
    return model


def _lookup(table: dict[str, float], key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    made = F.map_from_arrays(F.array(*[F.lit(k) for k in table]), F.array(*[F.lit(float(v)) for v in table.values()]))
    return F.coalesce(F.try_element_at(made, key), F.lit(default))


class SpanClassifier:
    """Log odds of a span: those of its votes, plus the weight of each further feature."""

    def __init__(self, votes: dict[str, float], weights: dict[str, float]):
        self.votes, self.weights = votes, weights

    def probability(self, m: Column) -> Column:
        kind = m["kind"].cast("string")
        odds = _lookup(self.votes, F.concat(kind, F.lit("|"), m["votes"]), -60.0)
        odds = F.aggregate(m["features"], odds, lambda a, f: a + _lookup(self.weights, F.concat(kind, F.lit("|"), f), 0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(odds, F.lit(60.0)), F.lit(-60.0))))


def fit(found: DataFrame, rounds: int = ROUNDS) -> tuple[SpanClassifier, dict[str, Reliability]]:
    """Reliabilities and classifier from all candidates (doc_id, found); no labels are read.
    Without candidates every probability is 0. A feature counts by the logarithm of its
    smoothed share among personal and other spans, each weighted by its posterior, divided
    by the number of features, which are far from independent."""
    spans = found.select(F.explode("found").alias("m")).select("m.kind", "m.votes", "m.features")
    # at most 4 kinds x 3^5 patterns
    counted: dict[int, dict[str, int]] = {}
    for r in spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect():
        counted.setdefault(r["kind"], {})[r["votes"]] = r["n"]
    models = {kind: estimate(p, rounds) for kind, p in counted.items()}
    chance = {f"{kind}|{p}": models[kind].posterior(p) for kind, ps in counted.items() for p in ps}
    odds = {k: math.log(max(x, 1e-12)) - math.log(max(1 - x, 1e-12)) for k, x in chance.items()}
    belief = _lookup(chance, F.concat(F.col("kind").cast("string"), F.lit("|"), F.col("votes")), 0.0)
    shares = spans.select("kind", belief.alias("p"), F.explode("features").alias("f")).groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    weights, rows = {}, shares.collect()  # at most 4 kinds x 60 values
    for r in rows:
        name = r["f"].split("=")[0]
        alike = [x for x in rows if x["kind"] == r["kind"] and x["f"].split("=")[0] == name]
        yes, no = ((r[side] + 1) / (sum(x[side] for x in alike) + len(alike)) for side in ("yes", "no"))
        weights[f"{r['kind']}|{r['f']}"] = (math.log(yes) - math.log(no)) / len({x["f"].split("=")[0] for x in rows})
    return SpanClassifier(odds, weights), {KINDS[k]: m for k, m in models.items()}


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans): per row the spans of personal data as structs (kind, start, end,
    strict, probability) by kind (KINDS), then start; code points, end exclusive.

    Strict matches always stand there with probability 1; loose candidates with at least
    `threshold` are added. Null and empty texts have no spans; equal rows stay apart; the
    id may be null; other columns are left out. An empty table gives no rows.
    """
    found = cut(candidates(docs, id_col, text_col))  # no texts: places, votes and features only
    classifier, _ = fit(found)
    judged = F.transform("found", lambda m: F.struct(
        m["kind"].alias("no"), m["start"].alias("start"), m["end"].alias("end"), m["strict"].alias("strict"),
        F.when(m["strict"], F.lit(1.0)).otherwise(classifier.probability(m)).alias("probability")))
    kept = F.array_sort(F.filter(judged, lambda m: m["probability"] >= threshold))
    names = F.array(*[F.lit(k) for k in KINDS])
    return found.select("doc_id", F.transform(kept, lambda m: F.struct(
        F.get(names, m["no"]).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["strict"].alias("strict"), m["probability"].alias("probability"))).alias("spans"))
