"""Operators 2 and 9 against brute force."""
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import exact_dedup as E
from wattline.llm import jaccard_join as J

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keeps(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    return groups


def check_groups(got, rows):
    groups = keeps(rows)
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == sorted(
        (str(i), str(max((x for x in groups[(t or "").translate(LOWER)] if x is not None), default=None)), len(groups[(t or "").translate(LOWER)])) for i, t in rows)
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_groups(spark, table, odd_rows):
    long = "Some sentence, not short. Zebra! " * 400
    rows = [*odd_rows, (20, "AbC"), (21, "aBc"), (22, "Äbc"), (23, "äbc"), (24, long), (25, long.upper()), (26, long + "x"), (27, "x" + long)]
    check_groups(E.with_groups(table(rows)).collect(), rows)
    assert E.with_groups(table([])).count() == 0


def test_chunks_join_to_the_text_and_meet_again(spark, table):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdxyz ,.\n") for _ in range(40_000))
    texts = [base, "changed " + base, "q" * 50_000, "", base + "漢" * 20_000]
    df = table(list(enumerate(texts))).select("doc_id", "text", E.chunks(F.col("text")).alias("c")).orderBy("doc_id").collect()
    assert all("".join(r["c"]) == r["text"] for r in df)
    assert len(set(df[0]["c"]) & set(df[1]["c"])) >= 0.8 * len(df[0]["c"])


def test_colliding_digests_are_told_apart(spark, table):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdxyz ,.\n") for _ in range(rng.choice([0, 5, 3000])))) for i in range(60)]
    rows += [(100 + i, t) for i, t in rows[:20]]
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1).cast("binary")  # noqa: E731  16 values
    check_groups(E.with_groups(table(rows), digest=weak).collect(), rows)


def test_drop_copies_keeps_one_row_of_each_group(spark, table, odd_rows):
    rows = [*odd_rows, (30, "Same"), (31, "same"), (31, "same"), (31, "other")]
    docs = table(rows)
    out = E.drop_copies(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    groups = keeps(rows)
    assert len(kept) == len(groups) == len({(t or "").translate(LOWER) for _, t in kept})
    assert {i for i, t in kept if (t or "").lower() in ("same", "other")} == {31}


# -- n-gram Jaccard

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows, threshold=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= threshold * (len(sets[a]) + len(sets[b]) - inter):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return sorted((str(i), len(sets[k]), str(min(least[find(k)], default=None))) for k, (i, _) in enumerate(rows))


def got_components(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words = words or ["again"]
        k = rng.randrange(len(words))
        words[k:k + 1] = rng.choice([[], [words[k], "new%d" % rng.randrange(99)], ["sub%d" % rng.randrange(99)]])
    return words


def corpus(seed, docs=160):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for i in range(docs):
        kind = rng.random()
        if texts and kind < 0.6:
            words = edited(rng, rng.choice(texts), rng.choice([0, 1, 2, 4, 8]))
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 7, 9, 12, 20, 60, 150, 400]))]
        if kind > 0.8:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + passage + words[at:]
        words = words or ["z"]
        texts.append(words)
        rows.append((1000 - i if i % 3 else i, rng.choice([" ", "  ", "\n"]).join(w.upper() if rng.random() < .1 else w for w in words)))
    return rows


def test_hashes_equal_exactly_for_equal_shingles():
    texts = ["A b c d e f", "a B c d e f", "x  a b\tc d e f", "a b c d", "a b c", "", " \n", "Ä b c d e", "ä b c d e"]
    sets = J.shingle_sets(texts)
    want = [shingles(t) for t in texts]
    for a in range(len(texts)):
        assert len(sets[a]) == len(want[a])
        for b in range(len(texts)):
            assert len(np.intersect1d(sets[a], sets[b])) == len(want[a] & want[b])


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    texts = ["ab cd " * 50 + "x" * 300, "  lead", "tail  "]
    whole = J.shingle_sets(texts)
    monkeypatch.setattr(J, "_HASH_BLOCK", 64)
    assert all((a == b).all() for a, b in zip(whole, J.shingle_sets(texts), strict=True))


@pytest.mark.parametrize("n", [4, 5, 8, 13, 16, 47, 64, 65, 96, 128, 300, 700])
def test_linked_sets_share_a_key_and_pass_the_sketch(n):
    rng = np.random.default_rng(n)
    for trial in range(60):
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        room = J.most_difference(n, n)
        drop = int(rng.integers(0, room + 1))
        add = int(rng.integers(0, room + 1))
        a = np.unique(common)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
        if (a.tobytes() != b.tobytes()) and J.links(len(np.intersect1d(a, b)), len(a), len(b)):
            assert len(np.intersect1d(J.band_keys(a), J.band_keys(b))), (n, drop, add)
            assert J.may_link(J.parity_sketch(a), J.parity_sketch(b), len(a), len(b))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, table, odd_rows, seed):
    rows = corpus(seed) + (odd_rows if seed == 1 else [])
    assert got_components(J.jaccard_components(table(rows))) == brute_components(rows)


def test_last_round_finds_links_that_the_pivots_miss(spark, table, monkeypatch):
    """A chain of small steps: neighbours link, ends don't, so pivots can't reach all."""
    monkeypatch.setattr(J, "BLOCK", 4)
    rng = random.Random(9)
    words, rows = ["v%d" % rng.randrange(9999) for _ in range(200)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = words[7:] + ["v%d" % rng.randrange(9999) for _ in range(7)]
    assert got_components(J.jaccard_components(table(rows))) == brute_components(rows)


@pytest.mark.parametrize("exact", [False, True])
def test_a_group_leaves_a_forest_not_its_pairs(spark, monkeypatch, exact):
    """Near copies of several sizes in one group: a row for each node at most, joined as all pairs would."""
    monkeypatch.setattr(J, "BLOCK", 25)
    rng, sets = np.random.default_rng(4), []
    for size in (30, 60, 120, 121, 250):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        sets += [np.unique(np.concatenate([base[k % 7:], rng.integers(0, 1 << 63, k % 5, dtype=np.uint64)])) for k in range(20)]
    n = len(sets)
    value = [s.tobytes() if exact else J.parity_sketch(s) for s in sets]
    stars = spark.createDataFrame([(0, k, 9) for k in range(1, n)], "pivot long, node long, shared long")
    nodes = spark.createDataFrame([(k, len(s)) for k, s in enumerate(sets)], "node long, n long")
    members = J._divided(J._grouped(stars, nodes), spark.createDataFrame([], "node long, component long"))
    assert members.first()["blocks"] == 4
    got = J._forest(members, spark.createDataFrame(list(enumerate(value)), "node long, value binary"), J.THRESHOLD, exact).collect()
    assert len(got) < 4 * n  # 4 blocks meet in 10 parts, each with at most a row for each of its nodes

    def parts(edges):
        name = list(range(n))
        for a, b in edges:
            name = [name[a] if x == name[b] else x for x in name]
        return {frozenset(k for k in range(n) if name[k] == x) for x in name}

    links = [(a, b) for a in range(n) for b in range(a) if J.links(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
    near = [(a, b) for a in range(n) for b in range(a) if J.may_link(J.parity_sketch(sets[a]), J.parity_sketch(sets[b]), len(sets[a]), len(sets[b]))
            and min(len(sets[a]), len(sets[b])) * 100 >= J.THRESHOLD * max(len(sets[a]), len(sets[b]))]
    assert len(links) > 700
    assert parts((r["a"], r["b"]) for r in got) == parts(links if exact else near)


def test_empty_table_and_near_copies_dropped(spark, table, odd_rows):
    assert J.jaccard_components(table([])).count() == 0
    assert J.drop_near_copies(table([])).count() == 0
    rows = [(i + 5000, t) for i, t in corpus(3, 60)] + odd_rows
    docs = table(rows)
    out = J.drop_near_copies(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    unique = {(i, t or "") for i, t in rows}
    want = brute_components(rows)
    n_components = len({c for _, n, c in want if n}) + len({(i, t) for i, t in unique if not shingles(t)})
    assert len(kept) == n_components


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 499), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in J.components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 499: 499, 500: 499}
