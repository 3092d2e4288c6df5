"""N-gram Jaccard join by parity sketches (operator 9).

A document is the set of its word shingles (64-bit hashes). Documents with equal
sets are one node; links are looked for between nodes.

Sketch. A node's tokens are dealt into K blocks by their high bits and XORed
together per block. A token in which two sets differ changes one block at most, so
the number of differing blocks is a lower bound of the symmetric difference.

Size bands and pigeonhole. Two sets link only if their symmetric difference is at
most d = (a + b) * (100 - T) / (100 + T). Bands are powers of two; K is fixed in a
band, and a node also takes part in the next band if a partner may lie there. Two
linked nodes have at most d differing blocks. Of a node's non-empty blocks, in an
order that is the same for all nodes, the first d + 1 therefore hold one that both
share: only those are joined on. (A node with d non-empty blocks or fewer also
joins on a key common to all such nodes of its band.) Blocks of many tokens come
first in the order: a passage that many documents share rarely fills one alone, so
it rarely makes a key of its own.

Candidates and verification. Within each key's nodes the least is the pivot. A node
is checked against the pivot that it shares most keys with: by size, by the Hamming
distance of one-bit parity sketches, then exactly on the hash sets. Links make components.
Keys of one pivot make one group (near copies share hundreds of keys, but few pivots).
Further rounds take other pivots for the groups whose nodes aren't in one component yet, as
long as that finds links. At last all nodes of such a group are compared where they meet,
in blocks, and what leaves the task is a forest: first one of the pairs that sketches allow,
to know whose sets are wanted, then, in the groups that had such pairs, one of exact links.
No link that matters is lost, while a group of thousands of near copies costs a few checks
a node, and a row for each node instead of one for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.bitmaps import bit_set
from wattline.llm.common import cut, keep_rows, row_key, small_batches, text_groups

#: Words of a shingle and least percentage of the union that the intersection must be.
WORDS, THRESHOLD = 5, 75
#: Nodes of one group that are compared together in the end, and their tokens; rounds of pivots before it.
BLOCK, BLOCK_TOKENS, ROUNDS = 1024, 1 << 20, 1
#: Slots of the bitmap that tells workers which nodes' sets are wanted.
BITMAP = 1 << 23
#: Nodes whose keys a task remembers having sent.
REMEMBERED = 500_000
#: Characters shingled together (their arrays take some 100 bytes each).
GROUP = 1_000_000

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z count as a-z
_P = int(_rng.integers(0, 1 << 62)) * 4 + 3
_P_INVERSE = pow(_P, -1, 1 << 64)
_G = _U(0x9E3779B97F4A7C15)
_HASH_BLOCK = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _count(n: int) -> np.ndarray:
    return np.array([n], dtype=np.uint64) * _G


_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every word of a buffer that ends with a space; the buffer
    is taken in pieces cut at spaces."""
    places, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + _HASH_BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end - 1]]:
            part = _SPACE[data[end:end + _HASH_BLOCK]]
            end += int(part.argmax()) + 1 if part.any() else len(part)
        piece = data[at:end]
        space = _SPACE[piece]
        before = np.append(True, space[:-1])
        begin, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        up, down = _power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[piece] * up[:len(piece)], out=sums[1:])
        places.append(begin + at)
        hashes.append(_mix((sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64) * _G))
        at = end
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles; of the whole sequence if
    it has fewer words; none if it has no word. A-Z count as a-z."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    place, word = _word_hashes(data)
    stop = np.searchsorted(place, ends)
    factors = _mix(np.arange(1, words + 1, dtype=np.uint64) * _G) | _U(1)
    full = max(0, len(word) - words + 1)
    joined = np.zeros(full, dtype=np.uint64)
    for k in range(words):
        joined += word[k:k + full] * factors[k]
    joined = _mix(joined)
    out, first = [], 0
    for last in stop.tolist():
        n = last - first
        if n >= words:
            out.append(np.unique(joined[first:last - words + 1]))
        elif n:
            out.append(_mix((word[first:last] * factors[:n]).sum(dtype=np.uint64, keepdims=True) + _count(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        first = last
    return out


def node_of(hashes: np.ndarray) -> int:
    """64-bit signature of a set."""
    total = hashes.sum(dtype=np.uint64, keepdims=True) + _mix(np.bitwise_xor.reduce(hashes, keepdims=True)) + _count(len(hashes))
    return int(_mix(total).view(np.int64)[0])


def most_difference(a: int, b: int, threshold: int = THRESHOLD) -> int:
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (100 - threshold) // (100 + threshold)


def band_keys(hashes: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Keys on which a node joins, in its own band and in the next one if a partner
    may lie there."""
    n = len(hashes)
    largest = n * 100 // threshold  # partner
    own = n.bit_length() - 1
    out = []
    for band in (own, own + 1):
        if largest < 1 << band:
            continue
        d = most_difference(n, min(largest, (2 << band) - 1), threshold)
        if d == 0:
            continue  # only an equal set could link
        bits = band if band >= 6 else band + 2  # K = 2 ** bits
        block = (hashes >> _U(64 - bits))
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        value = np.bitwise_xor.reduceat(hashes, first)
        count = np.diff(np.append(first, n))
        salt = _mix(np.array([band + 1], dtype=np.uint64) * _G)
        key = _mix(value + _mix(block[first] + salt))
        if len(key) <= d:
            out += [key, salt]
        else:
            out.append(key[np.lexsort((key, -count))[:d + 1]])
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def parity_sketch(hashes: np.ndarray) -> bytes:
    """One parity bit for each value of the hashes' low bits, 2 to 4 bits a token."""
    size = max(64, 4 << (len(hashes).bit_length() - 1))
    odd = np.bincount((hashes & _U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> int:
    """Sketch of fewer bits from one of more: halves XORed."""
    value, n = int.from_bytes(sketch, "little"), len(sketch)
    while n > size:
        n //= 2
        value = (value & ((1 << 8 * n) - 1)) ^ (value >> 8 * n)
    return value


def may_link(a: bytes, b: bytes, n_a: int, n_b: int, threshold: int = THRESHOLD) -> bool:
    size = min(len(a), len(b))
    return (_folded(a, size) ^ _folded(b, size)).bit_count() <= most_difference(n_a, n_b, threshold)


def links(inter: int, n_a: int, n_b: int, threshold: int = THRESHOLD) -> bool:
    return 100 * inter >= threshold * (n_a + n_b - inter)


# -- Spark


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def shingled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, with_key: bool = False) -> DataFrame:
    """(doc_id, n, node, sketch) per document, with the row's key if wanted; node and
    sketch are null for an empty set."""
    rows = _documents(docs, id_col, text_col).withColumn("key", row_key(F.col("doc_id"), F.col("text")) if with_key else F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in text_groups(batch, GROUP):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays([
                    ids, batch.column("key").slice(at, len(ids)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([parity_sketch(s) if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "key", "n", "node", "sketch"])
                at += len(ids)

    out = rows.mapInArrow(run, "doc_id long, key string, n long, node long, sketch binary")
    return out if with_key else out.drop("key")


def _keyed(docs: DataFrame, text_col: str, words: int, threshold: int) -> DataFrame:
    """(key, node): the keys of every node, sent once by each task that meets it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for _, texts in text_groups(batch, GROUP):
                nodes, keys = [], []
                for s in shingle_sets(texts, words):
                    node = node_of(s) if len(s) else None
                    if node is None or node in sent:
                        continue
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(node)
                    if len(k := band_keys(s, threshold)):
                        nodes.append(np.full(len(k), node, dtype=np.int64))
                        keys.append(k)
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    return _documents(docs, text_col, text_col).select(F.lit(None).cast("long").alias("doc_id"), "text").mapInArrow(run, "key long, node long")


def _stars(keyed: DataFrame) -> DataFrame:
    """(pivot, node, shared): every node of a key but the least, with the least one, and the
    number of keys for which that holds. The rows come sorted, so a key's pivot is its
    first row and nothing is gathered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_pivot = last_node = None
        for batch in batches:
            key, node = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(key):
                continue
            new = np.append(last_key is None or key[0] != last_key, key[1:] != key[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            pivot = np.where(first >= 0, node[first], last_pivot if last_pivot is not None else 0)
            again = np.append(not new[0] and node[0] == last_node, ~new[1:] & (node[1:] == node[:-1]))
            pick = ~new & ~again & (node != pivot)
            last_key, last_pivot, last_node = key[-1], pivot[-1], node[-1]
            if pick.any():
                yield pa.RecordBatch.from_arrays([pa.array(pivot[pick]), pa.array(node[pick])], names=["pivot", "node"])

    pairs = keyed.repartition(F.col("key")).sortWithinPartitions("key", "node").mapInArrow(run, "pivot long, node long")
    return pairs.groupBy("pivot", "node").agg(F.count(F.lit(1)).alias("shared"))


def _grouped(stars: DataFrame, nodes: DataFrame) -> DataFrame:
    """(grp, node, shared, n): the nodes of every pivot, itself included. Nodes that share a
    key are in the group of its pivot together."""
    pivots = stars.groupBy("pivot").agg(F.max("shared").alias("shared")).select(F.col("pivot").alias("grp"), F.col("pivot").alias("node"), "shared")
    return stars.select(F.col("pivot").alias("grp"), "node", "shared").union(pivots).join(nodes.select("node", "n"), "node")


def _near(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    def side(x):
        return nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            ok = [may_link(sa, sb, na, nb, threshold) for _, _, na, nb, sa, sb in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return sized.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, text_col: str, words: int) -> DataFrame:
    """(node, hashes) of the wanted nodes. A bitmap of bounded size keeps most other
    nodes' sets from leaving their task; the join makes it exact."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_set(wanted, F.pmod("node", F.lit(BITMAP)), BITMAP))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed, sent = np.unpackbits(shared.value, bitorder="little").astype(bool), set()
        for batch in batches:
            for _, texts in text_groups(batch, GROUP):
                nodes, sets = [], []
                for s in shingle_sets(texts, words):
                    node = node_of(s) if len(s) else None
                    if node is None or not allowed[node % BITMAP] or node in sent:
                        continue
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(node)
                    nodes.append(node)
                    sets.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    made = _documents(docs, text_col, text_col).select(F.lit(None).cast("long").alias("doc_id"), "text").mapInArrow(run, "node long, hashes binary")
    return made.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _stored_sets(docs: DataFrame, wanted: DataFrame, text_col: str, words: int) -> DataFrame:
    """The sets, stored by node, so that joins on it don't move them again."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(_sets(docs, wanted, text_col, words).repartition(parts, "node"))


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, by their exact sets."""
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("h_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("h_a")), "a").select("a", "b", "h_a", "h_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("h_a"), batch.column("h_b"), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                ok.append(links(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of undirected edges (a, b); the component is its
    least node. Alternating large-star and small-star steps, each a grouped minimum
    and a join, until nothing changes."""
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # b is less than a in every edge from here on
        large = cut(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
        now = cut(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct())


def _divided(members: DataFrame, found: DataFrame) -> DataFrame:
    """(grp, node, shared, n, component, blocks) of the groups whose nodes are in several components."""
    rows = members.select("grp", "node", "shared", "n").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_TOKENS))).cast("int")
    several = (rows.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.alias("blocks"))
               .filter("lo <> hi").select("grp", "blocks"))
    return rows.join(several, "grp")


def _other_stars(members: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of each group's pivot in this round with its nodes of other components.
    Pivots are the least by a hash that changes with the round."""
    order = F.xxhash64("node", F.lit(number))
    pivot = members.groupBy("grp").agg(F.min(F.struct(order.alias("o"), F.col("node"), F.col("component"))).alias("p"))
    both = members.join(pivot, "grp").filter(F.col("component") != F.col("p.component"))
    return _best_pivots(both.groupBy(F.col("p.node").alias("pivot"), "node").agg(F.sum("shared").alias("shared")))


def _best_pivots(stars: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b: every node with the pivot that it shares most keys with."""
    best = stars.groupBy("node").agg(F.max(F.struct("shared", "pivot")).alias("p")).select("node", F.col("p.pivot").alias("pivot"))
    return best.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _forest(members: DataFrame, values: DataFrame, threshold: int, exact: bool) -> DataFrame:
    """(grp, a, b), a < b: within each group's blocks, pairs that join the nodes of different
    components as far as any pairs do. `values` has each node's sketch, and the pairs are
    those that sizes and sketches allow; if `exact`, its hashes, and the pairs link."""
    rows = members.select("grp", "node", "component", "n", "blocks").join(values.toDF("node", "value"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A large group's nodes are split; each two blocks meet in one part.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = ["grp", "left", "right", "block", "node", "component", "n", "value"]
    rows = rows.withColumn("other", other).withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other")).select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # rows of a part that may go on in the next batch
        last = None
        for batch in batches:
            if not len(batch):
                continue
            part = np.stack([batch.column(i).to_numpy() for i in range(3)])
            new = np.flatnonzero((part[:, 1:] != part[:, :-1]).any(axis=0)) + 1
            bounds = [0, *new.tolist(), len(batch)]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                here = tuple(part[:, lo].tolist())
                if rest and here != last:
                    yield _forest_of(pa.Table.from_batches(rest), threshold, exact)
                    rest = []
                rest.append(batch.slice(lo, hi - lo))
                last = here
        if rest:
            yield _forest_of(pa.Table.from_batches(rest), threshold, exact)

    dealt = rows.repartition(F.col("grp"), F.col("left"), F.col("right")).sortWithinPartitions("grp", "left", "right")
    return dealt.mapInArrow(run, "grp long, a long, b long")


def _forest_of(part: pa.Table, threshold: int, exact: bool) -> pa.RecordBatch:
    """The forest of one part: all nodes of a block, or those of two blocks against each other."""
    sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for c in part.column("value").chunks for v in c] if exact else []
    sketches = [parity_sketch(s) for s in sets] if exact else part.column("value").to_pylist()
    size = np.array([len(x) for x in sketches])
    order = np.argsort(size, kind="stable")
    size = size[order]
    block, node, label, n = (part.column(c).to_numpy()[order] for c in ("block", "node", "component", "n"))
    label, crossed = label.copy(), part.column("left")[0] != part.column("right")[0]
    out: list[tuple[int, int]] = []
    for width in np.unique(size).tolist():
        # sizes of linked sets are less than twice apart, and so are those of their sketches
        lo, mid, hi = np.searchsorted(size, [width, width + 1, 2 * width + 1]).tolist()
        bits = np.frombuffer(b"".join(_folded(sketches[k], width).to_bytes(width, "little") for k in order[lo:hi]), dtype=np.uint64).reshape(hi - lo, -1)
        for i in range(lo, mid):
            ok = (label[i + 1:hi] != label[i]) & (100 * np.minimum(n[i + 1:hi], n[i]) >= threshold * np.maximum(n[i + 1:hi], n[i]))
            if crossed:
                ok &= block[i + 1:hi] != block[i]
            at = np.flatnonzero(ok) + i + 1
            if not len(at):
                continue
            apart = np.bitwise_count(bits[at - lo] ^ bits[i - lo]).sum(axis=1, dtype=np.int64)
            near = apart <= (n[at] + n[i]) * (100 - threshold) // (100 + threshold)
            for k in at[near][np.argsort(apart[near], kind="stable")].tolist():
                if label[k] == label[i]:
                    continue  # joined meanwhile
                if exact and not links(len(np.intersect1d(sets[order[i]], sets[order[k]], assume_unique=True)), n[i], n[k], threshold):
                    continue
                out.append((i, k))
                label[label == label[k]] = label[i]
    a, b = node[np.array(out, dtype=np.int64).reshape(-1, 2)].T
    grp = np.full(len(out), part.column("grp")[0].as_py(), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(grp), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["grp", "a", "b"])


def node_components(docs: DataFrame, nodes: DataFrame, text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(node, component) of the nodes that link with another one."""
    stars = cut(_stars(_keyed(docs, text_col, words, threshold)))
    near = cut(_near(_best_pivots(stars), nodes, threshold))
    known = cut(_ends(near))
    sets = _stored_sets(docs, known, text_col, words)
    found = cut(components(_linked(near, sets, threshold)))
    members = _grouped(stars, nodes)
    # The further rounds take the nodes that were near another one; the end takes all.
    few = cut(nodes.join(known, "node", "left_semi"))
    divided = cut(_divided(members.join(known, "node", "left_semi"), found))
    for number in range(ROUNDS):
        more = cut(_linked(_near(_other_stars(divided, number), few, threshold), sets, threshold))
        if more.isEmpty():
            break
        found = _joined(found, more)
        divided = cut(_divided(divided, found))
    members = cut(_divided(members, found))
    rest = cut(_forest(members, nodes.select("node", "sketch"), threshold, False))
    if rest.isEmpty():
        return found
    missing = cut(_ends(rest).join(known, "node", "left_anti"))
    if not missing.isEmpty():
        sets = sets.union(_stored_sets(docs, missing, text_col, words))
    found = _joined(found, cut(_linked(rest.select("a", "b").distinct(), sets, threshold)))
    # Every node that may have another link is known or in the forest.
    divided = cut(_divided(members.join(rest.select("grp").distinct(), "grp", "left_semi").join(known.union(missing), "node", "left_semi"), found))
    return _joined(found, cut(_forest(divided, sets, threshold, True).select("a", "b")))


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components after some more links."""
    return found if more.isEmpty() else cut(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)))


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: int, with_key: bool = False) -> DataFrame:
    """Rows of shingled() with `component`, a node (null for an empty set)."""
    if not 50 < threshold <= 100:
        raise ValueError("the threshold is a percentage over 50")
    rows = cut(shingled(docs, id_col, text_col, words, with_key))
    nodes = cut(rows.filter("node is not null").select("node", "n", "sketch").dropDuplicates(["node"]))
    found = node_components(docs, nodes, text_col, words, threshold)
    return rows.drop("sketch").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable
    over links, its own included).

    Two documents link when the intersection of their shingle sets is at least
    `threshold` percent of the union. A null text, or one without words, has an empty
    set and its own id as component; equal sets always link, so repeated rows share
    a component; null ids are ignored by the minimum unless a component has no other.
    An empty table gives no rows; columns other than the two named are ignored,
    whatever their names. Shingles and sets are told apart by 64-bit hashes.
    """
    rows = cut(_labelled(docs, id_col, text_col, words, threshold))
    least = cut(rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1"))
    return rows.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """`docs`, all columns, with one document of each component: the one with the
    least id (null ids last). Documents without words all stay."""
    rows = cut(_labelled(docs, id_col, text_col, words, threshold, with_key=True))
    first = rows.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key"))).alias("best")).select("best.key")
    keys = first.union(rows.filter("component is null").select("key"))
    return keep_rows(docs, keys, row_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))), text_col)
