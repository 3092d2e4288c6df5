"""Mixing sources to target weights by min-cost flow (operator 4).

A document may belong to several sources. Documents are aggregated by membership
pattern (the set of their sources); a flow network sends words from patterns to
sources: each pass over a pattern's documents is an arc with the pattern's size as
capacity, and later passes cost more (convex), so nothing is repeated while fresh
words are left; each source's arc to the sink has its target as capacity. The flow
of least cost says how many words of each pattern the mix takes, and documents are
then selected in a seeded order until that many words are reached; the document at
the limit is taken in part.

Only the table of patterns and their sizes reaches the driver: at most MAX_PATTERNS
rows, else ValueError. Selection is distributed: seeded hashes fall into BUCKETS
ranges, sums per range find the one where the limit lies, and only that range is
ordered.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut

#: Mixture parameters: weights by order of source, share of all words, passes.
WEIGHTS, SHARE, PASSES, SEED = (3, 1, 2), 1.5, 2, 0
MAX_PATTERNS = 100_000
#: Hex digits of the seeded hash that name a range.
DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, total: int | None = None) -> dict[object, float]:
    """Words wanted of each source. Sources by code point, null last, weigh `weights`,
    repeating, and divide `share` of `total` words (by default of all sizes); none
    gets over `passes` times its own size, and what exceeds that is divided anew.

    In the order of size by weight those at their limit come first, so one pass
    finds them.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, w_left = share * (sum(sizes.values()) if total is None else total), sum(weight.values())
    out: dict[object, float] = {}
    queue = deque(sorted(names, key=lambda s: (sizes[s] / weight[s], s is None, s or "")))
    while queue and passes * sizes[queue[0]] * w_left < left * weight[queue[0]]:
        s = queue.popleft()
        out[s] = float(passes * sizes[s])
        left -= out[s]
        w_left -= weight[s]
    for s in queue:
        out[s] = min(left * weight[s] / w_left, float(passes * sizes[s]))
    return out


def min_cost_flow(sizes: list[int], members: list[list[int]], quotas: list[int], passes: int = PASSES) -> list[int]:
    """Words taken of each pattern. Pattern p has `passes` arcs of capacity sizes[p]
    at costs 0, 1, ..; members[p] are its sources; quotas are the sources' limits.

    Primal-dual: shortest distances, then all flow along shortest paths (level by
    level), until the sink can't be reached.
    """
    n_p, n_s = len(sizes), len(quotas)
    source, sink, n = n_p + n_s, n_p + n_s + 1, n_p + n_s + 2
    heads: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []

    def arc(a, b, capacity, price):
        for x, y, c, w in ((a, b, capacity, price), (b, a, 0, -price)):
            heads[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(w)

    for p in range(n_p):
        for k in range(passes):
            arc(source, p, sizes[p], k)
        for s in members[p]:
            arc(p, n_p + s, passes * sizes[p], 0)
    for s in range(n_s):
        arc(n_p + s, sink, quotas[s], 0)
    far = passes * n + 1
    while True:
        dist, queued, queue = [far] * n, [False] * n, deque([source])
        dist[source] = 0
        while queue:
            a = queue.popleft()
            queued[a] = False
            for e in heads[a]:
                if room[e] and dist[a] + cost[e] < dist[to[e]]:
                    dist[to[e]] = dist[a] + cost[e]
                    if not queued[to[e]]:
                        queued[to[e]] = True
                        queue.append(to[e])
        if dist[sink] == far:
            break
        while True:  # all flow over arcs on shortest paths
            level, queue = [-1] * n, deque([source])
            level[source] = 0
            while queue:
                a = queue.popleft()
                for e in heads[a]:
                    b = to[e]
                    if room[e] and level[b] < 0 and dist[b] == dist[a] + cost[e]:
                        level[b] = level[a] + 1
                        queue.append(b)
            if level[sink] < 0:
                break
            next_arc, path, at = [0] * n, [], source
            while True:
                if at == sink:
                    pushed = min(room[e] for e in path)
                    for e in path:
                        room[e] -= pushed
                        room[e ^ 1] += pushed
                    k = next(i for i, e in enumerate(path) if not room[e])
                    at, path = to[path[k] ^ 1], path[:k]
                    continue
                while next_arc[at] < len(heads[at]):
                    e = heads[at][next_arc[at]]
                    b = to[e]
                    if room[e] and level[b] == level[at] + 1 and dist[b] == dist[at] + cost[e]:
                        path.append(e)
                        at = b
                        break
                    next_arc[at] += 1
                else:
                    if at == source:
                        break
                    back = path.pop()
                    at = to[back ^ 1]
                    next_arc[at] += 1
    return [sum(room[e] for e in heads[p] if to[e] == source) for p in range(n_p)]


def mix(docs: DataFrame, sources: Column | None = None, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """One row per document: doc_id, sources, size, source_size, target, taken.

    `sources` is the document's source or array of sources (default: the column
    `source`); a null source is a source of its own, an empty array means none and
    is never taken. source_size and target are sums over the document's sources.
    `taken` counts words, repeats included, from 0 to `passes` times the size; the
    words taken of each source add up to its target, rounded, as far as overlapping
    sources allow. Null texts have size 0 and are never taken. Rows that repeat an
    id are selected on their own; order and result depend on the rows and the seed
    alone. An empty table gives no rows; other columns are ignored, whatever their
    names; `keep` may name one (a struct) to carry along.
    """
    spark = docs.sparkSession
    member = F.col("source") if sources is None else sources
    if not docs.select(member.alias("m")).schema["m"].dataType.simpleString().startswith("array"):
        member = F.array(member.cast("string"))
    # Hex digest of seed and id; rows that share it are told apart by size alone.
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.array_sort(F.array_distinct(member.cast("array<string>"))).alias("sources"),
                        n_words(F.col(text_col)).alias("size"), order.alias("_order"), F.substring(order, 1, DIGITS).alias("_range"),
                        *([keep.alias("carried")] if keep is not None else []))
    rows = cut(every.drop("carried"))
    patterns = rows.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} sets of sources; merge rare sources first")
    patterns.sort(key=lambda r: [(s is None, s or "") for s in r["sources"] or []])
    by_source: dict = {}
    for r in patterns:
        for s in r["sources"] or []:
            by_source[s] = by_source.get(s, 0) + r["size"]
    wanted = targets(by_source, weights, share, passes, sum(r["size"] for r in patterns))
    names = list(by_source)
    place = {s: i for i, s in enumerate(names)}
    flow = min_cost_flow([r["size"] for r in patterns], [[place[s] for s in r["sources"] or []] for r in patterns],
                         [int(wanted[s] + 0.5) for s in names], passes)
    plan = [(i, r["sources"], sum(by_source[s] for s in r["sources"] or []), float(sum(wanted[s] for s in r["sources"] or [])),
             *(divmod(f, r["size"]) if r["size"] else (0, 0))) for i, (r, f) in enumerate(zip(patterns, flow, strict=True))]
    plan = spark.createDataFrame(plan, "pattern int, _sources array<string>, source_size long, target double, whole long, rest long")

    def planned(x):
        return x.join(F.broadcast(plan), F.col("sources").eqNullSafe(F.col("_sources"))).drop("_sources")

    before = Window.partitionBy("pattern").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (planned(rows).filter("rest > 0").groupBy("pattern", "rest", "_range").agg(F.sum("size").alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))))
    # One range per pattern: the one in which the rest runs out.
    limits = cut(ranges.filter("_before < rest and rest <= _before + _sum")
              .select(F.col("pattern").alias("_pattern"), F.col("_range").alias("_limit"), "_before"))
    # The text, if carried along, is read again rather than written and moved.
    rows = planned(rows if keep is None else every).join(F.broadcast(limits), F.col("pattern") == F.col("_pattern"), "left")
    within = Window.partitionBy("pattern").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_limit = rows.filter("_range = _limit").withColumn(
        "_extra", F.least("size", F.greatest(F.lit(0), F.col("rest") - F.col("_before") - F.coalesce(F.sum("size").over(within), F.lit(0)))))
    others = rows.filter("_limit is null or _range <> _limit").withColumn(
        "_extra", F.when(F.col("_range") < F.col("_limit"), F.col("size")).otherwise(F.lit(0)))
    names = ["doc_id", "sources", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("_extra")).cast("long").alias("taken")]
    return others.unionByName(at_limit).select(*names, *(["carried"] if keep is not None else []))


def mixed_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs`, all columns, each document as often as the mix takes it (0 to `passes`
    times; one taken in part counts if at least half is). Null and empty texts and texts
    without a word have size 0 and are left out; a null source is a source of its own;
    rows that repeat an id count on their own; an empty table gives no rows."""
    mixed = mix(docs, F.col(source_col), id_col=id_col, text_col=text_col, keep=F.struct(*[F.col(c) for c in docs.columns]), **options)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")).otherwise(F.lit(0))
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).select("carried.*")
