"""Exact order statistics without a sort (quantiles, split points), by sketch and bracket.

One pass builds a mergeable quantile sketch (KLL) of every column; it tells between
which two values a rank must lie. The next pass counts the rows below that bracket
exactly and, if the bracket is small, its rows by value, where the rank is found by a
running sum; a large bracket is sketched once more. A pass leaves a
few hundredths of the rows in question whatever the distribution, so 10^7 rows take two
passes, 5 * 10^8 three and 10^10 four. Partial aggregates only: data is never moved or sorted.
A sketch may err with a small probability; the exact counts show it, and such a rank
is looked for again in a wider bracket.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch, and the rank error (as a share of the rows) that is allowed for.
SKETCH_K = 4096
ERROR = 0.003
#: Shares whose quantiles are read from a sketch where no rank is known beforehand.
GRID = [i / 64 for i in range(65)]
#: Expected rows of a bracket from which on they are counted by value, one task a bracket.
FEW = 1_000_000
#: Counted values (of all brackets) that come to the driver rather than to a window.
COLLECTED = 20_000


@dataclass
class Bracket:
    """Part of a column that holds some ranks: values in [lo, hi] (None: open), and the
    rows expected there, those that share the value of an end left out."""

    column: str
    lo: float | int | None
    hi: float | int | None
    rows: float
    ranks: list[int]


@dataclass
class Selected:
    """`rows` rows, `n` of them not null; rank (from 0) -> (value, rows below it, rows equal to it)."""

    rows: int
    n: int
    at: dict[int, tuple[float | int, int, int]]


def _grid(sketch: str, whole: bool, shares: list[float]) -> Column:
    kind = "bigint" if whole else "double"
    listed = ", ".join(f"{x!r}D" for x in shares)
    return F.expr(f"CASE WHEN kll_sketch_get_n_{kind}({sketch}) > 0 THEN kll_sketch_get_quantile_{kind}({sketch}, array({listed})) END")


def around(shares: list[float]) -> list[float]:
    """Shares to read where ranks near these are looked for."""
    return sorted({min(1.0, max(0.0, p + side * 1.5 * ERROR)) for p in shares for side in (-1, 1)})


def _brackets(column: str, shares: list[float], grid: list, n: int, below: int, ranks: list[int], error: float) -> list[Bracket]:
    """The brackets of these ranks in a sketch of n rows that have `below` rows before them."""
    found: dict[tuple[int, int], list[int]] = {}
    for r in ranks:
        share = (r - below + 0.5) / n
        ends = bisect.bisect_right(shares, share - error) - 1, bisect.bisect_left(shares, share + error)
        found.setdefault(ends, []).append(r)
    out = []
    for (i, j), some in found.items():
        left, right = shares[i] if i >= 0 else 0.0, shares[j] if j < len(shares) else 1.0
        out.append(Bracket(column, grid[i] if i >= 0 and left > 0 else None, grid[j] if j < len(shares) and right < 1 else None, n * (right - left + 2 * error), some))
    return out


def _inside(x: Column, b: Bracket) -> Column:
    out = x.isNotNull()
    if b.lo is not None:
        out = out & (x >= F.lit(b.lo))
    return out if b.hi is None else out & (x <= F.lit(b.hi))


class _Columns:
    """The columns of a selection as v0, v1, ..: NaN as null, whole numbers as long."""

    def __init__(self, df: DataFrame, columns: dict[str, Column]):
        kinds = df.select(*[c.alias(f"v{i}") for i, c in enumerate(columns.values())]).dtypes
        self.whole = {c: kind not in ("double", "float") for c, (_, kind) in zip(columns, kinds, strict=True)}
        self.at = {c: F.col(f"v{i}") for i, c in enumerate(columns)}
        self.rows = df.select(*[(x.cast("long") if self.whole[c] else F.nanvl(x.cast("double"), F.lit(None).cast("double"))).alias(f"v{i}")
                                for i, (c, x) in enumerate(columns.items())])

    def sketch(self, c: str, where: Column | None = None) -> Column:
        x = self.at[c] if where is None else F.when(where, self.at[c])
        return (F.kll_sketch_agg_bigint if self.whole[c] else F.kll_sketch_agg_double)(x, F.lit(SKETCH_K))


def _narrowed(cols: _Columns, todo: list[Bracket]) -> tuple[list[Bracket], list[tuple]]:
    """One pass over all these brackets: exact counts below, at the ends and between
    them, and a sketch of what is strictly between (a value that very many rows share
    would stay in every bracket otherwise). The narrower brackets, and the ranks that
    lie at an end as (column, rank, value, below, equal); ranks outside are left out."""
    aggs, grids = [], []
    for k, b in enumerate(todo):
        x, none = cols.at[b.column], F.lit(0).cast("long")
        between = x.isNotNull()
        if b.lo is not None:
            between = between & (x > F.lit(b.lo))
        if b.hi is not None:
            between = between & (x < F.lit(b.hi))
        aggs += [(none if b.lo is None else F.count(F.when(x < F.lit(b.lo), 1))).alias(f"b{k}"),
                 (none if b.lo is None else F.count(F.when(x == F.lit(b.lo), 1))).alias(f"l{k}"),
                 F.count(F.when(between, 1)).alias(f"n{k}"),
                 (none if b.hi is None or b.hi == b.lo else F.count(F.when(x == F.lit(b.hi), 1))).alias(f"h{k}"),
                 cols.sketch(b.column, between).alias(f"s{k}")]
        grids += [*(F.col(f"{c}{k}") for c in "blnh"), _grid(f"s{k}", cols.whole[b.column], GRID).alias(f"g{k}")]
    got = cols.rows.agg(*aggs).select(*grids).first()
    out, found = [], []
    for k, b in enumerate(todo):
        first, inner = got[f"b{k}"], got[f"b{k}"] + got[f"l{k}"]
        last = inner + got[f"n{k}"]
        found += [(b.column, r, b.lo, first, got[f"l{k}"]) for r in b.ranks if first <= r < inner]
        found += [(b.column, r, b.hi, last, got[f"h{k}"]) for r in b.ranks if last <= r < last + got[f"h{k}"]]
        ranks = [r for r in b.ranks if inner <= r < last]
        for new in _brackets(b.column, GRID, got[f"g{k}"], got[f"n{k}"], inner, ranks, ERROR) if ranks else []:
            new.lo, new.hi = b.lo if new.lo is None else new.lo, b.hi if new.hi is None else new.hi
            out.append(new)
    return out, found


def _picked(cols: _Columns, todo: list[Bracket]) -> list[tuple[str, int, float | int, int, int]]:
    """(column, rank, value, below, equal) of the ranks that lie in these brackets: the rows
    inside them counted by value and those below a bracket as one group, then running sums.
    Only the few rows inside are spread over their brackets."""
    cells, below, some = [], [], F.lit(False)
    for k, b in enumerate(todo):
        x, none = cols.at[b.column], F.lit(None)
        real, whole = (none, x) if cols.whole[b.column] else (x, none)
        inside = _inside(x, b)
        some = some | F.coalesce(inside, F.lit(False))
        cells.append(F.when(inside, F.struct(F.lit(k).alias("k"), real.cast("double").alias("real"), whole.cast("long").alias("whole"))))
        if b.lo is not None:
            below.append((k, F.count(F.when(x < F.lit(b.lo), 1))))
    cell = cols.rows.where(some).select(F.explode(F.filter(F.array(*cells), lambda s: s.isNotNull())).alias("s")).select("s.k", "s.real", "s.whole")
    counted = cell.groupBy("k", "real", "whole").agg(F.count(F.lit(1)).alias("n"))
    if below:
        ends = cols.rows.agg(F.array(*[F.struct(F.lit(k).alias("k"), n.alias("n")) for k, n in below]).alias("s")).select(F.explode("s").alias("s"))
        counted = counted.unionByName(ends.select("s.k", F.lit(None).cast("double").alias("real"), F.lit(None).cast("long").alias("whole"), "s.n"))
    if sum(b.rows for b in todo) <= COLLECTED:
        return _found(todo, counted.collect())
    # running sums in Spark: one task a bracket, of at most about FEW rows
    end = F.sum("n").over(Window.partitionBy("k").orderBy("real", "whole").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.lit(None).cast("array<long>")
    for k, b in enumerate(todo):
        wanted = F.when(F.col("k") == k, F.array(*[F.lit(r).cast("long") for r in b.ranks])).otherwise(wanted)
    rank = F.explode(F.filter(wanted, lambda r: (r >= F.col("end") - F.col("n")) & (r < F.col("end"))))
    rows = counted.withColumn("end", end).where("real is not null or whole is not null").select("k", "real", "whole", "n", "end", rank.alias("rank")).collect()
    return [(todo[r["k"]].column, r["rank"], r["whole"] if r["real"] is None else r["real"], r["end"] - r["n"], r["n"]) for r in rows]


def _found(todo: list[Bracket], counted: list) -> list[tuple[str, int, float | int, int, int]]:
    """The same from (k, real, whole, n) rows on the driver."""
    by_bracket: dict[int, list] = {}
    for k, real, whole, n in counted:
        value = whole if real is None else real
        by_bracket.setdefault(k, []).append((value is not None, 0 if value is None else value, n))
    out = []
    for k, rows in by_bracket.items():
        end = 0
        for known, value, n in sorted(rows):
            out += [(todo[k].column, r, value, end, n) for r in todo[k].ranks if known and end <= r < end + n]
            end += n
    return out


def select_ranks(df: DataFrame, columns: dict[str, Column], ranks: Callable[[str, int, int], list[int]],
                 shares: list[float] | None = None) -> dict[str, Selected]:
    """For each named column expression (long-like or double), the values at
    ranks(name, n, rows), n being its number of non-null values. A NaN counts as null.
    `shares` (see `around`) tells where the ranks lie, if that is known before n is."""
    shares = GRID if shares is None else shares
    cols = _Columns(df, columns)
    first = cols.rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count(cols.at[c]).alias(f"n{i}") for i, c in enumerate(columns)],
                          *[cols.sketch(c).alias(f"s{i}") for i, c in enumerate(columns)])
    first = first.select("rows", *[f"n{i}" for i in range(len(columns))], *[_grid(f"s{i}", cols.whole[c], shares).alias(f"g{i}") for i, c in enumerate(columns)]).first()
    out = {c: Selected(first["rows"], first[f"n{i}"], {}) for i, c in enumerate(columns)}
    wanted = {c: {r for r in ranks(c, s.n, s.rows) if 0 <= r < s.n} for c, s in out.items()}
    error = ERROR
    while True:
        todo = []
        for i, c in enumerate(columns):
            missing = sorted(wanted[c] - set(out[c].at))
            todo += _brackets(c, shares, first[f"g{i}"], out[c].n, 0, missing, error) if missing else []
        if not todo:
            return out
        while todo:
            small, large = [b for b in todo if b.rows <= FEW], [b for b in todo if b.rows > FEW]
            found = _picked(cols, small) if small else []
            todo, at_ends = _narrowed(cols, large) if large else ([], [])
            for c, rank, *rest in found + at_ends:
                out[c].at[rank] = tuple(rest)
        error = min(1.0, max(error, 0.001) * 8)


@dataclass
class _Cut:
    """A row looked for: its rank among the `rows` rows whose first keys have these values."""

    values: list
    rank: int
    rows: int
    ties: Column
    done: bool = False


def cut_points(df: DataFrame, order: list[Column], ranks: Callable[[int], list[int]]) -> list[list]:
    """For each rank of ranks(rows), the values of the row there (from 0) in the order of
    these long-like expressions, nulls last in each: the first one's value at that rank,
    then the second one's among its ties, and so on. All ranks are selected together, key
    by key. [] for a rank that no row has."""
    cuts: list[_Cut] = []
    for c in order:
        if not cuts:
            wanted: list[int] = []

            def first(_name: str, n: int, rows: int) -> list[int]:
                wanted[:] = ranks(rows)
                return [r for r in wanted if 0 <= r < n]

            one = select_ranks(df, {"": c}, first)[""]
            cuts = [_Cut([], r, one.rows, F.lit(True), not 0 <= r < one.rows) for r in wanted]
            found = {i: one for i in range(len(cuts))}
        else:
            still = {str(i): F.when(x.ties, c) for i, x in enumerate(cuts) if not x.done}
            if not still:
                break
            found = {int(k): v for k, v in select_ranks(df, still, lambda k, n, _: [cuts[int(k)].rank]).items()}
        for i, x in enumerate(cuts):
            if x.done:
                continue
            if x.rank >= found[i].n:  # among the nulls of this key
                x.values.append(None)
                x.ties, x.rank, x.rows = x.ties & c.isNull(), x.rank - found[i].n, x.rows - found[i].n
            else:
                value, below, equal = found[i].at[x.rank]
                x.values.append(value)
                x.ties, x.rank, x.rows = x.ties & F.coalesce(c == F.lit(value), F.lit(False)), x.rank - below, equal
            x.done = x.rows == 1
    return [x.values for x in cuts]


def cut_point(df: DataFrame, order: list[Column], rank: Callable[[int], int]) -> list:
    """The values of the row at rank(rows); see `cut_points`."""
    return cut_points(df, order, lambda n: [rank(n)])[0]


def before_or_at(order: list[Column], values: list) -> Column:
    """Whether a row's keys are lexicographically at most these values, nulls last
    (shorter lists leave later keys free). Never null."""
    if not values:
        return F.lit(False)
    out = F.lit(True)
    for c, v in reversed(list(zip(order, values, strict=False))):
        if v is None:
            out = c.isNotNull() | out
        else:
            out = F.coalesce(c < F.lit(v), F.lit(False)) | (F.coalesce(c == F.lit(v), F.lit(False)) & out)
    return out
