"""Exact quantiles and order statistics without sorting or moving the rows.

Quantiles take two scans. The first aggregate holds a KLL sketch of every column beside its moments; the sketch gives a grid
of values, and with it a narrow interval for every wanted rank. The second scan counts the rows below, between and at the grid's
values around the ranks, which proves where the ranks lie; the few values between neighbouring ones go along with their
counts, already summed per task, and only where a rank falls are they put in order. A rank that falls elsewhere gets a wider interval.

Order statistics of any type (dates, text, long integers) narrow an interval around the ranks by sketches, each proven by
counting, until it holds few distinct values. The driver sees a few numbers per rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import as_column, nan_to_null, project

SKETCH = 4_096  # ranks of a sketch are off by about 0.13 % of the rows
GRID = 1_024
MARGIN = 0.002  # of the rows, on either side of a rank
VALUE_LIMIT = 100_000
# Each round narrows an interval to about 4 / ACCURACY of its rows.
ACCURACY = 1_000
MAX_ROUNDS = 10


@dataclass(frozen=True)
class _Interval:
    """The values known to hold the neighbouring ranks ``first`` to ``last`` (0-based) of ``name``."""

    name: str
    first: int
    last: int
    low: object
    high: object
    below: int
    inside: int
    distinct: int

    @property
    def solved(self) -> bool:
        return self.low == self.high


def _inside(col: Column, iv: _Interval) -> Column:
    return (col >= F.lit(iv.low)) & (col <= F.lit(iv.high))


def _profile(df: DataFrame, exprs: Mapping[str, Column]) -> dict[str, tuple]:
    """Count, minimum, maximum and estimated distinct count of each expression."""
    row = df.agg(
        *[F.struct(F.count(e), F.min(e), F.max(e), F.approx_count_distinct(e)).alias(f"s{i}")
          for i, e in enumerate(exprs.values())]
    ).first()
    return {name: tuple(row[i]) for i, name in enumerate(exprs)}


def _narrowed(df: DataFrame, exprs: Mapping[str, Column], wide: Sequence[_Interval]) -> list[_Interval]:
    """A tighter interval for each of ``wide`` from a sketch, proven by counting; the old one if unproven."""
    shared: dict[tuple, list[_Interval]] = {}
    for iv in wide:
        shared.setdefault((iv.name, iv.low, iv.high), []).append(iv)
    aggs, shares = [], []
    for group in shared.values():
        margin = 2.0 / ACCURACY
        wanted = []
        for iv in group:
            wanted += [(iv.first - iv.below) / iv.inside - margin, (iv.last - iv.below + 1) / iv.inside + margin]
        col = F.when(_inside(exprs[group[0].name], group[0]), exprs[group[0].name])
        aggs.append(F.approx_percentile(col, [min(1.0, max(0.0, w)) for w in wanted], ACCURACY))
        shares.append(wanted)
    points = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()

    tried, old = [], []
    for g, group in enumerate(shared.values()):
        for i, iv in enumerate(group):
            low = iv.low if shares[g][2 * i] <= 0 else points[g][2 * i]
            high = iv.high if shares[g][2 * i + 1] >= 1 else points[g][2 * i + 1]
            tried.append(_Interval(iv.name, iv.first, iv.last, low, high, 0, 0, 0))
            old.append(iv)
    counts = []
    for iv in tried:
        col = exprs[iv.name]
        within = _inside(col, iv)
        counts.append(
            F.struct(
                F.count_if(col < F.lit(iv.low)), F.count_if(within), F.approx_count_distinct(F.when(within, col))
            )
        )
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    out = []
    for i, iv in enumerate(tried):
        below, inside, distinct = row[i]
        proven = below <= iv.first and iv.last < below + inside
        out.append(_Interval(iv.name, iv.first, iv.last, iv.low, iv.high, below, inside, distinct) if proven else old[i])
    return out


def _pick(df: DataFrame, exprs: Mapping[str, Column], intervals: Sequence[_Interval]) -> dict[tuple[str, int], object]:
    """Count the distinct values inside each interval and read off the values at its ranks."""
    cells = [
        F.when(_inside(exprs[iv.name], iv), F.struct(F.lit(i).alias("id"), exprs[iv.name].alias("v")))
        for i, iv in enumerate(intervals)
    ]
    counts = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy(F.col("cell.id").alias("id"), F.col("cell.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    running = Window.partitionBy("id").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)

    def rank(which: str) -> Column:
        ranks = [F.lit(getattr(iv, which) - iv.below) for iv in intervals]
        return F.element_at(F.array(*ranks), F.col("id") + 1)

    rows = (
        counts.withColumn("upto", F.sum("n").over(running))
        .groupBy("id")
        .agg(
            F.min(F.when(F.col("upto") > rank("first"), F.col("v"))).alias("first"),
            F.min(F.when(F.col("upto") > rank("last"), F.col("v"))).alias("last"),
        )
        .collect()
    )
    found = {}
    for r in rows:
        iv = intervals[r["id"]]
        found[iv.name, iv.first], found[iv.name, iv.last] = r["first"], r["last"]
    return found


def _spans(ranks: Sequence[int]) -> list[tuple[int, int]]:
    """Ranks as spans, two neighbouring ranks sharing one."""
    out: list[list[int]] = []
    for r in sorted(set(ranks)):
        if out and out[-1][0] == out[-1][1] == r - 1:
            out[-1][1] = r
        else:
            out.append([r, r])
    return [(a, b) for a, b in out]


def order_statistics(
    df: DataFrame,
    exprs: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    value_limit: int = VALUE_LIMIT,
    profile: Mapping[str, tuple] | None = None,
) -> dict[tuple[str, int], object]:
    """The value at each 0-based rank of each expression in ascending order, NULLs left out."""
    if not any(ranks.values()):
        return {}
    df, exprs = project(df, {n: exprs[n] for n in ranks})
    whole = profile or _profile(df, exprs)
    intervals = []
    for name, wanted in ranks.items():
        n, low, high, distinct = whole[name]
        if wanted and not 0 <= min(wanted) <= max(wanted) < n:
            raise ValueError(f"ranks {wanted} are not all within the {n} values of {name}")
        intervals += [_Interval(name, a, b, low, high, 0, n, distinct) for a, b in _spans(wanted)]

    for _ in range(MAX_ROUNDS):
        wide = [iv for iv in intervals if iv.distinct > value_limit and not iv.solved]
        if not wide:
            break
        tighter = _narrowed(df, exprs, wide)
        intervals = [iv for iv in intervals if iv not in wide] + tighter
        if set(tighter) == set(wide):
            break

    found = {(iv.name, r): iv.low for iv in intervals if iv.solved for r in (iv.first, iv.last)}
    types = {n: df.select(exprs[n].alias("e")).schema[0].dataType.simpleString() for n in ranks}
    by_type: dict[str, list[_Interval]] = {}
    for iv in intervals:
        if not iv.solved:
            by_type.setdefault(types[iv.name], []).append(iv)
    for group in by_type.values():
        found.update(_pick(df, exprs, group))
    return found


def _grid_of(e: Column, sketch: int) -> Column:
    """The values at ``GRID`` + 1 evenly spaced ranks, the first and last exact; NULL without values."""
    ranks = F.expr("array(" + ",".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")")
    return F.when(F.count(e) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(e, F.lit(sketch)), ranks))


def _held(spot: float, n: int, grid: Sequence[float], margin: float) -> Sequence[float]:
    """The grid's values around the ranks beside ``spot``."""
    share = spot / max(n - 1, 1)
    low, high = max(0, math.floor((share - margin) * GRID)), min(GRID, math.ceil((share + margin) * GRID))
    return grid[low : high + 1]


def exact_quantiles(
    df: DataFrame, exprs: Mapping[str, Column] | Sequence[str], probabilities: Sequence[float], sketch: int = SKETCH
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each expression; None for a column without values. NaN counts as missing."""
    if not isinstance(exprs, Mapping):
        exprs = {c: as_column(c) for c in exprs}
    return quantiles_with(df, exprs, probabilities, sketch=sketch)[0]


def quantiles_with(
    df: DataFrame,
    exprs: Mapping[str, Column],
    probabilities: Sequence[float],
    also: Callable[[Column], Column] | None = None,
    then: Callable[[str, Column, object], Column] | None = None,
    sketch: int = SKETCH,
) -> tuple[dict[str, list[float | None]], dict[str, object], dict[str, int]]:
    """Quantiles of each expression and, from the same two scans, an aggregate of each (``also``) and a count of rows.

    ``then`` gets the name, the expression and the result of ``also``, and gives the condition that is counted.
    """
    if not exprs:
        return {}, {}, {}
    df, cols = project(df, {name: nan_to_null(e.cast("double")) for name, e in exprs.items()})
    first = df.agg(
        F.count("*").alias("rows"), *[F.count(e).alias(f"n{i}") for i, e in enumerate(cols.values())],
        *[_grid_of(e, sketch).alias(f"g{i}") for i, e in enumerate(cols.values())],
        *([also(e).alias(f"a{i}") for i, e in enumerate(cols.values())] if also else []),
    ).first()
    n = {name: first[f"n{i}"] for i, name in enumerate(cols)}
    grid = {name: first[f"g{i}"] for i, name in enumerate(cols)}
    found_first = {name: first[f"a{i}"] for i, name in enumerate(cols)} if also else {}
    wanted = {name: [p * (n[name] - 1) for p in probabilities] for name in cols if n[name]}
    counted = {name: then(name, e, found_first.get(name)) for name, e in cols.items()} if then else {}

    values: dict[tuple[str, int], float] = {}
    found_second: dict[str, int] = dict.fromkeys(counted, 0)
    margin = MARGIN
    open_ = {(name, spot) for name, spots in wanted.items() for spot in spots}
    while open_ or counted:
        held = {name: [_held(s, n[name], grid[name], margin) for m, s in sorted(open_) if m == name] for name in wanted}
        ranks = {name: {r for m, s in open_ if m == name for r in (math.floor(s), math.ceil(s))} for name in wanted}
        picked, flagged = _picked(df, cols, {c: h for c, h in held.items() if h}, ranks, counted)
        found_second |= flagged
        counted = {}
        values |= picked
        open_ = {(name, s) for name, s in open_ if (name, math.floor(s)) not in values or (name, math.ceil(s)) not in values}
        margin = margin * 8 + 1 / GRID
    out: dict[str, list[float | None]] = {}
    for name in cols:
        out[name] = [None] * len(probabilities) if not n[name] else []
        for spot in wanted.get(name, []):
            low, high = values[name, math.floor(spot)], values[name, math.ceil(spot)]
            out[name].append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
    return out, found_first, found_second


def _picked(
    df: DataFrame,
    cols: Mapping[str, Column],
    held: Mapping[str, Sequence[Sequence[float]]],
    ranks: Mapping[str, set[int]],
    counted: Mapping[str, Column],
) -> tuple[dict[tuple[str, int], float], dict[str, int]]:
    """The values at those ranks that fall where ``held`` says, and how often the ``counted`` conditions hold; one scan.

    The held values cut a column into segments, odd ones for the cuts themselves and even ones between them. Each row adds
    its segment to the count; its value goes along only between neighbouring held values.
    """
    cuts = {name: sorted({v for some in h for v in some}) for name, h in held.items()}
    cells = []
    for i, (name, own) in enumerate(cuts.items()):
        e, at = cols[name], {c: k for k, c in enumerate(own)}
        inner = {2 * k for some in held[name] for k in range(at[some[0]] + 1, at[some[-1]] + 1)}
        segment = sum(((e > c).cast("int") + (e >= c).cast("int") for c in own[1:]), (e > own[0]).cast("int") + (e >= own[0]).cast("int"))
        cells.append(F.when(e.isNotNull(), F.struct(F.lit(i).alias("id"), segment.alias("segment"), e.alias("v"), F.lit(sorted(inner)).cast("array<int>").alias("inner"))))
    for i, condition in enumerate(counted.values()):
        none = F.lit(None).cast("double")
        cells.append(F.when(condition, F.struct(F.lit(-1 - i).alias("id"), F.lit(0).alias("segment"), none.alias("v"), F.array().cast("array<int>").alias("inner"))))
    kept = F.when(F.array_contains("c.inner", F.col("c.segment")), F.col("c.v"))
    counts = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
        .groupBy(F.col("c.id").alias("id"), F.col("c.segment").alias("segment"), kept.alias("v")).agg(F.count("*").alias("n"))
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most a row per segment.
        totals = sorted((r.id, r.segment, r.n) for r in counts.groupBy("id", "segment").agg(F.sum("n").alias("n")).collect())
        flagged = dict.fromkeys(counted, 0) | {name: n for i, name in enumerate(counted) for id_, _, n in totals if id_ == -1 - i}
        values: dict[tuple[str, int], float] = {}
        within = []
        for i, (name, own) in enumerate(cuts.items()):
            inner = {2 * k for some in held[name] for k in range(own.index(some[0]) + 1, own.index(some[-1]) + 1)}
            reached = 0
            for _, segment, n in [t for t in totals if t[0] == i]:
                for rank in ranks[name]:
                    if reached <= rank < reached + n and segment % 2:
                        values[name, rank] = own[segment // 2]
                    elif reached <= rank < reached + n and segment in inner:
                        within.append((i, segment, rank, rank - reached))
                reached += n
        names = list(cuts)
        return values | {(names[i], rank): v for i, rank, v in _values_at(counts, within)}, flagged
    finally:
        counts.unpersist()


def _values_at(counts: DataFrame, within: Sequence[tuple[int, int, int, int]]) -> list[tuple[int, int, float]]:
    """(id, rank, value) for each (id, segment, rank, rank within the segment), from the counts of the segments' values."""
    if not within:
        return []
    wanted = counts.sparkSession.createDataFrame(list(within), "id int, segment int, rank long, within long")
    running = Window.partitionBy("id", "segment").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    some = counts.join(F.broadcast(wanted.select("id", "segment").distinct()), ["id", "segment"], "left_semi")
    at = some.withColumn("upto", F.sum("n").over(running)).join(F.broadcast(wanted), ["id", "segment"]).where(F.col("upto") > F.col("within"))
    return [(r.id, r.rank, r.v) for r in at.groupBy("id", "rank").agg(F.min("v").alias("v")).collect()]  # a row per rank
