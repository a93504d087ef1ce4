"""Vector code compression: integer k-means per part of the vectors, with Drake-Hamerly adaptive bounds.

Each part of a vector keeps its entry, a lower bound on the distance to each of its next b closest entries, in
ascending order, and one outer bound on all others. Entries move between rounds, bounds are shifted by the moves, and
only entries whose bound does not exceed the distance to the own entry are looked at again, in integers. b falls to
what a round needed. Bounds are stored with the vectors; entries, 256 a part, are all that tasks and driver share.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1_024
FIRST_BOUNDS = 32
LEAST_BOUNDS = 4
NEED_SHARE = 0.01  # of the parts, which may need more than b bounds and are then compared with every entry
LARGEST = 2**53  # integers of a larger size are taken as this
EXACT = 2**53  # squared distances below this are exact in doubles; larger ones are taken in Python's integers
BATCH = 4_096
SLACK = 1e-6  # relative; far more than the rounding of bounds


@dataclass(frozen=True)
class Codebooks:
    """Per vector length: entries[part][entry] as tuples of integers."""

    entries: dict[int, list[list[tuple[int, ...]]]]

    def sha256(self, dims: int) -> str:
        """Of all decimal components by part, entry and position, comma-joined."""
        numbers = [str(x) for part in self.entries[dims] for entry in part for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def integers(vectors) -> np.ndarray:
    """floor(1024 * x) of the components, cut into parts of equal length (missing places 0): rows x parts x places."""
    matrix = np.stack([np.asarray(v, np.float64) for v in vectors])
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(matrix * SCALE), -LARGEST, LARGEST).astype(np.int64)
    places = -(-whole.shape[1] // PARTS)
    return np.pad(whole, ((0, 0), (0, places * PARTS - whole.shape[1]))).reshape(len(whole), PARTS, places)


def _sized(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as longs, or as Python's integers where a squared distance might not fit ``EXACT``."""
    largest = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    return (x, entries) if 4 * largest**2 * max(x.shape[1], 1) < EXACT else (x.astype(object), entries.astype(object))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``a`` and ``b``."""
    return ((a - b) ** 2).sum(1)


def _all_squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry."""
    if x.dtype == object:
        return np.stack([_squared(x, e[None]) for e in entries], 1)
    a, b = x.astype(np.float64), entries.astype(np.float64)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]


def _roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def _below(values: np.ndarray) -> np.ndarray:
    """As single precision, never above the value."""
    single = values.astype(np.float32)
    return np.where(single.astype(np.float64) > values, np.nextafter(single, np.float32(-np.inf)), single)


class Bounds:
    """Of one part of a batch: own entry, next entries by ascending lower bound, outer bound; one row per vector."""

    def __init__(self, own: np.ndarray, nearest: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.own, self.nearest, self.low, self.outer = own, nearest, low, outer

    @classmethod
    def of_all(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """From the distances to every entry; equal distances by index."""
        squared = _all_squared(*_sized(x, entries))
        order = np.argsort(squared, axis=1, kind="stable")
        roots = _roots(np.take_along_axis(squared, order, 1))
        outer = roots[:, b + 1] if len(entries) > b + 1 else np.full(len(x), np.inf)
        return cls(order[:, 0], order[:, 1 : b + 1], roots[:, 1 : b + 1], outer)

    def moved(self, moves: np.ndarray) -> None:
        """Shift by how far the entries moved; bounds stay ascending and below the outer one."""
        self.outer = self.outer - moves.max(initial=0.0)
        low = np.concatenate([self.low - moves[self.nearest], self.outer[:, None]], 1)
        self.low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1][:, :-1]

    def verified(self, x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Set each row's own entry to the nearest, lower index first: exact squared distances, and how many bounds were needed."""
        x, entries = _sized(x, entries)
        squared = _squared(x, entries[self.own])
        reach = _roots(squared) * (1 + SLACK) + SLACK
        needed = (self.low <= reach[:, None]).sum(1)
        whole = self.outer <= reach
        some = np.flatnonzero((needed > 0) & ~whole)
        width = int(needed[some].max(initial=0))
        if width:
            # The own entry and the first bounds, exactly; the others of the row keep their bounds.
            mine = np.concatenate([self.own[some, None], self.nearest[some, :width]], 1)
            asked = np.arange(width + 1)[None] <= needed[some, None]
            row, column = np.nonzero(asked)
            exact = np.zeros(mine.shape, squared.dtype)
            exact[row, column] = _squared(x[some][row], entries[mine[row, column]])
            bound = np.concatenate([np.zeros((len(some), 1)), self.low[some, :width]], 1)
            bound[row, column] = _roots(exact[row, column])
            best = exact[:, 0].copy()
            place = np.zeros(len(some), np.int64)
            for j in range(1, width + 1):
                open_ = np.flatnonzero(asked[:, j])
                less = exact[open_, j] < best[open_]
                tie = (exact[open_, j] == best[open_]) & (mine[open_, j] < mine[open_, place[open_]])
                won = open_[(less | tie).astype(bool)]
                best[won], place[won] = exact[won, j], j
            rows = np.arange(len(some))
            self.own[some], squared[some] = mine[rows, place], best
            # The winner leaves the list, the former own entry joins it; ascending again.
            mine[rows, place], bound[rows, place] = mine[:, 0].copy(), bound[:, 0].copy()
            nearest = np.concatenate([mine[:, 1:], self.nearest[some, width:]], 1)
            low = np.concatenate([bound[:, 1:], self.low[some, width:]], 1)
            order = np.argsort(low, axis=1, kind="stable")
            self.nearest[some] = np.take_along_axis(nearest, order, 1)
            self.low[some] = np.take_along_axis(low, order, 1)
            self.low = np.minimum(self.low, self.outer[:, None])
        rest = np.flatnonzero(whole)
        if len(rest):
            new = Bounds.of_all(x[rest], entries, self.nearest.shape[1])
            self.own[rest], self.nearest[rest], self.low[rest], self.outer[rest] = new.own, new.nearest, new.low, new.outer
            squared[rest] = _squared(x[rest], entries[new.own])
        needed[whole] = len(entries)
        return squared, needed

    def packed(self, b: int) -> list[bytes]:
        """One binary value per row, with the first ``b`` bounds; the next one becomes the outer bound."""
        outer = self.low[:, b] if self.low.shape[1] > b else self.outer
        fields = [("own", "<u2"), ("outer", "<f4"), ("nearest", "<u2", (min(b, self.low.shape[1]),)), ("low", "<f4", (min(b, self.low.shape[1]),))]
        rows = np.empty(len(self.own), np.dtype(fields))
        rows["own"], rows["outer"] = self.own, _below(outer)
        rows["nearest"], rows["low"] = self.nearest[:, :b], _below(self.low[:, :b])
        return [r.tobytes() for r in rows]

    @classmethod
    def unpacked(cls, values: list[bytes], entries: int) -> Bounds:
        b = (len(values[0]) - 6) // 6
        fields = [("own", "<u2"), ("outer", "<f4"), ("nearest", "<u2", (b,)), ("low", "<f4", (b,))]
        rows = np.frombuffer(b"".join(values), np.dtype(fields))
        return cls(rows["own"].astype(np.int64), rows["nearest"].astype(np.int64), rows["low"].astype(np.float64), rows["outer"].astype(np.float64))


def valid(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, label and vector of the rows whose vector has finite components only."""
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)))


def first_entries(rows: DataFrame, entries: int = ENTRIES) -> dict[int, list[list[tuple[int, ...]]]]:
    """The parts of the vectors of the smallest keys, for each vector length; equal keys by vector, null keys last.

    Lengths are told apart by partial aggregates of at most ``entries`` rows each.
    """
    smallest = Window.partitionBy("dims").orderBy(F.col("key").asc_nulls_last(), "vector")
    ranked = rows.withColumn("dims", F.size("vector")).withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= entries)
    found: dict[int, list] = {}
    for r in ranked.select("dims", "place", "vector").collect():
        found.setdefault(r.dims, []).append((r.place, r.vector))
    out = {}
    for dims, some in found.items():
        parts = integers([v for _, v in sorted(some, key=lambda p: p[0])])
        out[dims] = [[tuple(map(int, e)) for e in parts[:, p]] for p in range(PARTS)]
    return out


def _arrays(books: dict[int, list]) -> dict[int, list[np.ndarray]]:
    return {d: [np.array(part, np.int64).reshape(len(part), -1) for part in parts] for d, parts in books.items()}


def _assigned(state: DataFrame, books: dict, moves: dict | None, bounds: int, first: bool) -> DataFrame:
    """``state`` with bounds for the entries of ``books``, squared distances, and the bounds that each part needed."""
    shared = state.sparkSession.sparkContext.broadcast((_arrays(books), moves))
    state = state.select("key", "label", "vector", *([] if first else [f"bounds{p}" for p in range(PARTS)]))

    def assign(batches):
        arrays, moved = shared.value
        for batch in batches:
            for dims, own in batch.groupby(batch["vector"].map(len), sort=True):
                for low in range(0, len(own), BATCH):
                    some = own.iloc[low : low + BATCH]
                    x = integers(some["vector"])
                    out = some[["key", "label", "vector"]].copy()
                    total = np.zeros(len(some), object)
                    for p in range(PARTS):
                        entries = arrays[dims][p]
                        if first:
                            part = Bounds.of_all(x[:, p], entries, bounds)
                            wide, wide_entries = _sized(x[:, p], entries)
                            squared, needed = _squared(wide, wide_entries[part.own]), np.full(len(some), -1)
                        else:
                            part = Bounds.unpacked(some[f"bounds{p}"].tolist(), len(entries))
                            part.moved(moved[dims][p])
                            squared, needed = part.verified(x[:, p], entries)
                        out[f"bounds{p}"] = part.packed(bounds)
                        out[f"code{p}"] = part.own.astype(np.int32)
                        out[f"needed{p}"] = needed.astype(np.int32)
                        total = total + squared
                    out["error"] = [min(int(e), 2**63 - 1) for e in total]
                    yield out

    fields = ", ".join(f"bounds{p} binary, code{p} int, needed{p} int" for p in range(PARTS))
    kinds = dict(state.dtypes)
    schema = f"key {kinds['key']}, label {kinds['label']}, vector array<double>, {fields}, error long"
    return state.mapInPandas(assign, schema)


def _moved_entries(state: DataFrame, books: dict) -> tuple[dict, dict]:
    """Every entry at the floor of the mean of its parts, unused ones as they are; and how far each entry moved."""

    def summed(batches):
        import pandas as pd

        # One row per entry and part of each length, in Python integers: exact at any size.
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for dims, own in batch.groupby(batch["vector"].map(len)):
                for low in range(0, len(own), BATCH):
                    some = own.iloc[low : low + BATCH]
                    x = integers(some["vector"])
                    for p in range(PARTS):
                        code = some[f"code{p}"].to_numpy()
                        order = np.argsort(code, kind="stable")
                        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
                        sums = np.add.reduceat(x[order, p].astype(object) if np.abs(x).max(initial=0) > 2**40 else x[order, p], starts, axis=0)
                        counts = np.diff(np.append(starts, len(code)))
                        for c, s, n in zip(code[order][starts].tolist(), sums.tolist(), counts.tolist()):
                            t = totals.setdefault((dims, p, c), [0, [0] * len(s)])
                            t[0], t[1] = t[0] + n, [a + b for a, b in zip(t[1], s)]
        if totals:
            rows = [(d, p, c, n, i, Decimal(v)) for (d, p, c), (n, s) in totals.items() for i, v in enumerate(s or [0])]
            yield pd.DataFrame(rows, columns=["dims", "part", "entry", "n", "place", "total"])

    codes = ["vector", *[f"code{p}" for p in range(PARTS)]]
    partial = state.select(*codes).mapInPandas(summed, "dims int, part int, entry int, n long, place int, total decimal(38,0)")
    means = partial.groupBy("dims", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    after = {d: [[list(e) for e in part] for part in parts] for d, parts in books.items()}
    for r in means.collect():  # a row per component of the entries
        entry = after[r.dims][r.part][r.entry]
        if entry:
            entry[r.place] = int(r.total) // r.n
    new = {d: [[tuple(e) for e in part] for part in parts] for d, parts in after.items()}
    a, b = _arrays(books), _arrays(new)
    moves = {d: [_roots(_squared(*_sized(x, y))) * (1 + SLACK) for x, y in zip(a[d], b[d])] for d in books}
    return new, moves


def _bounds_needed(state: DataFrame, before: int) -> int:
    """The least b that enough parts got by with in the last round."""
    needed = F.explode(F.array(*[F.least(F.col(f"needed{p}"), F.lit(before)) for p in range(PARTS)])).alias("needed")
    counts = sorted((r.needed, r.n) for r in state.select(needed).groupBy("needed").agg(F.count("*").alias("n")).collect())  # at most b + 1 rows
    total, seen = sum(n for _, n in counts), 0
    for b, n in counts:
        seen += n
        if seen >= (1 - NEED_SHARE) * total:
            return max(LEAST_BOUNDS, min(before, b))
    return before


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS, bounds: int = FIRST_BOUNDS
) -> tuple[DataFrame, Codebooks]:
    """Per kept row: key, label, vector, code0 to code3, error (squared distances of the four parts); and the codebooks.

    Rows whose vector is null or holds null or non-finite components are dropped. Vectors of different lengths have codebooks of their
    own; a length not divisible by four is filled up with zeros. An entry is the floor of the mean of its parts; equal
    distances go to the lower index. Components beyond 2**53 / 1024 in size are taken as that, errors beyond a long as its
    largest. Rows with a null key never give first entries unless others are missing; repeated rows count each; other
    columns are ignored; an empty input gives no rows.
    """
    rows = stored(valid(vectors, key, vector, label), "vectors")
    books = first_entries(rows, entries)
    state, moves, b = rows, None, bounds
    for number in range(rounds + 1):
        state = stored(_assigned(state, books, moves, b, number == 0), "bounds")
        if number == rounds or not books:
            break
        b = b if number == 0 else _bounds_needed(state, b)
        books, moves = _moved_entries(state, books)
    return state.withColumnRenamed("key", key), Codebooks(books)


def coded(state: DataFrame, books: Codebooks, key: str = "vec_id") -> DataFrame:
    """Per row of ``compress``: key, code (two hex digits a part), error, label_error (of all rows with the label), codebooks_sha256."""
    codes = [F.lower(F.lpad(F.hex(f"code{p}"), 2, "0")) for p in range(PARTS)]
    # Sums in decimals, so that they can't overflow; given as longs.
    sums = state.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    sums = sums.withColumn("label_error", F.least("label_error", F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long"))
    hashes = F.create_map(*[F.lit(x) for d in sorted(books.entries) for x in (d, books.sha256(d))]) if books.entries else F.lit(None).cast("map<int,string>")
    return join_small(state, sums, ["label"]).select(
        key, F.concat(*codes).alias("code"), "error", "label_error", hashes[F.size("vector")].alias("codebooks_sha256")
    )
