"""Exact top-k by inner product: queries and rows stand in cover trees that are walked together.

Rows are dealt into blocks around pivots, a cover tree is built in each, for queries and rows alike. Pairs
of blocks, then pairs of nodes, are dropped when the bound from centre product and covering radii stays
below the worst k-th score of the query group. A first round, at each query block's most promising row block,
gives the scores to beat.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import stored

TOP = 5
BLOCK = 4_096
QUERY_BLOCK = 512
MOST_PIVOTS = 1_024
LEAF = 64
BASE = 2.0
SCALE = 256
EXACT = 2.0**52


@dataclass
class Node:
    """Points (rows of the block's matrix) and child nodes under a centre; all lie within ``radius``."""

    centre: int
    radius: float
    points: np.ndarray
    children: list["Node"] = field(default_factory=list)


    def plain(self) -> tuple:
        """Builtin types only, for rows that are read without this module."""
        return self.centre, self.radius, self.points, [c.plain() for c in self.children]

    @staticmethod
    def of(plain: tuple) -> "Node":
        return Node(*plain[:3], [Node.of(c) for c in plain[3]])


def build(matrix: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree: child centres are over radius / BASE apart and cover all points within it; a node's
    centre is its first child's. Nodes of up to ``leaf`` points keep the points themselves."""
    floats = matrix.astype(np.float64)

    def distances(centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(((floats[members] - floats[centre]) ** 2).sum(1))

    everything = np.arange(len(floats))
    away = distances(0, everything)
    root = Node(0, float(away.max()), everything)
    stack = [(root, away)]
    while stack:
        node, away = stack.pop()
        members = node.points
        if len(members) <= leaf or node.radius == 0:
            continue
        reach, single = node.radius / BASE, []
        left = np.ones(len(members), bool)
        centre = node.centre
        while True:
            open_ = np.flatnonzero(left)
            far = away[open_] if centre == node.centre else distances(centre, members[open_])
            mine = far <= reach
            group = members[open_[mine]]
            left[open_[mine]] = False
            if len(group) == 1:
                single.append(int(group[0]))
            else:
                child = Node(centre, float(far[mine].max()), group)
                node.children.append(child)
                stack.append((child, far[mine]))
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            centre = int(members[rest[0]])
        node.points = np.array(single, np.int64)
    return root


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles where those are exact."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if size < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def search(
    queries: np.ndarray, query_ids: np.ndarray, query_tree: Node, rows: np.ndarray, row_ids: list[list[int]], row_tree: Node, k: int, worst: np.ndarray
) -> tuple[list[list[tuple[int, int]]], int]:
    """Per query its best (-score, id) of these rows that reach ``worst``, and the number of node pairs visited."""
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    bar = worst.astype(np.float64).copy()
    lengths = [np.sqrt((m.astype(np.float64) ** 2).sum(1)) for m in (queries, rows)]
    below: dict[int, np.ndarray] = {}

    def under(node: Node) -> np.ndarray:
        if id(node) not in below:
            below[id(node)] = np.concatenate([node.points, *[under(c) for c in node.children]]).astype(np.int64)
        return below[id(node)]

    under(query_tree)

    def offer(at: np.ndarray, of: np.ndarray, scores: np.ndarray) -> None:
        for i, q in enumerate(at.tolist()):
            line = scores[i]
            near = np.flatnonzero(line >= bar[q])
            if not len(near):
                continue
            if len(near) > k + 1:  # one of them may be the query itself
                edge = np.partition(line[near], len(near) - k - 1)[len(near) - k - 1]
                near = near[line[near] >= edge]
            own = int(query_ids[q])
            found = best[q] + [(-int(line[j]), r) for j in near.tolist() for r in row_ids[int(of[j])] if r != own]
            best[q] = sorted(found)[:k]
            if len(best[q]) == k:
                bar[q] = max(bar[q], -best[q][-1][0])

    visited = 0
    stack: list[tuple[float, Node | int, Node | int]] = [(np.inf, query_tree, row_tree)]
    while stack:
        bound, a, b = stack.pop()
        mine = np.array([a]) if isinstance(a, int) else under(a)
        if bound < bar[mine].min():
            continue
        visited += 1
        sides = []
        for node in (a, b):
            points = np.array([node], np.int64) if isinstance(node, int) else node.points
            children = [] if isinstance(node, int) else node.children
            sides.append((points, children, np.concatenate([points, [c.centre for c in children]]).astype(np.int64)))
        (p, pc, pall), (r, rc, rall) = sides
        scores = _product(queries[pall], rows[rall])
        if len(p) and len(r):
            offer(p, r, scores[: len(p), : len(r)])
        if pc or rc:
            x = np.concatenate([np.zeros(len(p)), [c.radius for c in pc]])
            y = np.concatenate([np.zeros(len(r)), [c.radius for c in rc]])
            bounds = scores + x[:, None] * lengths[1][rall][None, :] + lengths[0][pall][:, None] * y[None, :] + x[:, None] * y[None, :]
            bounds = bounds + 1e-9 * np.abs(bounds) + 1e-6  # rounding never prunes
            bounds[: len(p), : len(r)] = -np.inf
            bars = np.concatenate([bar[p], [bar[under(c)].min() for c in pc]])
            some = np.argwhere((bounds >= bars[:, None]) & np.isfinite(bounds))
            order = np.argsort(bounds[some[:, 0], some[:, 1]], kind="stable")
            for i, j in some[order].tolist():
                stack.append((float(bounds[i, j]), int(p[i]) if i < len(p) else pc[i - len(p)], int(r[j]) if j < len(r) else rc[j - len(r)]))
    return best, visited


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` rows of highest integer inner product for every query row.

    Components become floor(scale * x). A query's own key is no candidate; ties go to the smaller key;
    fewer candidates give fewer rows. Vectors that are null or hold null or non-finite components, and rows
    with a null key, take part on neither side; vectors of different length do not meet. Rows repeated
    with key and vector count once, a key with several vectors is several rows. Scores must fit a long.
    Other columns are ignored; an empty input gives no rows.
    """
    raw = F.col("raw")
    good = F.coalesce(~F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(good & F.col("key").isNotNull()).select(
        "key", "asks", F.transform("raw", lambda x: F.floor(x * scale).cast("long")).alias("vector"), F.size("raw").alias("dims")
    )
    rows = stored(rows.distinct(), "rows")
    # Of equal vectors only the k + 1 smallest keys can be among the best: one may be the query's own.
    first = Window.partitionBy("vector").orderBy("key")
    least = rows.select("key", "vector", "dims").withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    classes = least.groupBy("vector", "dims").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    classes = stored(classes, "classes")
    n = classes.count()
    if not n:
        return rows.select(F.col("key").alias("query_id"), F.lit(0).alias("rank"), F.col("key").alias(key), F.lit(0).cast("long").alias("score")).limit(0)
    wanted = min(MOST_PIVOTS, -(-n // block))
    pivots = [
        (r.dims, np.array(r.vector, np.float64))
        for r in classes.orderBy(F.xxhash64("vector")).select("dims", "vector").limit(wanted).collect()
    ]
    shared = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors

    def nearest(batches):
        for batch in batches:
            batch["pivot"] = -1
            for dims in batch["dims"].unique():
                own = [(i, p) for i, (d, p) in enumerate(shared.value) if d == dims]
                if own:
                    mine = batch["dims"] == dims
                    matrix = np.stack(batch.loc[mine, "vector"].to_numpy()).astype(np.float64)
                    centres = np.stack([p for _, p in own])
                    away = (centres**2).sum(1)[None, :] - 2 * matrix @ centres.T
                    batch.loc[mine, "pivot"] = np.array([i for i, _ in own])[away.argmin(1)]
            yield batch

    def blocks(frame: DataFrame, size: int, name: str) -> DataFrame:
        """One row per block of at most about ``size`` vectors: its tree, centre, radius and longest vector."""
        placed = stored(frame.mapInPandas(nearest, "vector array<long>, dims int, keys array<long>, pivot int"), "placed")
        counts = placed.groupBy("dims", "pivot").agg(F.ceil(F.count("*") / size).cast("int").alias("pieces"))
        # One row per pivot and length: as small as the sample of pivots.
        dealt = placed.join(counts, ["dims", "pivot"]).withColumn("piece", F.pmod(F.xxhash64("vector", "keys"), F.col("pieces")).cast("int"))

        def plant(frame):
            import pandas as pd

            matrix = np.stack(frame["vector"].to_numpy()).reshape(len(frame), -1)
            top = np.abs(matrix).max(initial=0)
            matrix = matrix.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.int64)
            tree = build(matrix)
            floats = matrix.astype(np.float64)
            data = pickle.dumps((matrix, [list(x) for x in frame["keys"]], tree.plain()))
            return pd.DataFrame(
                {
                    "dims": [int(frame["dims"].iloc[0])], "centre": [floats[tree.centre].tolist()], "radius": [tree.radius],
                    "data": [data], "pivot": [int(frame["pivot"].iloc[0])],
                }
            )

        planted = dealt.groupBy("dims", "pivot", "piece").applyInPandas(
            plant, "dims int, centre array<double>, radius double, data binary, pivot int"
        )
        return stored(planted.withColumn(name, F.monotonically_increasing_id()), name)

    asked = rows.where("asks").select("vector", "dims", F.array("key").alias("keys"))
    query_blocks = blocks(asked, QUERY_BLOCK, "qb")
    row_blocks = blocks(classes, block, "rb")
    numbered = [r.qb for r in query_blocks.select("qb").collect()]  # a number per QUERY_BLOCK queries
    if not numbered:
        return rows.select(F.col("key").alias("query_id"), F.lit(0).alias("rank"), F.col("key").alias(key), F.lit(0).cast("long").alias("score")).limit(0)
    # Every row block meets every query block, as centres and radii only.
    light = row_blocks.select("rb", "dims", F.col("centre").alias("rc"), F.col("radius").alias("rr")).withColumn(
        "qb", F.explode(F.array(*[F.lit(x) for x in numbered]))
    )
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = lambda a: F.sqrt(dot(a, a))
    pairs = light.join(query_blocks.select("qb", "dims", "centre", "radius"), ["qb", "dims"]).select(
        "qb", "rb",
        (
            dot(F.col("rc"), F.col("centre")) + F.col("rr") * length(F.col("centre")) + F.col("radius") * length(F.col("rc"))
            + F.col("rr") * F.col("radius")
        ).alias("bound"),
    )
    pairs = stored(pairs.withColumn("bound", F.col("bound") + F.abs("bound") * 1e-9 + 1e-6), "pairs")

    def meet(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for r in batch.itertuples():
                queries, ids, query_tree = pickle.loads(r.query_data)
                rows, keys, row_tree = pickle.loads(r.row_data)
                query_ids = np.array([x[0] for x in ids], np.int64)
                worst = np.full(len(query_ids), -np.inf)
                if r.known is not None:
                    known = dict(pickle.loads(r.known))
                    worst = np.array([known.get(int(q), -np.inf) for q in query_ids])
                best, _ = search(queries, query_ids, Node.of(query_tree), rows, keys, Node.of(row_tree), k, worst)
                out += [(int(r.qb), int(q), -s, i) for q, found in zip(query_ids.tolist(), best) for s, i in found]
            yield pd.DataFrame(out, columns=["qb", "query_id", "score", "key"]).astype("int64")

    def met(some: DataFrame) -> DataFrame:
        """``some(qb, rb, known)`` searched; pairs are spread before their trees are fetched."""
        return (
            some.join(row_blocks.select("rb", F.col("data").alias("row_data")), "rb")
            .join(query_blocks.select("qb", F.col("data").alias("query_data")), "qb")
            .mapInPandas(meet, "qb long, query_id long, score long, key long")
        )

    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    best_pair = Window.partitionBy("qb").orderBy(F.desc("bound"), "rb")
    first_pairs = pairs.withColumn("nth", F.row_number().over(best_pair)).where("nth = 1").select("qb", "rb")
    start = stored(met(first_pairs.withColumn("known", F.lit(None).cast("binary"))), "first")
    kth = start.withColumn("nth", F.row_number().over(ordered)).where(F.col("nth") == k).select("qb", "query_id", "score")

    def bars(frame):
        import pandas as pd

        pairs_ = list(zip(frame["query_id"].tolist(), frame["score"].tolist()))
        return pd.DataFrame({"qb": [int(frame["qb"].iloc[0])], "known": [pickle.dumps(pairs_)], "n": [len(pairs_)], "low": [float(min(s for _, s in pairs_))]})

    # One row per query block of at most about QUERY_BLOCK scores.
    known = stored(kth.groupBy("qb").applyInPandas(bars, "qb long, known binary, n long, low double"), "known")
    sizes = rows.where("asks").join(start.select("query_id", "qb").distinct(), F.col("key") == F.col("query_id")).groupBy("qb").agg(F.countDistinct("query_id").alias("all"))
    rest = (
        pairs.join(first_pairs, ["qb", "rb"], "left_anti").join(known, "qb", "left").join(sizes, "qb", "left")
        .where("n is null or all is null or n < all or bound >= low").select("qb", "rb", "known")
    )
    found = start.unionByName(met(rest)).drop("qb")
    return (
        found.distinct().withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("key").alias(key), "score")
    )
