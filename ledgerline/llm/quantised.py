"""Embedding near-dedup: binary codes by iterative quantisation, multi-index tables, exact rerank.

A rotation learned on a bounded sample turns vectors into balanced codes. Each code is cut into parts; a
table holds every vector in the cell of its part, and vectors visit the cells one bit away. Codes decide
which visits may matter; only those carry the original vectors, which are compared cell by cell. Links
are counted inside the cells and a spanning forest leaves them, so pairs are never listed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import Forest, components
from ledgerline.llm.store import shuffle_partitions, stored

SAMPLE = 8_192
ROTATIONS = 2
ITERATIONS = 40
PART_BITS = 16
CODE_BITS = 64
RADIUS = 18
THRESHOLD = 0.9
CHUNK = 1_024
SEED = 5


def learn(sample: np.ndarray, rotations: int = ROTATIONS, bits: int = CODE_BITS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``rotations`` origins and projections (dims x bits) of the unit vectors with small quantisation error.

    The first origin is the mean, the next zero, and so on: where few vectors teach, the mean lies among
    them and parts even the nearest, which zero does not.

    Principal axes, then alternating: codes are the signs of the rotated data, the rotation is the
    orthogonal one nearest to the codes. More bits than dimensions repeat the axes under new rotations.
    """
    rng = np.random.default_rng(seed)
    origins, out = [], []
    for number in range(rotations):
        origins.append(sample.mean(0) if number % 2 == 0 else np.zeros(sample.shape[1]))
        moved = sample - origins[-1]
        _, axes = np.linalg.eigh(moved.T @ moved)
        axes = axes[:, ::-1]
        columns = []
        while sum(c.shape[1] for c in columns) < bits:
            base = axes[:, : min(axes.shape[1], bits - sum(c.shape[1] for c in columns))]
            data = moved @ base
            turn = np.linalg.qr(rng.normal(size=(base.shape[1], base.shape[1])))[0]
            for _ in range(ITERATIONS):
                signs = np.where(data @ turn >= 0, 1.0, -1.0)
                u, _, v = np.linalg.svd(data.T @ signs)
                turn = u @ v
            columns.append(base @ turn)
        out.append(np.concatenate(columns, 1))
    return np.stack(origins), np.stack(out)


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, sample: int = SAMPLE, chunk: int = CHUNK
) -> DataFrame:
    """Per row: key, n_links (other rows with cosine >= ``threshold`` found), component_id (smallest key reachable), kept.

    Cosines are computed in double precision from the original values, so no link is wrong; a pair is
    found if its codes share a part up to one bit in any table, which misses few pairs near the threshold (about one in
    twenty at 0.9) and hardly any above. Null, empty and zero vectors and those with null or non-finite components
    link with nothing; vectors of different length do not link. Equal vectors are one class, expanded
    neither into pairs nor copies. ``sample`` bounds the vectors that teach the rotation, chosen by hash. Rows with a null key
    take part; repeated rows count as different vectors; other columns are ignored; an empty
    input gives no rows.
    """
    value = F.col("vector")
    good = F.coalesce(
        (F.size(value) > 0)
        & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(value, lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(good, F.transform("vector", lambda x: x + F.lit(0.0))))  # no negative zero
    rows = stored(rows.withColumn("dims", F.size("vector")), "vectors")
    classes = stored(
        rows.where("vector is not null").groupBy("vector", "dims").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    taught: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims in [r.dims for r in classes.select("dims").distinct().limit(1_000).collect()]:
        own = classes.where(F.col("dims") == dims)
        some = own.orderBy(F.xxhash64("vector")).select("vector").limit(sample).toPandas()["vector"]
        matrix = np.stack(some.to_numpy())
        taught[dims] = learn(matrix / np.abs(matrix).max(1, keepdims=True) / np.linalg.norm(matrix / np.abs(matrix).max(1, keepdims=True), axis=1, keepdims=True))
    shared = classes.sparkSession.sparkContext.broadcast(taught)  # dims x bits x rotations of each length

    def encode(batches):
        for batch in batches:
            for dims, own in batch.groupby("dims"):
                origins, turns = shared.value[dims]
                matrix = _unit(own["vector"])
                for i, turn in enumerate(turns):
                    bits = np.packbits((matrix - origins[i]) @ turn >= 0, axis=1).view(">u8").ravel().astype(np.uint64)
                    yield own[["id", "dims"]].assign(turn=i, code=bits.view(np.int64))

    if not taught:
        return _labelled(rows, key, None, None)
    codes = stored(classes.mapInPandas(encode, "id long, dims int, turn int, code long"), "codes")
    parts = CODE_BITS // PART_BITS
    low = (1 << PART_BITS) - 1
    own_part = F.expr(f"shiftrightunsigned(code, part * {PART_BITS}) & {low}L")
    visits = (
        codes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .withColumn("home", own_part)
        .withColumn("flip", F.explode(F.array(*[F.lit(0)], *[F.lit(1 << i) for i in range(PART_BITS)])))
        .select("id", "code", "dims", "turn", "part", F.col("home").bitwiseXOR(F.col("flip").cast("long")).alias("cell"), (F.col("flip") == 0).alias("at_home"))
    )
    n = classes.count()
    units = max(4 * shuffle_partitions(rows), n * parts * ROTATIONS * (PART_BITS + 1) // 200_000)
    cell = ("dims", "turn", "part", "cell")

    def worthwhile(table):
        """Of each cell: the residents and visitors that are near a resident by their codes."""
        import pyarrow as pa

        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in cell])
        home = table.column("at_home").to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort([~home, *keys[::-1]])
        keys, home = keys[:, order], home[order]
        code, ids = table.column("code").to_numpy().view(np.uint64)[order], table.column("id").to_numpy()[order]
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1, [len(code)]])
        residents = np.add.reduceat(home, cuts[:-1]) if len(code) else []
        keep = np.zeros(len(code), bool)
        sizes = np.diff(cuts)
        for c in np.flatnonzero((np.asarray(residents) > 0) & (sizes > 1)):
            a, b, h = cuts[c], cuts[c + 1], int(residents[c])
            for i in range(a, a + h, 512):
                top = min(i + 512, a + h)
                for j in range(a, b, 4096):
                    near = np.bitwise_count(code[i:top, None] ^ code[None, j : min(j + 4096, b)]) <= RADIUS
                    near &= ids[i:top, None] != ids[None, j : min(j + 4096, b)]
                    keep[i:top] |= near.any(1)
                    keep[j : min(j + 4096, b)] |= near.any(0)
        return pa.table(
            {"id": ids[keep], "code": code[keep].view(np.int64), "at_home": home[keep]} | {c: keys[i][keep] for i, c in enumerate(cell)}
        )

    unit = F.pmod(F.xxhash64(*cell), F.lit(units))
    schema = "id long, code long, at_home boolean, dims long, turn long, part long, cell long"
    met = stored(visits.withColumn("unit", unit).groupBy("unit").applyInArrow(worthwhile, schema), "visits")
    # Cells are compared chunk by chunk: residents of one chunk with the visitors and residents of another.
    sizes = met.groupBy(*cell).agg(F.ceil(F.count("*") / chunk).cast("int").alias("pieces")).where("pieces > 1")
    cut = met.join(sizes, list(cell), "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    blocks = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        *cell, F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"),
        (F.col("piece") > F.col("other")).alias("right"), "id", "code", "at_home",
    )
    weighted = blocks.join(classes.select("id", "vector", "copies", F.xxhash64("vector").alias("rank")), "id")
    all_codes = codes.groupBy("id").agg(*[F.max(F.when(F.col("turn") == t, F.col("code"))).alias(f"code{t}") for t in range(ROTATIONS)])
    weighted = weighted.join(all_codes, "id")
    group = (*cell, "i", "j")
    units2 = max(4 * shuffle_partitions(rows), met.count() // 4_096)

    def link(table):
        import pyarrow as pa

        frame = table.to_pandas()
        counts: list[tuple[np.ndarray, np.ndarray]] = []
        a, b = [], []
        for name, own in frame.groupby(list(group)):
            ids = own["id"].to_numpy()
            matrix = _unit(own["vector"])
            right = own["right"].to_numpy() if name[4] != name[5] else None
            x = np.arange(len(ids)) if right is None else np.flatnonzero(~right)
            y = x if right is None else np.flatnonzero(right)
            if not len(x) or not len(y):
                continue
            near = matrix[x] @ matrix[y].T >= threshold
            near &= ids[x][:, None] != ids[y][None, :]
            found = np.argwhere(np.triu(near, 1) if right is None else near)
            if not len(found):
                continue
            p, q = x[found[:, 0]], y[found[:, 1]]
            mine = _first_meeting(own, p, q, name)
            p, q = p[mine], q[mine]
            copies = own["copies"].to_numpy()
            counts.append((ids[p], copies[q]))
            counts.append((ids[q], copies[p]))
            forest = Forest(len(ids))
            for i, j in zip(p.tolist(), q.tolist()):
                forest.join(i, j)
            a += [ids[i] for i, _ in forest.links]
            b += [ids[j] for _, j in forest.links]
        ids = np.concatenate([c[0] for c in counts]) if counts else np.zeros(0, np.int64)
        found = np.concatenate([c[1] for c in counts]) if counts else np.zeros(0, np.int64)
        distinct, place = np.unique(ids, return_inverse=True)
        totals = np.bincount(place, found, len(distinct)).astype(np.int64)
        none = [None] * len(distinct)
        return pa.table(
            {
                "id": pa.array(np.concatenate([distinct, a]).astype(np.int64), pa.int64()),
                "other": pa.array(none + [int(x) for x in b], pa.int64()),
                "n": pa.array(totals.tolist() + [0] * len(a), pa.int64()),
            }
        )

    found = stored(
        weighted.withColumn("unit", F.pmod(F.xxhash64(*group), F.lit(units2))).groupBy("unit").applyInArrow(link, "id long, other long, n long"),
        "found",
    )
    links = found.where("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    near = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    return _labelled(rows, key, classes.join(links, "id", "left").join(near, F.col("id") == F.col("node"), "left"), classes)


def _unit(vectors) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that no square over- or underflows."""
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _first_meeting(own, p: np.ndarray, q: np.ndarray, name: tuple) -> np.ndarray:
    """Pairs whose first common cell this is: lowest rotation and part in which they meet, at the smaller id's home."""
    turn, part, cell = int(name[1]), int(name[2]), int(name[3])
    mask = np.uint64((1 << PART_BITS) - 1)
    ids = own["id"].to_numpy()
    mine = np.ones(len(p), bool)
    for t in range(turn + 1):
        code = own[f"code{t}"].to_numpy().view(np.uint64)
        differing = code[p] ^ code[q]
        for i in range(CODE_BITS // PART_BITS):
            away = np.bitwise_count((differing >> np.uint64(i * PART_BITS)) & mask)
            # Codes too far apart are not carried into the cells of this rotation.
            meets = (away <= 1) & (np.bitwise_count(differing) <= RADIUS)
            if (t, i) == (turn, part):
                smaller = np.where(ids[p] < ids[q], p, q)
                home = (code[smaller] >> np.uint64(i * PART_BITS)) & mask
                return mine & meets & (home == np.uint64(cell))
            mine &= ~meets
    return mine


def _labelled(rows: DataFrame, key: str, found: DataFrame | None, classes: DataFrame | None) -> DataFrame:
    if found is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    found = found.select("vector", "least", "copies", F.coalesce("component", "id").alias("component"), F.coalesce("n", F.lit(0)).alias("n"))
    found = stored(found, "labels")
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = found.join(least, "component").select("vector", "copies", "n", "component_id")
    joined = rows.where("vector is not null").join(labels, "vector")
    component = F.coalesce(F.col("component_id"), F.col("key"))
    valid = joined.select(F.col("key").alias(key), (F.col("n") + F.col("copies") - 1).cast("long").alias("n_links"), component.alias("component_id"))
    alone = rows.where("vector is null").select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return valid.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
