"""Best-fit packing of token sequences by patterns of lengths, fitted by non-negative least squares.

Only the histogram of piece lengths (one count per length) reaches the driver. Patterns of few lengths
that fill a sequence are enumerated from it, their repeat counts fitted and rounded down, and what is
left is packed best-fit, length by length. The plan says which rank of which length goes where; the
pieces are numbered within their length by counts per task, so no length is gathered anywhere.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import stored

CAPACITY = 2048
ROUNDS = 400
SUPPORT = 4_000


# The special token and the published cutting rule of the 50k byte-level vocabulary (fixed values), the latter with
# possessive quantifiers.
END_OF_TEXT = {"<|endoftext|>": 50256}
CUTTING = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def encoder(path: str):
    """Text to little-endian unsigned 32-bit ids, from a file of ranks (base64 bytes and id per line).

    The same ids as the vocabulary's JSON file gives, three times faster; a special token in the text is its one id there and here.
    """
    import base64
    from array import array

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding("ranks", pat_str=CUTTING, mergeable_ranks=ranks, special_tokens=END_OF_TEXT).encode
    return lambda text: array("I", encode(text, allowed_special="all")).tobytes()


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, ids (binary, little-endian 32 bits),
    and the task ``part`` with the piece's rank among the task's pieces of that length.

    A document's ids end with ``end_id``. One of more than ``capacity`` ids is cut into full pieces; what does not
    fill a piece comes first. Null text is empty. ``path`` is the
    vocabulary's file of ranks, read in every task.
    """

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            known: dict[str, bytes] = {}  # copies in one batch are encoded once
            for low in range(0, len(batch), 500):
                some = batch.slice(low, 500)
                rows = []
                for row, own in enumerate(some.column(1).to_pylist()):
                    own = own or ""
                    if own not in known:
                        known[own] = encode(own) + end
                    ids = known[own]
                    n = len(ids) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)]
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                        own_ids = ids[4 * a : 4 * b]
                        rows.append((row, i, a, b - a, zlib.crc32(own_ids), own_ids, part, int(seen[b - a])))
                        seen[b - a] += 1
                columns = list(zip(*rows))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(columns[0])), *[pa.array(c, t) for c, t in zip(columns[1:], kinds)]],
                    ["key", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"],
                )

    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"
    )


def patterns(capacity: int, lengths: np.ndarray) -> np.ndarray:
    """All multisets of two or three of ``lengths`` that fill ``capacity`` exactly, padded with 0."""
    present = np.zeros(capacity + 1, bool)
    present[lengths[lengths < capacity]] = True
    some = np.flatnonzero(present)
    a, b = np.meshgrid(some, some, indexing="ij")
    a, b = a[a >= b], b[a >= b]
    c = capacity - a - b
    pairs = c == 0
    triples = (c > 0) & (c <= b)
    triples[triples] = present[c[triples]]
    return np.concatenate(
        [np.stack([a[pairs], b[pairs], np.zeros(pairs.sum(), int)], 1), np.stack([a[triples], b[triples], c[triples]], 1)]
    )


def fit_repeats(counts: np.ndarray, found: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts x with A x near ``counts``, by accelerated projected gradients.

    A holds how often a pattern uses a length; it is applied by its few entries, never built. Lengths
    weigh more the longer they are, as they are harder to place among what is left.
    """
    n = len(counts)
    weight = np.arange(n) / n
    weight[0] = 0.0
    used = found > 0

    def forward(x):
        out = np.zeros(n)
        for j in range(found.shape[1]):
            out += np.bincount(found[:, j][used[:, j]], x[used[:, j]], n)
        return out

    x = z = np.zeros(len(found))
    # The largest row sum times the largest column sum of A'WA bounds its norm.
    uses = forward(np.ones(len(found)))
    step = 1.0 / max(1.0, float((uses * weight).max() * found.shape[1]))
    t = 1.0
    for _ in range(rounds):
        left = (counts - forward(z)) * weight
        after = np.maximum(z + step * left[found].sum(1), 0.0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = after + (t - 1) / t_next * (after - x)
        x, t = after, t_next
    return x


def plan(counts: np.ndarray, capacity: int, support: int = SUPPORT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) using every count exactly once.

    The work depends on ``capacity`` and the number of patterns, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    found = patterns(capacity, np.flatnonzero(left))
    if len(found):
        repeats = fit_repeats(left, found)
        # The best supported patterns first; each as often as fitted and as the pieces allow.
        for i in np.argsort(-repeats, kind="stable")[:support]:
            own, times = np.unique(found[i][found[i] > 0], return_counts=True)
            n = int(min(np.floor(repeats[i]), (left[own] // times).min()))
            if n > 0:
                out.append((tuple(int(v) for v in found[i] if v), n))
                left[own] -= n * times
    # What is left: longest first, each into the open sequences with the least sufficient room.
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1]:
        length, todo = int(length), int(left[length])
        while todo:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                space = length + int(fitting[0])
                held, n = room[space].pop()
                rooms[space] = bool(room[space])
            else:
                # New sequences: only as many as these pieces need if they stack.
                space, held = capacity, ()
                n = -(-todo // (capacity // length))
            # As many equal pieces in each as fit, so that hot lengths stay few entries.
            stack = min(space // length, max(1, todo // n))
            take = min(n, todo // stack)
            if held and take < n:
                room[space].append((held, n - take))
                rooms[space] = True
            todo -= take * stack
            rest = space - stack * length
            room.setdefault(rest, []).append((held + (length,) * stack, take))
            rooms[rest] = True
    out += [(held, n) for group in room.values() for held, n in group if held]
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (stored, so that ranks stay) with sequence_id and offset instead of part and nth.

    Lengths fill as few sequences as the plan finds; offsets in a sequence are gapless from 0.
    """
    # At most one row per task and length.
    counted = cut.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in counted.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most ``capacity`` rows
        counts[r.length] = r.n
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for held, n in plan(counts, capacity):
        offset = 0
        for length in held:
            slots.setdefault(length, []).append((int(used[length]), sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    # Bounded by capacity and the number of patterns, whatever the number of pieces.
    table = cut.sparkSession.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in slots.items()})

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            rank = column("base").to_numpy() + column("nth").to_numpy()
            length = column("length").to_numpy()
            ids, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                first, sequences, starts = table.value[int(one)].T
                slot = np.searchsorted(first, rank[mine], "right") - 1
                ids[mine] = sequences[slot] + rank[mine] - first[slot]
                at[mine] = starts[slot]
            yield pa.RecordBatch.from_arrays([*[column(n) for n in names], pa.array(ids), pa.array(at)], [*names, "sequence_id", "offset"])

    names = [c for c in cut.columns if c not in ("part", "nth")]
    schema = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in names)
    ranked = cut.join(offsets, ["part", "length"]).select(*cut.columns, "base")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """All documents as pieces placed in sequences: key, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Null and empty texts are the end id alone; repeated rows are packed like different ones; other
    columns are ignored; an empty input gives no rows.
    """
    cut = pieces(docs, path, text, key, capacity, end_id)
    return pack(stored(cut if keep_ids else cut.drop("ids"), "pieces"), capacity).withColumnRenamed("key", key)
