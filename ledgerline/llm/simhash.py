"""SimHash near-dedup: fingerprints of word shingles, joined by walking binary tries together."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import Forest, components
from ledgerline.llm.store import shuffle_partitions, stored
from ledgerline.llm.text import joined_words, slices, text_bytes, word_bounds

SHINGLE = 4
BITS = 64
BUDGET = 4
SEED = 42
CHUNK = 4_096
UNIT_ROWS = 32_768
PIECE_BYTES = 2 << 20
LEAF = 32


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a column ``fingerprint`` (long, the 64 bits as two's complement).

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words are joined by one
    space and hashed by XXH64 (seed 42); a text of fewer words is one shingle, one without words has
    fingerprint zero. A bit is 1 if it is set in over half of the hashes, repeats included.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.LongType())])

    def prints(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            parts = [_fingerprints(piece, shingle) for piece in slices(column, PIECE_BYTES)]
            values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(prints, schema)


def _fingerprints(column, shingle: int) -> np.ndarray:
    import xxhash

    data, offsets = text_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out.view(np.int64)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    joined, room = joined_words(lower[data], starts, ends)
    flat = joined.tobytes()
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    to = np.minimum(at + shingle, np.repeat(first[1:], n))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], 42) for a, b in zip(room[at].tolist(), (room[to] - 1).tolist())), np.uint64, len(at))
    full = np.flatnonzero(n)
    row_at = np.concatenate([[0], np.cumsum(n[full])])
    ones = np.zeros((len(full), BITS), np.int64)
    step = 1 << 18  # shingles expanded to bits at a time
    row = np.repeat(np.arange(len(full)), n[full])
    for i in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[i : i + step].astype(">u8").view(np.uint8)).reshape(-1, BITS)
        rows = row[i : i + step]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
        ones[rows[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    major = ones * 2 > np.diff(row_at)[:, None]
    out[full] = np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64)
    return out.view(np.int64)


class Trie:
    """Binary trie over sorted 64-bit values: a node is a range of the array and a bit position."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def split(self, node: tuple[int, int, int]) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
        low, high, bit = node
        ones = (self.values[low:high] >> np.uint64(bit)) & np.uint64(1)
        middle = low + int(np.searchsorted(ones, 1))
        return (low, middle, bit - 1), (middle, high, bit - 1)


def trie_links(values: np.ndarray, other: np.ndarray | None, budget: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Links (i, j) that connect all values of the two sorted arrays (or of the one) within ``budget`` bits.

    Node pairs are walked together, adding the bits in which their paths differ; a pair over the
    budget is dropped, small pairs are compared bit by bit. Links that join nothing new are left out.
    """
    a = Trie(values)
    b = a if other is None else Trie(other)
    shift = 0 if other is None else len(values)
    forest = Forest(len(values) + (0 if other is None else len(other)))
    stack = [((0, len(a.values), BITS - 1), (0, len(b.values), BITS - 1), 0)]
    while stack:
        x, y, differing = stack.pop()
        if differing > budget or x[0] >= x[1] or y[0] >= y[1]:
            continue
        same = other is None and x == y
        if same and x[1] - x[0] < 2:
            continue
        if x[2] < 0 or max(x[1] - x[0], y[1] - y[0]) <= leaf:
            distance = np.bitwise_count(a.values[x[0] : x[1], None] ^ b.values[None, y[0] : y[1]])
            near = distance <= budget
            if same:
                near &= np.tri(len(near), k=-1, dtype=bool)
            # Pairs that are already connected need no link.
            roots = [np.array([forest.root(i) for i in r]) for r in (range(x[0], x[1]), range(y[0] + shift, y[1] + shift))]
            near &= roots[0][:, None] != roots[1][None, :]
            for i, j in np.argwhere(near):
                forest.join(x[0] + int(i), y[0] + int(j) + shift)
            continue
        # Whole subtrees that cannot differ by more than the budget: a star joins them.
        if differing + x[2] + 1 <= budget:
            for i in range(x[0], x[1]):
                forest.join(i, y[0] + shift)
            for j in range(y[0], y[1]):
                forest.join(x[0], j + shift)
            continue
        (x0, x1), (y0, y1) = a.split(x), b.split(y)
        stack += [(x0, y0, differing), (x1, y1, differing), (x0, y1, differing + 1)]
        if not same:
            stack.append((x1, y0, differing + 1))
    return [(i, j - shift) for i, j in forest.links]


def near_links(prints: DataFrame, budget: int = BUDGET, agree: int = 1, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between distinct values of ``prints(value)`` that connect all pairs within ``budget`` bits.

    With the 64 bits cut into ``budget + agree`` parts, any such pair is equal in ``agree`` of them; for
    each choice of parts the values are grouped by those bits, and each group is joined by its trie.
    A group larger than ``chunk`` is cut into pieces, and each two pieces are joined by their tries.
    Every link is exact, and none is needed beyond those that connect a group.
    """
    edges = np.linspace(0, BITS, budget + agree + 1).astype(int)
    masks = [
        sum(((1 << int(edges[i + 1] - edges[i])) - 1) << int(edges[i]) for i in parts)
        for parts in combinations(range(budget + agree), agree)
    ]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    keyed = prints.select(
        "value",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("part"), F.col("value").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)])
        ).alias("k"),
    ).select("value", "k.part", "k.bits")
    # Groups over the chunk size; their number is at most parts * values / chunk.
    large = keyed.groupBy("part", "bits").count().where(F.col("count") > chunk)
    large = large.select("part", "bits", F.ceil(F.col("count") / chunk).cast("int").alias("pieces"))
    cut = keyed.join(large, ["part", "bits"], "left").withColumn(
        "piece", F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("value"), F.col("pieces")).cast("int")).otherwise(0)
    )
    # Each piece meets every other piece of its group, and itself, once.
    meeting = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
    meeting = meeting.select(
        "part", "bits", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"),
        (F.col("piece") > F.col("other")).alias("right"), "value",
    )

    units = max(4 * shuffle_partitions(prints), len(masks) * prints.count() // UNIT_ROWS)
    meeting = meeting.withColumn("unit", F.pmod(F.xxhash64("part", "bits", "i", "j"), F.lit(units)))

    def join(table):
        import pyarrow as pa

        keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("part", "bits", "i", "j")])
        values = table.column("value").to_numpy().view(np.uint64)
        right = table.column("right").to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort([values, *keys[::-1]])
        keys, values, right = keys[:, order], values[order], right[order]
        cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        a, b = [], []
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            if high - low < 2:
                continue
            left, other = values[low:high], None
            if keys[2, low] != keys[3, low]:
                left, other = left[~right[low:high]], left[right[low:high]]
            second = left if other is None else other
            for i, j in trie_links(left, other, budget):
                a.append(left[i])
                b.append(second[j])
        return pa.table({c: pa.array(np.array(x, np.uint64).view(np.int64), pa.int64()) for c, x in (("a", a), ("b", b))})

    return meeting.groupBy("unit").applyInArrow(join, "a long, b long")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, budget: int = BUDGET, agree: int = 1,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: its key, ``fingerprint`` (long), ``component`` (its smallest fingerprint), ``component_id``, the
    smallest key reachable by links, and the columns named in ``carry``.

    Rows link if their fingerprints differ in ``budget`` bits or fewer; rows of one fingerprint are one
    class, so copies are never expanded into pairs. Null and empty texts have fingerprint zero and link
    like any other. Rows with a null key take part; a component of null keys only has a null id.
    Repeated rows stay repeated. Other columns are ignored; an empty input gives no rows.
    """
    carried = [F.col(c).alias(f"_carry_{c}") for c in carry]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *carried)
    prints = stored(fingerprints(rows, "text", shingle).drop("text"), "prints")
    classes = prints.groupBy("fingerprint").agg(F.min("key").alias("least"))
    near = components(near_links(classes.select(F.col("fingerprint").alias("value")), budget, agree))
    members = classes.join(near, classes.fingerprint == near.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    members = stored(members, "classes")
    ids = members.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = members.join(ids, "component").select("fingerprint", "component", "component_id")
    return prints.join(labels, "fingerprint").select(
        F.col("key").alias(key), "fingerprint", "component", "component_id", *[F.col(f"_carry_{c}").alias(c) for c in carry]
    )


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key, of equal ones any."""
    others = tuple(c for c in docs.columns if c != key)
    found = near_duplicates(docs, text, key, carry=others, **options).where(F.col(key).eqNullSafe(F.col("component_id")))
    # Only rows that share the smallest key of their component meet here.
    nth = F.row_number().over(Window.partitionBy("component").orderBy("fingerprint", *others))
    return found.withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)
