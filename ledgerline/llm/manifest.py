"""Merkle manifest of a dataset: a 16-ary hash tree per group of rows, one over the groups, and proofs.

The levels are built once, each by grouping runs of consecutive nodes, and stored as rows that link a node to its
parent and hold the digests of the node's run. A recursive query then ascends from every leaf, appends the
siblings and folds the hash of the (perhaps tampered) leaf. The leaves of one run differ only in their own run, so
they climb in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, shuffle_partitions, stored

FANOUT = 16
DIGEST = 32  # bytes
CLIMBERS = 4_096  # climbing rows that meet one copy of a node row
SALTS = 65_536
TOP = -1  # the tree over the groups
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def written(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def hashed(text: Column) -> Column:
    """sha256 of the text, in binary."""
    return F.unhex(F.sha2(text, 256))


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def sampled_fifth(key: Column) -> Column:
    """Rows whose id, as decimal text, has a crc32 divisible by five; never those without an id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, LOWER)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (place in its group, from 0) and ``n`` (rows of the group), in ascending ``order``.

    One range shuffle sorts all rows; a group's rows in the earlier ranges give the offset, so a group that holds
    much of the table is spread over ranges. Equal rows are dealt by a salt.
    """
    keys = [group, *order, "_salt"]
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    sorted_rows = salted.repartitionByRange(shuffle_partitions(rows), *keys).sortWithinPartitions(*keys).drop("_salt")
    placed = stored(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    whole = Window.partitionBy(group)  # a row per range
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    spans = spans.select(
        group, "_range", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("n"),
    )
    joined = join_small(placed, spans, [group, "_range"])
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_range")


def _before(place: str) -> str:
    """SQL for the digests of a run left of ``place``; ``_after``: right of it."""
    return f"substring(digests, 1, {DIGEST} * {place})"


def _after(place: str) -> str:
    return f"substring(digests, {DIGEST} * ({place} + 1) + 1, {DIGEST * FANOUT})"


def node(tree: Column, level: int, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), F.lit(level).alias("level"), place.cast("long").alias("place"))


def _runs(children: DataFrame, level: int, *kept: str) -> DataFrame:
    """Runs of 16 consecutive children (tree, pos, n, digest, weight and ``kept``), a row per parent at ``level``."""
    up = F.expr(f"pos div {FANOUT}")
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", "weight", *kept)))
    runs = children.groupBy("tree", up.alias("up"), "n").agg(members.alias("members"), F.sum("weight").alias("weight"))
    joined = F.array_join(F.transform("members", lambda m: hexed(m["digest"])), "")
    return runs.select(
        "tree", "members", "weight", F.unhex(joined).alias("digests"), hashed(joined).alias("digest"),
        node(F.col("tree"), level, F.col("up")).alias("node"), F.col("up").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
    )


def _links(runs: DataFrame) -> DataFrame:
    """The parent-linked rows of the runs' members, copied so that few climbing rows meet one copy."""
    each = runs.select(F.col("node").alias("parent"), F.col("weight").alias("parent_weight"), "digests", F.explode("members").alias("m"))
    return each.select(
        F.col("m.node").alias("node"), "parent", "parent_weight", F.expr(f"cast(m.pos % {FANOUT} as int)").alias("place"), "digests",
        F.explode(F.expr(f"sequence(0L, (m.weight - 1) div {CLIMBERS})")).alias("salt"),
    )


def _grown(children: DataFrame, most: int, level: int) -> tuple[DataFrame, list[DataFrame], int]:
    """Levels on ``children`` until at most one node of a tree is left: the last nodes, all links, the last level."""
    ends, links = children.where("n = 1"), []
    while most > 1:
        level, most = level + 1, -(-most // FANOUT)
        runs = stored(_runs(children.where("n > 1"), level, "node"), "level")
        links.append(_links(runs))
        children = runs.select("tree", "pos", "n", "digest", "weight", "node")
        ends = ends.unionByName(children.where("n = 1"))
    return ends, links, level


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """Recursive queries without the row limit that the session sets them."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT start, node, weight, folded, tail FROM {{anchor}}
  UNION ALL
  SELECT c.start, p.parent, p.parent_weight,
    transform(c.folded, f -> unhex(sha2(lower(concat(hex(p.before), hex(f), hex(p.after))), 256))),
    concat(c.tail, p.before, p.after)
  FROM climb c JOIN {{nodes}} p
    ON c.node = p.node AND pmod(xxhash64(c.start), (c.weight - 1) div {CLIMBERS} + 1) = p.salt
)
SELECT start, folded, tail FROM climb WHERE node.tree = {{tree}} AND node.level = {{level}}
"""


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    text: str = "text",
    tampered: Callable[[Column], Column] = sampled_fifth,
    tampering: Callable[[Column], Column] = lowered,
) -> DataFrame:
    """Per row: ``key``, leaf, subroot (of its group), root, proof_sha256, folded_root and verified, digests as lowercase hex.

    A leaf hashes ``fields``; leaves of a group ascend by ``key``, equal keys by leaf, null keys first; groups ascend bytewise,
    null first. proof_sha256 hashes the siblings from the leaf's run to the root's (no siblings: of no bytes).
    folded_root starts from the leaf of the row with ``tampering`` applied to ``text`` where ``tampered`` holds. Nulls in any
    column are hashed as such; repeated rows are leaves of their own; other columns are ignored; an empty input gives no rows.
    """
    spark = docs.sparkSession

    def leaf(changed: Column) -> Column:
        return hashed(F.concat(*[written(changed if f == text else F.col(f)) for f in fields]))

    rows = docs.select(
        F.col(key).alias("key"), F.col(group).alias("group"), leaf(F.col(text)).alias("digest"),
        F.when(tampered(F.col(key)), leaf(tampering(F.col(text)))).alias("claimed"),
    )
    leaves = ranked(rows, "group", ["key", "digest"])
    groups = stored(ranked(leaves.where("pos = 0").select("group", F.col("n").alias("leaves"), F.lit(TOP).alias("tree")), "tree", ["group"]), "groups")
    count, most = groups.agg(F.count("*"), F.max("leaves")).first()
    if not count:
        return rows.select(F.col("key").alias(key)).join(spark.createDataFrame([], SCHEMA))
    leaves = join_small(leaves, groups.select("group", F.col("pos").alias("tree")), ["group"])
    leaves = leaves.withColumn("weight", F.lit(1).cast("long"))

    # Level 1 keeps the leaves; the levels above need digests only. A lone leaf is its group's last node.
    first = _runs(leaves.where("n > 1"), 1, "key", "claimed").withColumn("weight", F.lit(1).cast("long"))
    lone = leaves.where("n = 1").select(
        "tree", F.array(F.struct("pos", "digest", "weight", "key", "claimed")).alias("members"), "weight", F.col("digest").alias("digests"),
        "digest", node(F.col("tree"), 0, F.lit(0)).alias("node"), "pos", "n",
    )
    base = stored(first.unionByName(lone), "level")
    nodes = base.select("tree", "pos", "n", "digest", "weight", "node")
    ends, links, level = _grown(nodes, -(-most // FANOUT), 1)
    ends = stored(ends, "level")
    tree = 0
    if count > 1:
        weights = ends.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).alias("n"), "digest", "weight", "node")
        ended, more, level = _grown(weights, count, 0)
        links, tree = links + more, TOP
    else:
        ended, level = ends, ends.first().node.level
    root = bytes(ended.first().digest).hex()

    own = F.transform("members", lambda m: F.coalesce(m["claimed"], m["digest"]))
    lift = F.expr(
        f"""transform(own, (f, i) -> CASE WHEN node.level = 0 THEN f
        ELSE unhex(sha2(lower(concat(hex({_before("i")}), hex(f), hex({_after("i")}))), 256)) END)"""
    )
    anchor = base.withColumn("own", own).select(F.col("node").alias("start"), "node", "weight", lift.alias("folded"), F.lit(b"").alias("tail"))
    if links:
        linked = links[0]
        for more in links[1:]:
            linked = linked.unionByName(more)
        sides = {"before": F.expr(_before("place")), "after": F.expr(_after("place"))}
        linked = stored(linked.withColumns(sides).drop("digests", "place"), "nodes")
        with _any_number_of_rows(spark):
            climbed = stored(spark.sql(CLIMB, anchor=anchor, nodes=linked, tree=tree, level=level), "climbed")
    else:
        climbed = anchor.select("start", "folded", "tail")
    each = (
        base.select(F.col("node").alias("start"), "tree", "members", "digests").join(climbed, "start")
        .select("tree", "digests", "folded", "tail", F.posexplode("members").alias("i", "m"))
    )
    proof = F.sha2(hexed(F.concat(F.expr(_before("i")), F.expr(_after("i")), F.col("tail"))), 256)
    each = each.select(
        "tree", F.col("m.key").alias(key), hexed(F.col("m.digest")).alias("leaf"), proof.alias("proof_sha256"),
        hexed(F.col("folded")[F.col("i")]).alias("folded_root"),
    )
    subroots = ends.select("tree", hexed(F.col("digest")).alias("subroot"))
    return join_small(each, subroots, ["tree"]).select(
        key, "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )
