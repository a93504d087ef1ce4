"""Mixing sources to target weights by Pareto order sampling.

A document's expected copies are its source's target over its source's size. Whole copies are certain;
for the rest documents are ranked by random odds divided by inclusion odds, and the first are taken until
the source's remaining words are reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, shuffle_partitions, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BUCKET_ROWS = 4_096
SEED = 3


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``sources(source, source_size, n)`` with ``target``.

    Sources in code point order, null last, get the weights in turn and share ``share`` of all words; no
    target exceeds ``most`` times its source's size, and what is cut off is shared again by weight.
    """
    # Numbered by ranges of the name, so that no task sees all sources.
    parts = stored(
        sources.repartitionByRange(shuffle_partitions(sources), F.col("source").isNull(), "source").withColumn(
            "part", F.spark_partition_id()
        ),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sizes = parts.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(inside) - 1 + F.col("base")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    weighed = stored(
        parts.withColumn("row", F.lit(0)).join(F.broadcast(sizes), "part").select("source", "source_size", "n", turn.alias("weight")), "weights"
    )
    limit = F.col("source_size") * most
    goal = min(share, float(most)) * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        # A source is at its limit once weight * level reaches it; the level only rises.
        full = limit <= F.col("weight") * level
        n, words, weight = weighed.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == capped or not weight:
            break
        capped, level = n, (goal - (words or 0)) / weight
    return weighed.withColumn("target", F.least(limit.cast("double"), F.col("weight") * level))


def mix(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: key, source, size (words), source_size, target (words of its source), copies, taken (words),
    and the columns named in ``carry``.

    A null text has no words, a null source is a source of its own. The random number of a row is a hash
    of ``seed``, key, source and text, so reruns agree; repeated rows share it and differ only in which
    of them is counted. The document that ends a source's sample is the one that comes nearest to the
    words still missing. Other columns are ignored; an empty input gives no rows.
    """
    uniform = (F.pmod(F.xxhash64(F.lit(seed), key, source, text), F.lit(2**52)) + 0.5) / float(2**52)
    base = stored(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), uniform.alias("u"),
            *[F.col(c).alias(f"_carry_{c}") for c in carry],
        ),
        "sizes",
    )
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    info = source_targets(sources, weights, share, most).withColumn("whole", F.floor(expected))
    info = stored(
        info.select(
            "source", "source_size", "target", "whole", (expected - F.col("whole")).alias("inclusion"),
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("missing"),
            F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets"),
        ),
        "targets",
    )
    # Within a source the inclusion odds are one number, so the order of the ratio is that of u, and
    # ranges of u are ranges of the rank that hold about BUCKET_ROWS rows each.
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("inclusion") / (1 - F.col("inclusion")))
    bucket = F.floor(F.col("u") * F.col("buckets"))
    ranked = join_small(base, info, ["source"]).withColumn("bucket", bucket).withColumn("rank", odds)
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.where("missing > 0").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
        .withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    )
    edges = filled.where("before < missing and before + words >= missing").select(
        "source", F.col("bucket").alias("edge"), F.col("before").alias("edge_before")
    )
    ranked = join_small(ranked, stored(edges, "edges"), ["source"], "left")
    outside = ranked.where("edge is null or bucket <> edge").withColumn("extra", F.coalesce((F.col("bucket") < F.col("edge")).cast("long"), F.lit(0)))
    # In the bucket that holds the edge: all ranks that fit, then the one row nearest to the gap.
    group = Window.partitionBy("source")
    order = group.orderBy("rank", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        ranked.where("bucket = edge")
        .withColumn("reached", F.col("edge_before") + F.sum("size").over(order))
        .withColumn("fits", F.col("reached") <= F.col("missing"))
        .withColumn("gap", F.col("missing") - F.coalesce(F.max(F.when(F.col("fits"), F.col("reached"))).over(group), F.col("edge_before")))
        .withColumn("off", F.when(~F.col("fits") & (F.col("size") < 2 * F.col("gap")), F.abs(F.col("size") - F.col("gap"))))
        .withColumn("closing", F.row_number().over(group.orderBy(F.col("off").asc_nulls_last(), "rank", "key", "size")))
        .withColumn("extra", (F.col("fits") | (F.col("off").isNotNull() & (F.col("closing") == 1))).cast("long"))
    )
    copies = (F.col("whole") + F.col("extra")).cast("long")
    names = ["key", "source", "size", "source_size", "target"]
    both = [x.select(*names, copies.alias("copies"), (copies * F.col("size")).alias("taken"), *[f"_carry_{c}" for c in carry]) for x in (outside, inside)]
    return both[0].unionByName(both[1]).withColumnsRenamed({"key": key} | {f"_carry_{c}": c for c in carry})
