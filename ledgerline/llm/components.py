"""Connected components of a links table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node reachable.

    Each round moves the larger neighbours of a node, then the smaller ones, to the smallest
    neighbour; it ends when a round changes nothing. Rounds are stored, so nothing is recomputed
    after a lost executor. Isolated nodes do not appear; links of a node to itself are ignored.
    """
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links"
    )
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi")
        after = stored(
            smallest.select("hi", F.col("m").alias("lo"))
            .unionByName(small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
            .distinct(),
            "links",
        )
        seen, mark, now = mark, _mark(after), after
        if mark == seen:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Number and order-free checksum of the rows."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


class Forest:
    """Union-find over 0..n-1 inside one task; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))
