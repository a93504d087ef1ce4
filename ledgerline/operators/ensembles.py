"""Fitted trees as a table: one row per node, scored, truncated, stored and explained without the fitting library.

A node has its tree, number, feature, threshold, children, gain, weighted training rows and value; a leaf has no children.
Rows go left where the feature is at most the threshold. The table of an ensemble is as large as its trees, never as
the data; tasks get it as arrays in a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import quote_name
from ledgerline.session import shared_path

SCORE = "score"
NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left int, right int, gain double, weight double, value double, tree_weight double"
)
# What the summed values of an ensemble mean: a margin whose doubled logistic is the probability, or the probability.
BOOSTED, SINGLE = "boosted", "single"


def node_rows(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """The nodes of the last stage, a decision tree or a boosted ensemble with numeric features, read from its saved form."""
    spark = SparkSession.active()
    fitted = model.stages[-1]
    path = shared_path(spark, "nodes")
    fitted.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    boosted = "nodeData" in saved.columns
    nodes = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if boosted else saved.select(F.lit(0).alias("tree"), "*")
    leaf = F.col("leftChild") < 0
    # A leaf of a single classification tree holds weighted class counts; its value is the share of positives.
    stats = F.col("impurityStats")
    share = F.try_divide(F.get(stats, F.lit(1)), F.get(stats, F.lit(0)) + F.get(stats, F.lit(1)))
    # The statistics of a regression tree begin with the count, those of a classification tree are counts.
    weight = F.get(stats, F.lit(0)) if boosted else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(f) for f in features])
    weights = F.array(*[F.lit(float(w)) for w in fitted.treeWeights]) if boosted else F.array(F.lit(1.0))
    return nodes.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
        F.when(~leaf, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(~leaf, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(~leaf, F.col("leftChild")).cast("int").alias("left"), F.when(~leaf, F.col("rightChild")).cast("int").alias("right"),
        F.when(~leaf, F.col("gain")).alias("gain"), weight.alias("weight"),
        (F.col("prediction") if boosted else share).alias("value"), F.get(weights, F.col("tree")).alias("tree_weight"),
    )


@dataclass
class TreeTable:
    """An ensemble as its node table; ``kind`` says how summed leaf values become a probability."""

    features: list[str]
    kind: str
    nodes: pd.DataFrame

    @classmethod
    def of(cls, model: PipelineModel, features: Sequence[str]) -> TreeTable:
        kind = BOOSTED if hasattr(model.stages[-1], "treeWeights") else SINGLE
        nodes = node_rows(model, features).toPandas().sort_values(["tree", "node"], ignore_index=True)
        return cls(list(features), kind, nodes)

    @property
    def trees(self) -> int:
        return int(self.nodes["tree"].max()) + 1 if len(self.nodes) else 0

    def first(self, trees: int) -> TreeTable:
        """The ensemble as it was after ``trees`` rounds."""
        return TreeTable(self.features, self.kind, self.nodes[self.nodes["tree"] < trees].reset_index(drop=True))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = self.nodes.astype(object).where(self.nodes.notna(), None)
        return spark.createDataFrame([_typed(r) for r in rows.itertuples(index=False)], NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        listed = F.array(*[F.lit(f) for f in self.features])
        self.to_frame(spark).withColumns({"features": listed, "kind": F.lit(self.kind)}).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeTable:
        stored = spark.read.parquet(path)
        head = stored.select("features", "kind").first()
        nodes = stored.drop("features", "kind").toPandas().sort_values(["tree", "node"], ignore_index=True)
        return TreeTable(list(head["features"]), head["kind"], nodes)

    def _arrays(self) -> tuple[np.ndarray, ...]:
        """Feature, threshold, children (as places in the arrays; a leaf is its own child) and value of each node, and each tree's root."""
        nodes = self.nodes
        place = {(t, n): i for i, (t, n) in enumerate(zip(nodes["tree"], nodes["node"]))}
        leaf = nodes["left"].isna().to_numpy()
        own = np.arange(len(nodes))

        def child(side: str) -> np.ndarray:
            found = [i if stop else place[t, int(c)] for i, stop, t, c in zip(own, leaf, nodes["tree"], nodes[side])]
            return np.array(found, np.int64)

        at = {f: i for i, f in enumerate(self.features)}
        feature = np.array([0 if stop else at[f] for stop, f in zip(leaf, nodes["feature"])], np.int64)
        threshold = np.where(leaf, np.inf, nodes["threshold"].astype(float).fillna(np.inf))
        value = nodes["value"].astype(float).to_numpy() * nodes["tree_weight"].astype(float).to_numpy()
        roots = np.array([place[t, 0] for t in range(self.trees)], np.int64)
        return feature, threshold, child("left"), child("right"), value, roots

    def _summed(self, prefixes: Sequence[int]):
        """A column function: the summed leaf values of the first ``p`` trees, for every ``p`` of the ascending ``prefixes``."""
        shared = SparkSession.active().sparkContext.broadcast(self._arrays())
        wanted = list(prefixes)

        # Nested, so that it travels with the task and executors need no copy of this package.
        @F.pandas_udf("array<double>")
        def summed(x: pd.Series) -> pd.Series:
            feature, threshold, left, right, value, roots = shared.value
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            line = np.arange(len(rows))
            total, out, done = np.zeros(len(rows)), np.zeros((len(rows), len(wanted))), 0
            for i, upto in enumerate(wanted):
                for root in roots[done:upto]:
                    at = np.full(len(rows), root)
                    while True:
                        after = np.where(rows[line, feature[at]] <= threshold[at], left[at], right[at])
                        if (after == at).all():
                            break
                        at = after
                    total += value[at]
                done = max(done, upto)
                out[:, i] = total
            return pd.Series(list(out))

        return summed

    def _probability(self, summed: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-2.0 * summed)) if self.kind == BOOSTED else summed

    def inputs(self) -> Column:
        return F.array(*[F.col(quote_name(f)).cast("double") for f in self.features])

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and the probability of the positive class."""
        score = self._probability(self._summed([self.trees])(self.inputs())[0])
        return df.select(*[F.col(quote_name(c)) for c in keep], score.alias(SCORE))

    def staged(self, df: DataFrame, keep: Sequence[str], prefixes: Sequence[int], inputs: Column | None = None) -> DataFrame:
        """``keep``, ``trees`` and the probability after so many rounds: a row per row of ``df`` and prefix, from one pass.

        ``inputs``: the features as an array, if ``df`` has them in another form than columns.
        """
        wanted = sorted({min(p, self.trees) for p in prefixes})
        counts = F.array(*[F.lit(p) for p in wanted])
        staged = F.arrays_zip(counts.alias("trees"), self._summed(wanted)(self.inputs() if inputs is None else inputs).alias("sum"))
        rows = df.select(*[F.col(quote_name(c)) for c in keep], F.explode(staged).alias("s"))
        return rows.select(*[F.col(quote_name(c)) for c in keep], F.col("s.trees").alias("trees"), self._probability(F.col("s.sum")).alias(SCORE))

    def importance(self, spark: SparkSession) -> DataFrame:
        """``(feature, importance)`` of every feature."""
        return importance(self.to_frame(spark), self.features)


def _typed(row) -> tuple:
    """Plain values of the node schema's types."""
    tree, node, feature, threshold, left, right, gain, weight, value, tree_weight = row

    def number(v, kind):
        return None if v is None else kind(v)

    return (
        int(tree), int(node), feature, number(threshold, float), number(left, int), number(right, int), number(gain, float), float(weight),
        number(value, float), float(tree_weight),
    )


def importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` of every feature from a node table: its share of the gain times rows over all trees; zero if none splits."""
    gains = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    named = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    # A row per feature.
    joined = named.join(F.broadcast(gains), "feature", "left")
    whole = F.sum("gain").over(Window.partitionBy(F.lit(1)))
    return joined.select("feature", F.coalesce(F.try_divide(F.col("gain"), whole), F.lit(0.0)).alias("importance"))
