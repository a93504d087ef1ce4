"""Category levels as a table, for columns of any number of levels.

The dictionary has a row per column and training value: the level it stands for (rare values share one) and that level's place
in ascending order. It is counted, numbered and joined by Spark; what the driver keeps is a size and a mode per column. Rows get
the place by a join that is broadcast only for a small dictionary and salted else, and a sparse vector with a single entry.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import quote_name
from ledgerline.functions.ordering import numbered
from ledgerline.functions.sizing import BROADCAST_BYTES, BROADCAST_ROWS, lookup_join
from ledgerline.session import stored

SCHEMA = "column string, value string, level string, place bigint"


@dataclass
class Levels:
    """The dictionary and, per column, the number of levels and the most frequent one."""

    dictionary: DataFrame
    sizes: dict[str, int]
    modes: dict[str, str]

    def save(self, path: str) -> None:
        spark = self.dictionary.sparkSession
        self.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        rows = [(c, n, self.modes[c]) for c, n in self.sizes.items()]
        spark.createDataFrame(rows, "column string, size bigint, mode string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Levels:
        columns = spark.read.parquet(f"{path}/columns").collect()  # a row per column
        return Levels(
            spark.read.schema(SCHEMA).parquet(f"{path}/dictionary"), {r["column"]: r["size"] for r in columns}, {r["column"]: r["mode"] for r in columns}
        )

    def _joined(self, df: DataFrame, column: str, missing: str | None, max_rows: int, max_bytes: int) -> DataFrame:
        """``df`` with ``_value`` (``missing`` for a missing one), ``_level`` and ``_place``."""
        own = self.dictionary.where(F.col("column") == column).select(
            F.col("value").alias("_value"), F.col("level").alias("_level"), F.col("place").alias("_place")
        )
        filled = F.coalesce(F.col(quote_name(column)).cast("string"), F.lit(missing).cast("string"))
        return lookup_join(df.withColumn("_value", filled), own, "_value", max_rows, max_bytes)

    def merged(self, df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Rare levels replaced by their common one; missing and unseen values stay."""
        out = df
        for c in self.sizes:
            level = F.coalesce("_level", "_value").alias(c)
            out = self._joined(out, c, None, max_rows, max_bytes).select(*[level if x == c else F.col(quote_name(x)) for x in df.columns])
        return out

    def encoded(
        self, df: DataFrame, output: str = "categories", drop_first: bool = False, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
    ) -> DataFrame:
        """Adds the columns' 0/1 vectors side by side as one sparse vector; a missing value is the mode, an unseen level has no entry.

        ``drop_first`` leaves out each column's first level.
        """
        out, indices, vectors = df, [], []
        for i, (c, size) in enumerate(self.sizes.items()):
            # The place after the last one stands for "no entry" and is dropped by the encoder, as is the first level.
            none = size - 1 if drop_first else size
            place = F.col("_place") - 1 if drop_first else F.col("_place")
            index = F.when(place >= 0, place).otherwise(F.lit(none)).cast("double")
            nominal = {"ml_attr": {"type": "nominal", "num_vals": none + 1}}
            out = self._joined(out, c, self.modes[c], max_rows, max_bytes).withColumn(f"_index{i}", index.alias(f"_index{i}", metadata=nominal))
            out = out.drop("_value", "_level", "_place")
            if none:
                indices.append(f"_index{i}")
                vectors.append(f"_vector{i}")
        if not vectors:
            raise ValueError("no column with levels to encode")
        hot = OneHotEncoder(inputCols=indices, outputCols=vectors, dropLast=True).fit(out.limit(0)).transform(out)
        return VectorAssembler(inputCols=vectors, outputCol=output).transform(hot).select(*[F.col(quote_name(x)) for x in df.columns], output)


def fit_levels(train: DataFrame, columns: Sequence[str], rare: Sequence[str] = (), threshold: int = 50, label: str = "other") -> Levels:
    """The levels of ``columns`` in the training rows; values of the ``rare`` columns seen fewer than ``threshold`` times share ``label``.

    Missing values are no level. A column without values is left out.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(quote_name(c)).cast("string").alias("value")) for c in columns])
    counts = train.select(F.inline(cells)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    few = F.col("column").isin(*rare) & (F.col("n") < threshold) if rare else F.lit(False)
    counts = stored(counts.withColumn("level", F.when(few, F.lit(label)).otherwise(F.col("value"))), "levels")
    levels = counts.groupBy("column", "level").agg(F.sum("n").alias("n"))
    placed = stored(numbered(levels, "column", "level").withColumnRenamed("pos", "place"), "levels")
    summary = placed.groupBy("column").agg(
        F.count("*").alias("size"), F.min_by("level", F.struct((-F.col("n")).alias("n"), F.col("level").alias("level"))).alias("mode")
    )
    found = {r["column"]: r for r in summary.collect()}  # a row per column
    # A level stands for itself too. Both sides have a row per value or level; a level that many values share is spread by their hash.
    places = placed.select("column", "level", "place")
    values = counts.select("column", "value", "level").unionByName(places.select("column", F.col("level").alias("value"), "level")).distinct()
    salted = values.withColumn("_salt", F.pmod(F.xxhash64("value"), F.lit(16)).cast("int"))
    copies = places.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    dictionary = salted.join(copies, ["column", "level", "_salt"]).select("column", "value", "level", "place")
    kept = [c for c in columns if c in found]
    return Levels(stored(dictionary, "levels"), {c: found[c]["size"] for c in kept}, {c: found[c]["mode"] for c in kept})
