"""Global running sums without a global window.

The rows are cut into value ranges. Each range is ordered in its own task, and the range
totals (at most ``MAX_BUCKETS`` rows) give each range its offset. A table
counted to fit one range is left in one piece.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.sizing import broadcast_if_small
from ledgerline.session import stored

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 10_000
SAMPLE_PER_BUCKET = 1_000
BUCKET = "_bucket"


def numeric_key(df: DataFrame, column: str) -> Column:
    """A double that orders like the column (equal or larger for a larger value)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def range_splits(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Interior split points that cut the column into ranges of about ``rows_per_bucket`` rows.

    None for a table that one task can order. The points come from a sample, as in Spark's own
    range partitioning: they decide how evenly the work is spread, never the result.
    """
    key = numeric_key(df, column)
    n = df.agg(F.count(key)).first()[0]
    if n <= rows_per_bucket:
        return []
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
    sample = df.sample(min(1.0, SAMPLE_PER_BUCKET * buckets / n), seed=1)
    shares = F.expr("array(" + ",".join(f"{i / buckets!r}D" for i in range(1, buckets)) + ")")
    points = sample.agg(F.approx_percentile(key, shares, 10 * buckets)).first()[0]
    # Infinite and NaN values stand at the ends anyway; as cut points they would part nothing.
    return sorted({p for p in points or [] if math.isfinite(p)})


def with_range_bucket(df: DataFrame, column: str, splits: Sequence[float]) -> DataFrame:
    """Adds the range number of the column; equal values always share a range."""
    if not splits:
        return df.withColumn(BUCKET, F.lit(0.0))
    bounds = [-math.inf, *splits, math.inf]
    marked = df.withColumn("_key", numeric_key(df, column))
    # NaN, which sorts last, gets a range of its own after the others.
    return Bucketizer(splits=bounds, inputCol="_key", outputCol=BUCKET, handleInvalid="keep").transform(marked).drop("_key")


def running_sums(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    splits: Sequence[float],
    descending: bool = False,
    by: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Adds, for each ``output: input``, the sum of ``input`` over all rows up to this one.

    ``df`` has one row per value of ``order`` (aggregate first, so that a heavily repeated
    value is one row). ``by`` keeps separate sums per group, of which there must be few;
    ``totals`` adds whole-group sums.
    """
    totals = totals or {}
    inputs = sorted({*sums.values(), *totals.values()})

    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    if not splits:
        whole = Window.partitionBy(*by)
        ordered = whole.orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(
            *df.columns,
            *[F.sum(c).over(ordered).alias(o) for o, c in sums.items()],
            *[F.sum(c).over(whole).alias(o) for o, c in totals.items()],
        )
    cut = with_range_bucket(df, order, splits)
    # At most MAX_BUCKETS rows per group, hence the window over them and the broadcast.
    per_range = cut.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"_s_{c}") for c in inputs])
    group = Window.partitionBy(*by)
    before = group.orderBy(direction(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *by,
        BUCKET,
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{o}") for o, c in sums.items()],
        *[F.sum(f"_s_{c}").over(group).alias(o) for o, c in totals.items()],
    )
    within = Window.partitionBy(*by, BUCKET).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(F.broadcast(offsets), [*by, BUCKET]).select(
        *df.columns,
        *[(F.col(f"_o_{o}") + F.sum(c).over(within)).alias(o) for o, c in sums.items()],
        *totals,
    )


def numbered(df: DataFrame, group: str, order: str) -> DataFrame:
    """Adds ``pos``: the place of the row in its group by ascending ``order``, from 0; (group, order) is unique.

    One range shuffle sorts all rows; what a group has in earlier ranges is the offset of its rows in a range, so a
    group that holds all rows is spread like any other.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(ranges, group, order).sortWithinPartitions(group, order)
    placed = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked").withColumn("_range", F.shiftright("_at", 33))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A row per group and range.
    spans = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    shifts = spans.select(group, "_range", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = placed.join(broadcast_if_small(shifts), [group, "_range"])
    return joined.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("pos"))
