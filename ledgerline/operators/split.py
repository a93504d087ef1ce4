"""Time-based splits and samples.

Both splits end as a comparison of the date (and a tie-break key) with values found
beforehand, so applying them needs no window, shuffle or join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import as_column
from ledgerline.functions.ordering import range_splits, running_sums
from ledgerline.functions.quantiles import order_statistics
from ledgerline.functions.sizing import lookup_join
from ledgerline.operators.filters import years_condition


def date_histogram(df: DataFrame, date_column: str) -> DataFrame:
    """``(date, n, upto, total)``: rows per date, rows up to it, and all rows; NULL dates left out."""
    counts = (
        df.filter(as_column(date_column).isNotNull())
        .groupBy(as_column(date_column).alias("date"))
        .agg(F.count("*").alias("n"))
    )
    # A calendar has few days; finer timestamps are cut into ranges.
    is_day = isinstance(counts.schema["date"].dataType, T.DateType)
    splits = [] if is_day else range_splits(counts, "date")
    return running_sums(counts, "date", {"upto": "n"}, splits, totals={"total": "n"})


def _percent_rank() -> Column:
    return F.coalesce(F.try_divide((F.col("upto") - F.col("n")).cast("double"), F.col("total") - 1), F.lit(0.0))


def with_percent_rank(df: DataFrame, date_column: str, output: str) -> DataFrame:
    """``percent_rank() over (order by date)`` of the dated rows, from the date histogram; NULL without a date."""
    ranks = date_histogram(df, date_column).select(F.col("date").alias(date_column), _percent_rank().alias(output))
    return lookup_join(df, ranks, date_column)


def rank_cutoff(df: DataFrame, date_column: str, share: float):
    """The last date whose percent rank is below ``share``."""
    return date_histogram(df, date_column).filter(_percent_rank() < share).agg(F.max("date")).first()[0]


def position_condition(df: DataFrame, date_column: str, key: str, first_rows: int) -> Column:
    """True for the first ``first_rows`` rows in order of (date, key); the key must be unique.

    Only the date on which the count runs out needs its keys looked at, and there one order
    statistic decides, so a date holding much of the table is no obstacle.
    """
    date = as_column(date_column)
    if first_rows <= 0:
        return F.lit(False)
    edge = (
        date_histogram(df, date_column)
        .filter(F.col("upto") >= first_rows)
        .agg(F.min_by(F.struct("date", "n", "upto"), "date"))
        .first()[0]
    )
    if edge is None:
        return F.lit(True)
    on_edge = first_rows - (edge["upto"] - edge["n"])
    if on_edge == edge["n"]:
        return date <= F.lit(edge["date"])
    same_day = df.filter(date == F.lit(edge["date"]))
    last = order_statistics(same_day, {key: as_column(key)}, {key: [on_edge - 1]})[key, on_edge - 1]
    return (date < F.lit(edge["date"])) | ((date == F.lit(edge["date"])) & (as_column(key) <= F.lit(last)))


def time_split(
    df: DataFrame,
    date_column: str,
    train_years: Sequence[int],
    test_years: Sequence[int],
    train_share: float = 0.80,
    tie_key: str | None = None,
    output: str = "split",
) -> DataFrame:
    """Adds ``train``/``val``/``test``; rows of other years are dropped.

    Without ``tie_key`` the percent rank of the date decides, so a date is never divided.
    With it, exactly the first ``int(n * train_share)`` rows train.
    """
    early_condition = years_condition(date_column, train_years)
    early = df.filter(early_condition)
    if tie_key is None:
        cutoff = rank_cutoff(early, date_column, train_share)
        in_train = F.lit(False) if cutoff is None else as_column(date_column) <= F.lit(cutoff)
    else:
        in_train = position_condition(early, date_column, tie_key, int(early.count() * train_share))
    return df.filter(years_condition(date_column, [*train_years, *test_years])).withColumn(
        output, F.when(early_condition & in_train, "train").when(early_condition, "val").otherwise("test")
    )


def split_summary(df: DataFrame, split: str, target: str, date_column: str) -> DataFrame:
    """``(split, n, rate, date_min, date_max)`` in one pass."""
    return df.groupBy(F.col(split).alias("split")).agg(
        F.count("*").alias("n"),
        F.avg(target).alias("rate"),
        F.min(date_column).alias("date_min"),
        F.max(date_column).alias("date_max"),
    )


def allotted(counts: Mapping[object, int], target_n: int) -> dict[object, int]:
    """``target_n`` shared out by size, whole numbers by largest remainder, equal ones to the first class listed."""
    total = sum(counts.values())
    exact = {k: target_n * n / total for k, n in counts.items()}
    out = {k: int(e) for k, e in exact.items()}
    for k in sorted(counts, key=lambda k: out[k] - exact[k])[: target_n - sum(out.values())]:
        out[k] += 1
    return out


def stratified_sample(
    df: DataFrame, target_n: int, label: str, seed: int = 42, key: str | None = None
) -> DataFrame:
    """``target_n`` rows with the class shares of ``label``, each class right to one row; a smaller table is returned whole.

    Each class keeps its rows of least hash (of the key, else of the whole row), cut at an exact order statistic. The draw is
    the same for any partitioning. Rows without a label are a class of their own; rows that share a hash go together.
    """
    if label not in df.columns:
        raise ValueError(f"no column {label}")
    counts = {r[0]: r[1] for r in df.groupBy(label).agg(F.count("*")).collect()}  # a row per class
    if sum(counts.values()) <= target_n:
        return df
    drawn = F.xxhash64(F.lit(seed), *[as_column(c) for c in ([key] if key else df.columns)])
    taken = {k: n for k, n in allotted(dict(sorted(counts.items(), key=lambda c: (c[0] is None, c[0]))), target_n).items() if n}
    of_class = {str(i): F.when(as_column(label).eqNullSafe(F.lit(k)), drawn) for i, k in enumerate(taken)}
    edges = order_statistics(df, of_class, {str(i): [n - 1] for i, n in enumerate(taken.values())})
    kept = F.lit(False)
    for i, (k, n) in enumerate(taken.items()):
        kept = kept | (as_column(label).eqNullSafe(F.lit(k)) & (drawn <= F.lit(edges[str(i), n - 1])))
    return df.filter(kept)


def hash_sample(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """The same share of every class, chosen by a hash of the key: independent of partitioning."""
    if share >= 1:
        return df
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), as_column(key).cast("string"))), 1, 8)
    return df.filter(digest < F.lit(f"{int(share * 16**8):08x}"))


def most_recent(df: DataFrame, date_column: str, key: str, n: int) -> DataFrame:
    """The last ``n`` rows in order of (date, key); rows without a date do not count."""
    dated = df.filter(as_column(date_column).isNotNull())
    total = dated.count()
    if total <= n:
        return dated
    return dated.filter(~position_condition(dated, date_column, key, total - n))
