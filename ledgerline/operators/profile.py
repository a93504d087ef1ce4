"""Table profiles. One wide aggregate per profile, turned into rows afterwards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import (
    is_missing,
    kurtosis_corrected,
    lookup,
    nan_to_null,
    quote_name,
    skewness_corrected,
    numeric_text,
    to_double,
)
from ledgerline.functions.numeric import as_column, project
from ledgerline.functions.ordering import BUCKET, ROWS_PER_BUCKET, range_splits, with_range_bucket
from ledgerline.functions.quantiles import exact_quantiles, quantiles_with

def _rows(wide: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One row per struct from a one-row frame."""
    return wide.select(F.inline(F.array(*structs)))


def _nothing(df: DataFrame, schema: str) -> DataFrame:
    """No column qualifies: no row."""
    return df.sparkSession.createDataFrame([], schema)


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def year_counts(df: DataFrame, date_column: str) -> DataFrame:
    """``(year, n, pct)``; rows without a date are left out."""
    counts = df.groupBy(F.year(date_column).alias("year")).agg(F.count("*").alias("n")).filter("year is not null")
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("year", "n", (_share(F.col("n"), total) * 100).alias("pct"))


def table_shape(df: DataFrame, date_column: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(date_column).alias("date_min"),
        F.max(date_column).alias("date_max"),
    )


def order_check(df: DataFrame, value: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Is ``value`` non-decreasing when the rows are read in order of ``key`` (unique)?

    ``(n_pairs, n_inversions, is_sorted)``. Neighbours are compared inside ranges of the key;
    one row per range carries its first and last value across the range borders.
    """
    slim = df.select(F.col(value).alias("v"), F.col(key).alias("k"))
    cut = with_range_bucket(slim, "k", range_splits(slim, "k", rows_per_bucket))
    inside = cut.withColumn("p", F.lag("v").over(Window.partitionBy(BUCKET).orderBy("k")))
    ranges = inside.groupBy(BUCKET).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("v") < F.col("p")).alias("bad"),
        F.min_by("v", "k").alias("first"),
        F.max_by("v", "k").alias("last"),
    )
    # One row per range from here on.
    joined = ranges.withColumn("before", F.lag("last").over(Window.orderBy(BUCKET)))
    return joined.agg(
        F.greatest(F.coalesce(F.sum("n"), F.lit(0)) - 1, F.lit(0)).alias("n_pairs"),
        (F.coalesce(F.sum("bad"), F.lit(0)) + F.count_if(F.col("first") < F.col("before"))).alias("n_inversions"),
    ).select("n_pairs", "n_inversions", (F.col("n_inversions") == 0).alias("is_sorted"))


def missing_counts(df: DataFrame) -> DataFrame:
    """``(column, missing, n_rows)`` from a single pass."""
    fields = df.schema.fields
    wide = df.agg(
        F.count("*").alias("_n"), *[F.count_if(is_missing(f)).alias(f"_m{i}") for i, f in enumerate(fields)]
    )
    return _rows(
        wide,
        [
            F.struct(
                F.lit(f.name).alias("column"), F.col(f"_m{i}").alias("missing"), F.col("_n").alias("n_rows")
            )
            for i, f in enumerate(fields)
        ],
    )


def missing_rates(df: DataFrame, threshold: float = 0.30) -> DataFrame:
    """``(column, missing, rate, action)``: drop above the threshold, impute if any, else keep."""
    rate = _share(F.col("missing"), F.col("n_rows"))
    return missing_counts(df).select(
        "column",
        "missing",
        rate.alias("rate"),
        F.when(rate > threshold, "DROP").when(rate > 0, "impute").otherwise("keep").alias("action"),
    )


def missing_summary(df: DataFrame, threshold: float = 0.30) -> DataFrame:
    rate = _share(F.col("missing"), F.col("n_rows"))
    return missing_counts(df).agg(
        F.sum("missing").alias("missing_cells"),
        (_share(F.sum("missing"), F.sum("n_rows")) * 100).alias("missing_pct"),
        F.count_if(rate > 0).alias("columns_with_any"),
        F.count_if(rate > threshold).alias("columns_over"),
        F.count("*").alias("n_columns"),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each equal group; NULL equals NULL.

    Rows are counted by a fingerprint of 128 bits, so their values don't travel; only those that share one are compared whole.
    """
    wanted = [as_column(c) for c in (columns or df.columns)]
    # NULLs are left out of the hash, so their places are hashed as well.
    nulls = F.array(*[c.isNull() for c in wanted])
    rows = df.select(F.xxhash64(*wanted).alias("_h"), F.xxhash64(F.lit(1), nulls, *wanted).alias("_g"), *[c.alias(f"_c{i}") for i, c in enumerate(wanted)])
    groups = rows.groupBy("_h", "_g").agg(F.count("*").alias("_n"))
    shared = rows.join(groups.filter("_n > 1"), ["_h", "_g"], "left_semi").groupBy(*[f"_c{i}" for i in range(len(wanted))])
    none = F.lit(0).cast("bigint")
    whole = groups.agg(F.coalesce(F.sum("_n"), none).alias("n_rows"), none.alias("n_duplicates"))
    again = shared.agg((F.count("*") - 1).alias("_n")).agg(none.alias("n_rows"), F.coalesce(F.sum("_n"), none).alias("n_duplicates"))
    return whole.unionByName(again).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_duplicates").alias("n_duplicates"))


def consistency_report(df: DataFrame, rules: Sequence[tuple[str, Sequence[str], str]]) -> DataFrame:
    """``(rule, violations, status)`` of the rules whose columns are all present."""
    usable = [(label, cond) for label, needed, cond in rules if set(needed) <= set(df.columns)]
    if not usable:
        return _nothing(df, "rule string, violations bigint, status string")
    wide = df.agg(*[F.count_if(F.expr(cond)).alias(f"_r{i}") for i, (_, cond) in enumerate(usable)])
    return _rows(
        wide,
        [
            F.struct(
                F.lit(label).alias("rule"),
                F.col(f"_r{i}").alias("violations"),
                F.when(F.col(f"_r{i}") == 0, "OK").otherwise("WARNING").alias("status"),
            )
            for i, (label, _) in enumerate(usable)
        ],
    )


def _as_number(df: DataFrame, column: str) -> Column:
    """A numeric reading of a column; text may end in a percent sign."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return nan_to_null(F.col(quote_name(column)).cast("double"))
    return to_double(F.rtrim(F.col(quote_name(column)).cast("string"), F.lit("%")))


SUMMARY_SCHEMA = "column string, min double, median double, mean double, max double, outliers bigint"


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, min, median, mean, max, outliers)``; outliers lie beyond mean +- 3 sample sd."""
    exprs = {c: _as_number(df, c) for c in columns if c in df.columns}
    moments = lambda e: F.struct(F.min(e).alias("low"), F.max(e).alias("high"), F.avg(e).alias("mean"), F.stddev_samp(e).alias("sd"))

    def outside(_: str, e: Column, m) -> Column:
        if m.low is None or m.low == m.high:
            return F.lit(False)
        return (e < m.mean - 3 * m.sd) | (e > m.mean + 3 * m.sd)

    medians, stats, outliers = quantiles_with(df, exprs, [0.5], moments, outside)
    rows = [(c, m.low, medians[c][0], m.mean, m.high, outliers[c]) for c, m in stats.items() if m.low is not None]
    return df.sparkSession.createDataFrame(rows, SUMMARY_SCHEMA)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``(value, n, pct)`` with NULL as a value of its own; ``top`` keeps the most frequent."""
    counts = df.groupBy(as_column(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.select("value", "n", (_share(F.col("n"), total) * 100).alias("pct"))
    return shares if top is None else shares.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(top)


def class_balance(df: DataFrame, status: str, positive: str, negative: str) -> DataFrame:
    """Counts and rates of the two final classes, their ratio and its severity."""
    row = df.filter(F.col(status).isin(positive, negative)).agg(
        F.count("*").alias("n_total"),
        F.count_if(F.col(status) == negative).alias("n_negative"),
        F.count_if(F.col(status) == positive).alias("n_positive"),
    )
    ratio = F.coalesce(_share(F.col("n_negative"), F.col("n_positive")), F.lit(float("inf")))
    return row.select(
        "n_total",
        "n_negative",
        "n_positive",
        _share(F.col("n_positive"), F.col("n_total")).alias("positive_rate"),
        ratio.alias("imbalance"),
        F.when(ratio < 5, "Moderate").otherwise("Severe").alias("severity"),
    )


def yearly_rates(df: DataFrame, date_column: str, label: str) -> DataFrame:
    """``(year, n, n_positive, rate)`` of a 0/1 label."""
    return df.groupBy(F.year(date_column).alias("year")).agg(
        F.count(label).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("n_positive"),
        F.avg(label).alias("rate"),
    )


def drift_summary(df: DataFrame, date_column: str, label: str, limit: float = 0.05) -> DataFrame:
    """``(rate_range, drifted)`` over the yearly rates."""
    spread = F.max("rate") - F.min("rate")
    return yearly_rates(df, date_column, label).agg(spread.alias("rate_range"), (spread > limit).alias("drifted"))


def type_census(df: DataFrame) -> DataFrame:
    """``(column, kind)``: numeric, date, categorical, or numeric_text for numbers kept as text.

    A text column counts as numeric text if every value reads as a number once a percent sign
    and anything after the first blank are cut off.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    leading = {
        c: numeric_text(F.split(F.trim(F.rtrim(F.col(quote_name(c)), F.lit("%"))), r"\s+")[0]) for c in text
    }
    wide = df.agg(
        F.count("*").alias("_n"),
        *[(F.count(leading[c]) == F.count(quote_name(c))).alias(f"_t{i}") for i, c in enumerate(text)],
    )
    kinds = []
    for f in df.schema.fields:
        if f.name in text:
            kind = F.when(F.col(f"_t{text.index(f.name)}"), "numeric_text").otherwise("categorical")
        elif isinstance(f.dataType, T.NumericType):
            kind = F.lit("numeric")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = F.lit("date")
        else:
            kind = F.lit("other")
        kinds.append(F.struct(F.lit(f.name).alias("column"), kind.alias("kind")))
    return _rows(wide, kinds)


def value_counts_long(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """``(column, value, ...)`` counted over several columns in one scan; NULLs left out."""
    cells = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), as_column(c).cast("string").alias("value")) for c in columns]
            )
        ),
        *extra,
    ).filter(F.col("value").isNotNull())
    return cells


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_unique, top_value)``; of equally frequent values the smallest is the top."""
    counts = value_counts_long(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(
        F.count("*").alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value"),
    )


DESCRIBE_SCHEMA = (
    "column string, q1 double, median double, q3 double, n bigint, mean double, std double, min double, max double, skew double, kurtosis double"
)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample sd, min, quartiles, max, corrected skewness and kurtosis per column."""
    exprs = {c: nan_to_null(as_column(c).cast("double")) for c in columns}

    def moments(e: Column) -> Column:
        return F.struct(
            F.count(e), F.avg(e), F.stddev_samp(e), F.min(e), F.max(e), skewness_corrected(e), kurtosis_corrected(e)
        )

    quartiles, stats, _ = quantiles_with(df, exprs, [0.25, 0.5, 0.75], moments)
    rows = [(c, *quartiles[c], *stats[c]) for c in exprs]
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def iqr_outliers(df: DataFrame, columns: Sequence[str], keep_zero: bool = False) -> DataFrame:
    """Values beyond 1.5 interquartile ranges, most affected column first; the share is over all rows."""
    df, exprs = project(df, {c: nan_to_null(as_column(c).cast("double")) for c in columns})
    quartiles, ends, _ = quantiles_with(df, exprs, [0.25, 0.75], lambda e: F.struct(F.min(e), F.max(e), F.count("*")))
    quartiles = {c: q for c, q in quartiles.items() if q[0] is not None}
    empty = _nothing(df, "column string, outliers bigint, pct double, min double, max double, q1 double, q3 double")
    if not quartiles:
        return empty
    fences = {c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, q3) in quartiles.items()}
    wide = df.agg(*[F.count_if((exprs[c] < low) | (exprs[c] > high)).alias(f"s{i}") for i, (c, (low, high)) in enumerate(fences.items())])
    out = _rows(
        wide,
        [
            F.struct(
                F.lit(c).alias("column"), F.col(f"s{i}").alias("outliers"),
                (_share(F.col(f"s{i}"), F.lit(ends[c][2])) * 100).alias("pct"),
                F.lit(ends[c][0]).alias("min"), F.lit(ends[c][1]).alias("max"),
                F.lit(quartiles[c][0]).alias("q1"), F.lit(quartiles[c][1]).alias("q3"),
            )
            for i, c in enumerate(fences)
        ],
    )
    kept = out if keep_zero else out.filter("outliers > 0")
    return kept.orderBy(F.desc("pct"), "column")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``(bin, lower, upper, n)`` of equal-width bins; the maximum falls in the last bin."""
    col = nan_to_null(as_column(column).cast("double"))
    low, high = df.agg(F.min(col), F.max(col)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((col - low) / width).cast("int") + 1, F.lit(bins))
    return (
        df.filter(col.isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.lit(low) + (F.col("bin") - 1) * width).alias("lower"),
            (F.lit(low) + F.col("bin") * width).alias("upper"),
            "n",
        )
    )


def box_stats(df: DataFrame, columns: Sequence[str], label: str | None = None, classes: Sequence = ()) -> DataFrame:
    """Quartiles, whisker ends and flier count per column, overall or for each listed class."""
    groups = [("all", None)] if label is None else [(str(k), F.col(label) == F.lit(k)) for k in classes]
    exprs = {}
    for c in columns:
        value = nan_to_null(as_column(c).cast("double"))
        for name, cond in groups:
            exprs[c, name] = value if cond is None else F.when(cond, value)
    empty = _nothing(
        df,
        "column string, class string, n bigint, q1 double, median double, q3 double, whisker_low double, "
        "whisker_high double, fliers bigint",
    )
    df, exprs = project(df, exprs)
    quartiles = {k: q for k, q in exact_quantiles(df, exprs, [0.25, 0.5, 0.75]).items() if q[0] is not None} if exprs else {}
    if not quartiles:
        return empty
    aggs = []
    for i, (k, (q1, _, q3)) in enumerate(quartiles.items()):
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        e = exprs[k]
        within = e.between(low, high)
        aggs.append(
            F.struct(
                F.count(e).alias("n"),
                F.min(F.when(within, e)).alias("whisker_low"),
                F.max(F.when(within, e)).alias("whisker_high"),
                F.count_if(~within).alias("fliers"),
            ).alias(f"s{i}")
        )
    wide = df.agg(*aggs)
    return _rows(
        wide,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(name).alias("class"),
                F.col(f"s{i}.n").alias("n"),
                F.lit(q1).alias("q1"),
                F.lit(q2).alias("median"),
                F.lit(q3).alias("q3"),
                F.col(f"s{i}.whisker_low").alias("whisker_low"),
                F.col(f"s{i}.whisker_high").alias("whisker_high"),
                F.col(f"s{i}.fliers").alias("fliers"),
            )
            for i, ((c, name), (q1, q2, q3)) in enumerate(quartiles.items())
        ],
    )


def rates_by_category(df: DataFrame, columns: Sequence[str], target: str, max_levels: int = 20) -> DataFrame:
    """``(column, value, rate, n)``, highest rate first; columns of more levels are skipped."""
    stats = (
        value_counts_long(df, columns, [F.col(target).alias("_y")])
        .groupBy("column", "value")
        .agg(F.avg("_y").alias("rate"), F.count("_y").alias("n"))
    )
    # One row per profiled column.
    narrow = stats.groupBy("column").agg(F.count("*").alias("levels")).filter(F.col("levels") <= max_levels)
    kept = stats.join(F.broadcast(narrow), "column", "left_semi")
    return kept.orderBy("column", F.desc("rate"), "value")


def correlations(df: DataFrame, columns: Sequence[str], with_column: str | None = None) -> DataFrame:
    """``(a, b, r)``: Pearson correlation of each pair (or of each column with one), pairwise complete.

    NULL where either column is constant on the rows that have both, by its least and greatest value there. Each task sums the
    cross products of its rows about the columns' means, for any number of pairs; the sums of the tasks add up.
    """
    if with_column is None:
        pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    else:
        pairs = [(c, with_column) for c in columns if c != with_column]
    if not pairs:
        return _nothing(df, "a string, b string, r double")
    wanted = list(dict.fromkeys(n for p in pairs for n in p))
    df, exprs = project(df, {c: nan_to_null(as_column(c).cast("double")) for c in wanted})
    found = df.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(exprs.values())]).first()
    means = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in found])
    at = {c: i for i, c in enumerate(exprs)}
    upper = np.array([at[a] for a, _ in pairs]), np.array([at[b] for _, b in pairs])
    sums, ends = ("n", "sx", "sy", "sxx", "syy", "sxy"), ("lx", "ly", "hx", "hy")

    def products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every pair: counts and sums over the rows that have both; least and greatest values there (the latter negated)."""
        there = ~np.isnan(x)
        mask, centred = there.astype("float64"), np.where(there, x - means, 0.0)
        square = centred * centred
        added = np.stack(
            [mask.T @ mask, centred.T @ mask, mask.T @ centred, square.T @ mask, mask.T @ square, centred.T @ centred]
        )[:, upper[0], upper[1]]
        low, high = np.where(there, x, np.inf), np.where(there, -x, np.inf)
        whole = low.min(0, initial=np.inf), high.min(0, initial=np.inf)
        least = np.empty((2, x.shape[1], x.shape[1]))  # of column i over the rows that have column j
        for j in range(x.shape[1]):
            rows = there[:, j]
            for k, values in enumerate((low, high)):
                least[k, :, j] = whole[k] if rows.all() else values[rows].min(0, initial=np.inf)
        i, j = upper
        return added, np.stack([least[0, i, j], least[0, j, i], least[1, i, j], least[1, j, i]])

    def cross_products(batches):
        total = None
        for batch in batches:
            added, least = products(batch.to_numpy(dtype="float64", na_value=np.nan))
            total = (added, least) if total is None else (total[0] + added, np.minimum(total[1], least))
        if total is not None:
            cells = {n: total[0][k] for k, n in enumerate(sums)} | {n: total[1][k] for k, n in enumerate(ends)}
            yield pd.DataFrame({"pair": np.arange(len(upper[0])), **cells})

    parts = df.mapInPandas(cross_products, "pair int, " + ", ".join(f"{c} double" for c in (*sums, *ends)))
    total = parts.groupBy("pair").agg(*[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in ends])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread_x, spread_y = n * F.col("sxx") - sx * sx, n * F.col("syy") - sy * sy
    varies = (F.col("lx") < -F.col("hx")) & (F.col("ly") < -F.col("hy"))
    names = [F.array(*[F.lit(p[k]) for p in pairs]) for k in (0, 1)]
    return total.select(
        F.get(names[0], F.col("pair")).alias("a"), F.get(names[1], F.col("pair")).alias("b"),
        F.when(varies, F.try_divide(n * F.col("sxy") - sx * sy, F.sqrt(spread_x) * F.sqrt(spread_y))).alias("r"),
    )


def top_correlated(df: DataFrame, columns: Sequence[str], target: str, n: int = 20) -> DataFrame:
    """``(column, r, abs_r)`` of the ``n`` columns most correlated with the target."""
    return (
        correlations(df, columns, with_column=target)
        .select(F.col("a").alias("column"), "r", F.abs("r").alias("abs_r"))
        .filter("r is not null")
        .orderBy(F.desc("abs_r"), "column")
        .limit(n)
    )


def correlated_pairs(df: DataFrame, columns: Sequence[str], limit: float = 0.8) -> DataFrame:
    """Pairs with ``|r|`` above the limit, strongest first."""
    return correlations(df, columns).filter(F.abs("r") > limit).orderBy(F.abs("r").desc(), "a", "b")


def skew_screen(df: DataFrame, columns: Sequence[str], limit: float = 2.0, top: int = 8) -> DataFrame:
    """``(column, skew, log_skew)`` of the most skewed columns; the log takes non-negative values only."""
    df, exprs = project(df, {c: nan_to_null(as_column(c).cast("double")) for c in columns})
    wide = df.agg(
        *[
            F.struct(
                skewness_corrected(e).alias("skew"), skewness_corrected(F.when(e >= 0, F.log1p(e))).alias("log_skew")
            ).alias(f"s{i}")
            for i, e in enumerate(exprs.values())
        ]
    )
    long = _rows(
        wide,
        [
            F.struct(
                F.lit(c).alias("column"), F.col(f"s{i}.skew").alias("skew"), F.col(f"s{i}.log_skew").alias("log_skew")
            )
            for i, c in enumerate(exprs)
        ],
    )
    return long.filter(F.abs("skew") > limit).orderBy(F.abs("skew").desc(), "column").limit(top)


def target_distribution(df: DataFrame, target: str, labels: dict) -> DataFrame:
    """``(label, n, pct)`` of a coded class under readable names."""
    counts = value_counts(df, target)
    return counts.select(
        F.coalesce(lookup("value", labels), F.col("value").cast("string")).alias("label"), "n", "pct"
    )
