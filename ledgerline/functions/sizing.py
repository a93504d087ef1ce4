"""Choices that depend on a known size: what to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import quote_name

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 16


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, whose measured values fit ``max_bytes``."""
    bytes_ = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            bytes_ = bytes_ + F.lit(8)
        else:
            text = df[quote_name(f.name)].cast("string")
            bytes_ = bytes_ + F.lit(16) + F.coalesce(F.octet_length(text), F.lit(0))
    n, held = df.select(bytes_.cast("long").alias("_bytes")).limit(max_rows + 1).agg(F.count("*"), F.sum("_bytes")).first()
    return n <= max_rows and (held or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if ``df`` is small; else leave it to the shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def lookup_join(
    df: DataFrame, lookup: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join of ``lookup``, whose ``key`` is unique, that stays even if one key holds much of ``df``.

    A small lookup is broadcast. Of a large one each row is copied to ``SALTS`` salts, over which the
    rows of ``df`` are dealt, so a hot key is spread over as many tasks.
    """
    if is_small(lookup, max_rows, max_bytes):
        return df.join(F.broadcast(lookup), key, "left")
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return dealt.join(copies, [key, "_salt"], "left").drop("_salt")
