"""Tables written to the shared folder, to cut lineage and to be read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_path

BROADCAST_BYTES = 8 << 20
SALTS = 16


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    The files survive lost executors; like checkpoints, they are left for the cluster to clean.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join on null-safe ``keys`` (unique in ``small``) that stays even when one key holds much of ``big``.

    ``small`` is broadcast if its measured values fit ``max_bytes``; else its rows are copied to ``SALTS``
    salts and ``big`` is dealt over the salts, so that a hot key is split.
    """
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in small.columns]
    measured = small.agg(F.sum(sum(sizes[1:], sizes[0]))).first()[0] or 0
    right = small.select(*[F.col(c).alias(f"_right_{c}") for c in small.columns])
    condition = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in keys]
    if measured <= max_bytes:
        right = F.broadcast(right)
    else:
        right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        big = big.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
        condition.append(F.col("_salt") == F.col("_right_salt"))
    on = condition[0]
    for c in condition[1:]:
        on = on & c
    added = [F.col(f"_right_{c}").alias(c) for c in small.columns if c not in keys]
    kept = [c for c in big.columns if c != "_salt"]
    return big.join(right, on, how).select(*kept, *added)
