"""Tasks of the passes of a fit: bounded, as each reports to the driver in every pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import models as md


def test_tasks_do_not_follow_the_rows():
    assert [md.fit_tasks(b) for b in (0, 10 << 20, 200 << 20, 2 << 30, 12 << 30)] == [1, 3, 24, 24, 24]
    assert md.fit_tasks(100 << 30) == 200


@pytest.mark.parametrize("small", [0, 256 << 20])
def test_a_pass_over_many_partitions_has_few_tasks(spark, monkeypatch, small):
    monkeypatch.setattr(md, "SMALL_TABLE_BYTES", small)
    monkeypatch.setattr(md, "PARTITION_BYTES", 1)
    rows = spark.range(0, 6_000, 1, 60).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    with md.training_rows(rows, ["x"], "y", keep=[F.col("id")]) as kept:
        assert kept.rdd.getNumPartitions() == md.MOST_TASKS
        assert kept.agg(F.count("*"), F.sum("id")).first() == (6_000, 5_999 * 3_000)
