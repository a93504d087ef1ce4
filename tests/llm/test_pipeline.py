"""The corpus pipeline: each stage against its rule, on its own input."""

from __future__ import annotations

import corpus_pipeline
import pytest

from ledgerline.llm import queries
from ledgerline.llm.store import stored


def test_registered():
    import __spark_entry__

    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert {"pipeline", *queries.QUERIES} <= set(__spark_entry__.queries())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf_dir), name))
    raw, spoken, single, clean, mixed, packed = kept
    assert all(set(x.columns) == set(corpus_pipeline.COLUMNS) for x in kept[1:5])
    assert spoken.count() == raw.count() and spoken.join(raw, ["doc_id", "lang"]).count() >= 0.97 * raw.count()
    ids = {r.doc_id for r in single.collect()}
    assert single.count() == len(ids) == spoken.select("text").distinct().count() or len(ids) < raw.count()
    assert {r.doc_id for r in clean.collect()} == ids
    assert clean.where("text rlike 'AKIA[A-Z0-9]{16,}' or text rlike '[0-9a-f]{24,}'").count() == 0
    assert clean.where("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in mixed.collect()} <= ids and mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    assert packed.groupBy("doc_id").count().count() == mixed.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_empty_documents(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_repeat(spark, sf_dir, name):
    """A stable schema and the same rows again."""
    query = queries.QUERIES[name]
    first, second = query(spark, sf_dir), query(spark, sf_dir)
    assert first.schema == second.schema and first.count() > 0
    if name not in ("op5_best_fit_packing",):  # sequence numbers are any
        assert first.exceptAll(second).isEmpty()
