"""From raw documents to packed sequences; every stage reads all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import language, mixing, packing, secret_scan, simhash
from ledgerline.llm.queries import vocabulary
from ledgerline.llm.store import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SHARE = 0.25


def label_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets ``lang`` to the predicted language; drops texts of no known language, and those in which
    no language reaches ``LEAST_SHARE`` of the letters. The labels of the input teach the model."""
    model = language.fit(docs)
    found = language.predict(docs.select(*COLUMNS), model)
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return found.where(known).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component, that of the smallest doc_id."""
    return simhash.representatives(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the text by a mark and counts the characters anew; keeps every document."""
    found = secret_scan.scan(docs.select(*COLUMNS))
    text = secret_scan.redacted(F.col("text"), F.col("secrets"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks: a row per copy, none for those left out."""
    others = tuple(c for c in COLUMNS if c not in ("doc_id", "source"))
    mixed = mixing.mix(docs, carry=others).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packing.packed(docs, vocabulary(), keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", label_languages),
    ("near_duplicates", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained languages, fingerprints and token ids are outside SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
