"""One query per operator over its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    codebooks, cover_tree, language, manifest, mixing, oracle, packing, quantised, repeats, secret_scan, sharding, simhash, winnowing,
    wrappers,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_cover_tree_top_k": oracle.TOP_K,
    "op7_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op11_vector_code_compression": oracle.VECTOR_CODES,
    "op12_merkle_manifest": oracle.MERKLE_MANIFEST,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hex64(value) :
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def vocabulary() -> str:
    """The public 50k byte-level vocabulary, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def op1_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def remainder():
    """crc32(doc_id as text) mod 4; 2 is held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder() != 2))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder() == 2).alias("held_out"), "lang_pred", "score"
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    base = F.filter("secrets", lambda s: s["order"] < 3)
    count = {
        f"n_{r.kind}": F.size(F.filter("secrets", lambda s: s["order"] == i)).cast("long")
        for i, r in enumerate(secret_scan.RULES) if r.base
    }
    return found.select(
        "doc_id", *[c.alias(n) for n, c in count.items()], F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secrets")).alias("spans"),
    )


@query
def op9_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64("fingerprint").alias("fingerprint"), "component_id")


@query
def op11_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.coded(*codebooks.compress(table(spark, sf_dir, "embeddings")))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


@query
def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), winnowing.listed(F.col("fingerprint")).alias("fingerprint"),
        winnowing.listed(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
