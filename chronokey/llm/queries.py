"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, audio, counts, mixing, pieces, quality, sharding, simhash, toxicity, warc
from .shared import read


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(read(spark, sf_dir, "documents"), shards=24)
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source", "kept")


def not_held_out(id_col: str = "doc_id"):
    """Rows to learn labels from: crc32 of the id as text, modulo 5, isn't 0."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) != 0


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), not_held_out())
    rows = toxicity.score(docs, model)
    return rows.select("doc_id", F.coalesce(~not_held_out(), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds audio, so each embedding is rendered as a WAV recording of as many notes as it has components."""
    rows = audio.match(read(spark, sf_dir, "embeddings"), F.col("rec_id") % 100 == 0, "vec_id", audio=(["embedding"], audio.tone_row))
    return rows.withColumnRenamed("rec_id", "vec_id")


def op5_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page is taken as a response record with the headers a server would have sent."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"))
    source_id = F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))
    rows = warc.derivatives(pages, source_id, F.col("url"), F.col("html"), http, keep=["page_id"])
    return rows.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "content_length", F.crc32("record").alias("record_crc32"))


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.select(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"), "quality")
    return rows.select("doc_id", "expected_grade", "p_top", "keep")


def op10_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.count_tokens(docs, tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_stratified_interleaving": op1_stratified_interleaving,
    "op2_toxicity": op2_toxicity,
    "op3_projection_forest": op3_projection_forest,
    "op4_chroma_fingerprints": op4_chroma_fingerprints,
    "op5_pareto_mixing": op5_pareto_mixing,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_unigram_counts": op10_unigram_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op1_stratified_interleaving": sharding.shard_sql(),
    "op5_pareto_mixing": mixing.mix_sql(),
}
