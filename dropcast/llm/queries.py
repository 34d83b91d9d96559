"""Registered queries of the corpus operators: (spark, sf_dir) -> DataFrame; SQL is their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, embedding_dedup, licenses, lm, merkle, minhash_dedup, mixing, sharding, suffix_dedup, token_counts, toxicity, vector_codes
from .common import ship_package, table
from .sql import SQL

__all__ = ["QUERIES", "SQL"]


def permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def suffix_dedup_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def byte_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_both(table(spark, sf_dir, "documents"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def piece_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root, proof digest, and the check of a copy that lost line feeds."""
    return merkle.verify_copy(table(spark, sf_dir, "documents"))


def part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's codes, its error, that of its label, and the digest of the codebooks."""
    return vector_codes.label_codes(table(spark, sf_dir, "embeddings"))


def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the model of the documents that are not held out."""
    return lm.score_documents(spark, table(spark, sf_dir, "documents"))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES = {name: _shipped(query) for name, query in {
    "op1_permutation_search": permutation_search,
    "op2_suffix_dedup": suffix_dedup_spans,
    "op3_byte_bpe_codec": byte_bpe_codec,
    "op4_license_scan": license_scan,
    "op4_license_lines": license_lines,
    "op5_pfair_mix": source_mix,
    "op6_crf_toxicity": crf_toxicity,
    "op7_piece_token_counts": piece_token_counts,
    "op8_lpt_shards": lpt_shards,
    "op9_embedding_near_dedup": embedding_near_dedup,
    "op10_minhash_near_dedup": minhash_near_dedup,
    "op11_merkle_manifest": merkle_manifest,
    "op12_vector_codes": part_codes,
    "op13_kneser_ney": kneser_ney,
}.items()}
