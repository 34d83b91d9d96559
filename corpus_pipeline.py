"""Corpus pipeline: toxicity, near duplicates, repeated passages, source mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is written as
Parquet and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dropcast.llm import byte_bpe, minhash_dedup, mixing, suffix_dedup, toxicity
from dropcast.llm.common import cut, discard, packed, ship_package, table, unpacked
from dropcast.operators.joins import checked_broadcast


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below the threshold, unchanged. Labels are learned as in the registered query."""
    ship_package(spark)
    rows = packed(docs, "doc_id", "text")
    chain = toxicity.fit(rows.select("doc_id", "text"), table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(rows, chain, carry=("row",))
    return unpacked(scored.where(F.col("score") < toxicity.THRESHOLD), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, unchanged."""
    ship_package(spark)
    return minhash_dedup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; passages of 200 bytes or more that start elsewhere too are cut out of the texts, n_chars follows.
    A row whose whole text goes stays with an empty text; a null text becomes empty."""
    ship_package(spark)
    out = suffix_dedup.remove_repeats(packed(docs, "doc_id", "text"), carry=("row",), as_text=True)
    return unpacked(out, docs.columns, text=F.col("kept"), n_chars=F.length("kept").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mixture. Every row has a place of its own, also where ids are null or repeated."""
    return unpacked(mixing.mix(packed(docs, "doc_id", "source"), carry=("row",)).orderBy("position"), docs.columns)


def file_positions(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the rows of Parquet files and their ``position`` from 0: files by part number and name, rows as they lie in a
    file. Spark reads files by descending size, so the order of a DataFrame's rows does not tell. ``docs`` is read from files."""
    lies = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*columns).alias("row"), lies["file_name"].alias("file"), lies["row_index"].alias("nth"))
    part = F.regexp_extract("file", r"^part-(\d+)", 1)
    before = Window.partitionBy(F.lit(0)).orderBy(F.when(part != "", part.cast("long")), "file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))  # one row per file
    starts = sizes.select(F.col("file").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    starts = checked_broadcast(starts, known_rows=len(docs.inputFiles()))
    return rows.join(starts, F.col("file") == F.col("of")).select("row.*", (F.col("before") + F.col("nth")).cast("long").alias("position"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact, position) of every row; ``position`` numbers the rows from 0 in the order of the
    mixture, which is that of the input files. The order of the rows themselves says nothing."""
    ship_package(spark)
    placed = file_positions(docs, "doc_id", "text").select(F.struct("doc_id", "position").alias("at"), "text")
    out = byte_bpe.coded(placed, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, id_col="at")
    return out.select("at.doc_id", "ids", "n_tokens", "exact", "at.position")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_texts),
]
ORACLE_SQL = None  # a learned model and connected components; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = last = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(last, "cut_path"):
            discard(last)
        last = docs
    return docs
