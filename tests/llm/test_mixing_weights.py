"""The mixture against the exact target weights: no error adds up, no smallest share, no most sources."""
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from dropcast.llm import mixing  # noqa: E402


def deviation(blocks, weights):
    """Most blocks that a source is ahead or behind after any slot; ``weights`` by source."""
    blocks = blocks.drop_duplicates("slot").sort_values("slot")
    assert list(blocks.slot) == list(range(len(blocks)))
    assert ((blocks.slot >= blocks.release) & (blocks.slot < blocks.deadline)).all()
    n = blocks.source.value_counts()
    points = np.unique(np.concatenate([[0.0], [n[s] / weights[s] for s in n.index]]))  # between these the ideal mixture is linear
    total = sum(np.minimum(weights[s] * points, n[s]) for s in n.index)
    at = np.interp(np.arange(1, len(blocks) + 1), total, points)
    return max(np.abs((blocks.source == s).cumsum().to_numpy() - np.minimum(weights[s] * at, n[s])).max() for s in n.index)


def test_many_frames_follow_the_exact_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 7_000)
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "s0").otherwise(
        F.concat(F.lit("s"), (1 + F.col("id") % 19).cast("string"))).alias("source"))
    got = mixing.mix(docs, block_rows=1).select("doc_id", "source", "slot", "release", "deadline").toPandas()
    assert got.doc_id.nunique() == 30_000
    assert deviation(got, (got.source.value_counts() ** 0.5).to_dict()) < 1.001


def test_small_weights_stay_small(spark):
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 6_000, "a").otherwise("b").alias("source"))
    weights = {"a": 2_999.0, "b": 1.0}
    got = mixing.mix(docs, weights, block_rows=1).select("source", "slot", "release", "deadline").toPandas()
    assert deviation(got, weights) < 1.001 and ((got.source == "b") & (got.slot < 5_900)).sum() <= 3


def test_more_sources_than_slots_of_a_frame(spark):
    docs = spark.range(1_300).select(F.col("id").alias("doc_id"), (F.col("id") % 1_100).cast("string").alias("source"))
    got = mixing.mix(docs, block_rows=1).select("source", "slot", "release", "deadline").toPandas()
    assert len(got) == 1_300 and deviation(got, (got.source.value_counts() ** 0.5).to_dict()) < 1.001
