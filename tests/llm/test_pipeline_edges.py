"""The pipeline's stages with columns whose names clash, nulls in every column, repeated ids, and empty tables."""
import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("tiktoken")
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from dropcast.llm import licenses  # noqa: E402
from dropcast.llm.common import cut, grouped_rank  # noqa: E402

CLASHES = ("_id", "_source", "_position", "_gone", "_file", "_row", "_before", "_known", "score", "kept", "spans", "at", "position", "row", "id", "h", "c0",
           "h1", "runs", "file", "nth", "before", "of", "rank", "block", "class_id", "f0", "a b")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def _rows():
    passage = " ".join(f"passage{k * 13 % 97}" for k in range(60))
    texts = [f"plain words number {k} " + " ".join(f"w{k * j % 89}" for j in range(30)) for k in range(40)]
    texts += [None, None, "", "short", f"one {passage}", f"two {passage} end", "zzvile zzrotten " * 5]
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    return [(i, t, None if k % 4 else "en", None if k % 5 == 0 else f"s{k % 3}", None if k % 7 == 0 else len(t or ""), *(f"{c}{k}" if k % 2 else None for c in CLASHES))
            for k, (i, t) in enumerate(zip(ids, texts))]


def test_clashing_names_and_nulls(spark, tmp_path):
    rows = _rows()
    spark.createDataFrame([(k, 1, int(k == 23)) for k in range(24)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = cut(spark.createDataFrame(rows, SCHEMA), "edges")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = cut(stage(spark, before, str(tmp_path)), "edges")
        if name != "byte_bpe":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            untouched = ["doc_id", "lang", "source", *(f"`{c}`" for c in CLASHES)]
            assert docs.select(*untouched).exceptAll(before.select(*untouched)).isEmpty()
        if name in ("suffix_dedup", "source_mix"):
            assert docs.count() == before.count()
    assert docs.columns == ["doc_id", "ids", "n_tokens", "exact", "position"]
    assert sorted(r.position for r in docs.collect()) == list(range(docs.count())) and docs.where("not exact").isEmpty()


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert licenses.scan_both(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_lines_with_clashing_names(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    assert licenses.scan_both(docs.withColumn("digest", F.lit("x"))).count() == docs.count()


def test_rank_spreads_equal_rows(spark):
    df = spark.createDataFrame([(g, None if k % 3 else k, k) for g in "ab" for k in range(500)], "g string, k long, v long")
    got = grouped_rank(df, "g", ["k"], "place", rows_per_bucket=20)
    assert got.columns == ["g", "k", "v", "place"]
    for g in "ab":
        assert sorted(r.place for r in got.where(F.col("g") == g).collect()) == list(range(500))
