"""Corpus operators on empty tables, and their DuckDB SQL on fixtures with nulls, ties, repeats and links."""
import hashlib

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from dropcast.llm import ann, byte_bpe, embedding_dedup, licenses, minhash_dedup, mixing, sharding, sql, suffix_dedup, token_counts, toxicity  # noqa: E402

DOCS = "doc_id long, text string, source string, id int, rep string, h string, _id int"


def test_empty_tables(spark):
    docs, vectors = spark.createDataFrame([], DOCS), spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bpe, piece = (public_tokenizers.path(p) for p in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    results = [
        ann.search(vectors, F.col("vec_id") % 100 == 0), suffix_dedup.remove_repeats(docs),
        byte_bpe.round_trip(docs, bpe, public_tokenizers.PATTERN), licenses.scan(docs), mixing.mix(docs),
        toxicity.toxic_documents(docs, labels), token_counts.count_tokens(docs, piece), sharding.shard(docs),
        embedding_dedup.near_duplicates(vectors), minhash_dedup.near_duplicates(docs),
    ]
    assert [r.count() for r in results] == [0] * 10


def test_texts_without_labels_score_low(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (2, None)], "doc_id long, text string")
    got = toxicity.toxic_documents(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 3 and all(0 <= r.score < toxicity.THRESHOLD and r.predicted == 0 for r in got)


def test_document_sql_equals_the_operators(spark):
    passage = "é☃ " * 20 + " ".join(f"word{k}" for k in range(60))
    texts = [(1, passage + " end"), (2, "start " + passage), (3, None), (4, ""), (5, passage + passage), (6, "y" * 450),
             (7, "Released under the MIT Licence."), (8, "# Copyright 2020 A\n" + licenses._BSD_HEAD + licenses._BSD_END), (9, "z" * 199),
             (10, " ".join(f"alone{k}" for k in range(400)))]
    docs = spark.createDataFrame([(*t, "s", 1, "r", "h", 2) for t in texts], DOCS)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    got = sorted((r.doc_id, r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
                 for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == sorted(con.execute(sql.suffix_dedup(block=64)).fetchall()) and sum(g[2] > 0 for g in got) == 4
    got = sorted(tuple(r) for r in licenses.scan(docs).collect())
    assert got == sorted(con.execute(sql.license_scan()).fetchall())
    assert {r[0]: r[2] for r in got if r[2]} == {7: "MIT", 8: "BSD-2-Clause"}


def test_embedding_sql_equals_the_operator(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 16))
    x[60:90] = x[:30] + 0.02 * rng.normal(size=(30, 16))
    x[90:] = x[3]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)] + [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] * 16), (204, [])]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), list_block=16)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect())
    assert got == sorted(con.execute(sql.embedding_near_dedup()).fetchall()) and sum(not g[3] for g in got) == 60
