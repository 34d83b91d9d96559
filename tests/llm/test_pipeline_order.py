"""The order that the mixture decides reaches the pipeline's last stage, over several files."""
import os

import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402
from dropcast.llm import mixing  # noqa: E402
from dropcast.llm.common import cut  # noqa: E402


def test_positions_follow_the_mixture(spark):
    rows = [(k, f"text {k} " * (1 + (k * k) % 97), "abbcccc"[k % 7] if k % 50 else None, "en", k) for k in range(700)] + [(700, None, "a", None, None), (701, "", "b", "en", 0)]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long"), "order-docs")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # else this little is written as one file
        mixed = cut(corpus_pipeline.mix_sources(spark, docs, ""), "order-mixed")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        files = {os.path.basename(f) for f in mixed.inputFiles()}
        got = cut(corpus_pipeline.encode_texts(spark, mixed, ""), "order-coded").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(files) > 3 and sorted(r.position for r in got) == list(range(702))
    want = [r.doc_id for r in mixing.mix(docs.select("doc_id", "source")).orderBy("position").collect()]
    assert [r.doc_id for r in sorted(got, key=lambda r: r.position)] == want
    assert [r.doc_id for r in got] != want  # the rows' own order is another one
