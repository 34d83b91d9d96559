"""Merkle manifest against trees built plainly in Python."""
import hashlib
import zlib

import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from dropcast.llm import merkle  # noqa: E402
from dropcast.llm.sql import SQL  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, ancestor int, segment int, row int, tree string, pos long"


def _digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_digest(out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def _way(levels, i):
    for nodes in levels[:-1]:
        run = nodes[i // 3 * 3:i // 3 * 3 + 3]
        yield run[:i % 3], run[i % 3 + 1:]
        i //= 3


def plain(rows):
    leaf = lambda r, text: _leaf(r[0], r[3], r[2], r[4], text)
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in sources}
    trees = {s: _levels([leaf(r, r[1]) for r in own[s]]) for s in sources}
    top = _levels([trees[s][-1][0] for s in sources])
    for j, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            way = [*_way(trees[s], i), *_way(top, j)]
            lost = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            folded = leaf(r, r[1].replace("\n", "") if lost else r[1])
            for before, after in way:
                folded = _digest([*before, folded, *after])
            yield (r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], _digest(x for b, a in way for x in b + a), folded, folded == top[-1][0])


def _rows(n, sources):
    texts = [None, "", "a\nb", "plain", "x\n\n☃", "long " * 20_000]
    return [(None if i % 7 == 3 else i % 11, texts[i % 6], "l", None if i % sources == 0 else f"s{i % sources}", None if i % 5 == 0 else i % 3,
             "clash", 1, 2, 3, "t", 4) for i in range(n)]


@pytest.mark.parametrize(("n", "sources"), [(0, 1), (1, 1), (9, 1), (28, 2), (40, 40)])
def test_equals_plain_trees(spark, n, sources):
    rows = _rows(n, sources)
    got = [tuple(r) for r in merkle.verify_copy(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))


def test_proofs_fold_to_the_root_also_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    rows = [(i, f"text {i}\n", "l", f"s{i % 2 * (i % 5)}", i, "", 0, 0, 0, "", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs)
    assert found.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    assert sorted(map(str, (tuple(r) for r in merkle.verify_copy(docs).collect()))) == sorted(map(str, plain(rows)))


def test_sql_gives_the_same(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import pandas as pd

    rows = _rows(60, 4)
    want = sorted(map(str, (tuple(r) for r in merkle.verify_copy(spark.createDataFrame(rows, SCHEMA)).collect())))
    with duckdb.connect() as con:
        frame = pd.DataFrame([r[:5] for r in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])
        frame = frame.astype({"doc_id": "Int64", "n_chars": "Int64"})
        con.register("documents", frame)
        assert sorted(map(str, con.execute(SQL["op11_merkle_manifest"]).fetchall())) == want
