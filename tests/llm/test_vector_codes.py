"""Codes, errors and codebooks against plain rounds in numpy and against the SQL."""
import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from dropcast.llm import vector_codes  # noqa: E402
from dropcast.llm.sql import SQL  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, id int, error string, code double, ids int, of int"


def plain(rows, parts=4, entries=256, rounds=4):
    rows = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    if not rows:
        return []
    width = -(-max(len(r[1]) for r in rows) // parts)
    x = np.zeros((len(rows), width * parts), np.int64)
    for i, r in enumerate(rows):
        x[i, :len(r[1])] = np.floor(1024 * np.array(r[1], float))
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, [float(c) for c in rows[i][1]]))[:entries]
    x = x.reshape(len(rows), parts, width)
    books = x[first].transpose(1, 0, 2).copy()

    def nearest(p):
        far = np.stack([((x[:, p] - e) ** 2).sum(1) for e in books[p]], 1)
        return far.argmin(1), far.min(1)

    for _ in range(rounds):
        for p in range(parts):
            of = nearest(p)[0]
            for e in set(of.tolist()):
                books[p, e] = x[of == e, p].sum(0) // (of == e).sum()
    last = [nearest(p) for p in range(parts)]
    error, label = sum(far for _, far in last), {}
    for r, e in zip(rows, error.tolist()):
        label[r[2]] = label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return [(r[0], "".join(f"{last[p][0][i]:02x}" for p in range(parts)), int(error[i]), label[r[2]], digest) for i, r in enumerate(rows)]


def _rows(n):
    dice = random.Random(n)
    kinds = [lambda: [dice.gauss(0, 1) for _ in range(8)], lambda: [3 + dice.gauss(0, .01) for _ in range(8)], lambda: [1.0, 2.0, 3.0],
             lambda: [float(dice.randrange(3))] * 8, lambda: None, lambda: [float("nan")] * 8, lambda: [None, 1.0], lambda: []]
    return [(dice.choice([None, i, i // 2]), dice.choice(kinds)(), dice.choice([None, 1, 2]), 1, "clash", 2.0, 3, 4) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_equals_plain_rounds(spark, n):
    rows = _rows(n)
    got = vector_codes.label_codes(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))


def test_balls_cover_their_points_and_shrink_lists():
    dice = np.random.default_rng(1)
    points = np.floor(1024 * (dice.integers(0, 8, (1500, 1)) * 20 + dice.normal(size=(1500, 4)))).astype(np.int64)
    tree = vector_codes._flat(vector_codes._grow(points, np.arange(1500)))
    assert sorted(tree["order"].tolist()) == list(range(1500)) and tree["hi"][0] - tree["lo"][0] == 1500
    for lo, hi, radius, total in zip(tree["lo"], tree["hi"], tree["radius"], tree["total"]):
        own = points[tree["order"][lo:hi]]
        assert (own.sum(0) == total).all() and np.sqrt(((own - total / len(own)) ** 2).sum(1)).max() <= radius * (1 + 1e-9)
    whole, alone = [], []
    book = np.floor(1024 * 20 * np.arange(8)[:, None] * np.ones((1, 4))).astype(np.int64)
    vector_codes._owners(tree, points, book, lambda ball, entry: whole.append(tree["hi"][ball] - tree["lo"][ball]), lambda rows, of: alone.append(len(rows)))
    assert sum(whole) + sum(alone) == 1500 and sum(whole) > 1000 and len(whole) < 100  # clusters are owned as wholes


def test_huge_components_are_refused(spark):
    with pytest.raises(Exception, match="2\\*\\*18"):
        vector_codes.label_codes(spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int"))


def test_sql_gives_the_same(tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import pyarrow as pa

    rows = _rows(600)
    embeddings = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                           "label": pa.array([r[2] for r in rows], pa.int32())})
    with duckdb.connect() as con:
        con.register("embeddings", embeddings)
        assert sorted(map(str, con.execute(SQL["op12_vector_codes"]).fetchall())) == sorted(map(str, plain(rows)))
