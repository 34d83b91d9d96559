"""Kneser-Ney scores against a plain model with dictionaries, and against the SQL."""
import math
import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

from dropcast.llm import lm  # noqa: E402
from dropcast.llm.sql import SQL  # noqa: E402

SCHEMA = "doc_id long, text string, score string, id int, n_tokens int, held_out int, bucket int"


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]  # None is the end


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


class Plain:
    def __init__(self, texts):
        self.pairs, self.count = Counter(), Counter()
        for t in texts:
            words = _words(t)
            self.pairs.update(zip(["<begin>", *((w,) for w in words[:-1])], words))
            self.count.update(words)
        self.after, self.before = {}, Counter()
        for (v, w), c in self.pairs.items():
            self.after.setdefault(v, []).append(c)
            self.before[w] += 1
        self.d = lm.discounts([sum(c == k for c in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.e = lm.discounts([sum(c == k for c in self.before.values()) for k in (1, 2, 3, 4)])

    def lower(self, w):
        pairs = len(self.pairs)
        less = lambda c, d: c - d[min(c, 3) - 1] if c else 0
        left = sum(self.e[min(c, 3) - 1] for c in self.before.values()) / pairs if pairs else 1
        return (less(self.before[w], self.e) / pairs if pairs else 0) + left / (len(self.count) + 1)

    def p(self, v, w):
        if v not in self.after:
            return self.lower(w)
        total, c = sum(self.after[v]), self.pairs[v, w]
        left = sum(self.d[min(x, 3) - 1] for x in self.after[v]) / total
        return (c - self.d[min(c, 3) - 1] if c else 0) / total + left * self.lower(w)

    def score(self, text):
        words, n, kinds = _words(text), sum(self.count.values()), len(self.count)
        base = sum(math.log10((self.count[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in words)
        own = sum(math.log10(self.p(v, w)) for v, w in zip(["<begin>", *((w,) for w in words[:-1])], words))
        return len(words), sum(self.count[w] > 0 for w in words), n, base, own


def _rows(n):
    dice = random.Random(n)
    some = [*"abcdefghij", "The", "the", "É", "é", "don't", " x", "☃"]
    text = lambda: dice.choice([" ", "\n", "\t ", "\x0b"]).join(dice.choices(some, [2 ** -k for k in range(len(some))], k=dice.randrange(60)))
    rows = [(dice.choice([None, i, i // 3]), dice.choice([None, "", " \r\n", text(), text(), text(), text() + f" rare{i}"])) for i in range(n)]
    return [(*r, "clash", 1, 2, 3, 4) for r in rows]


def _check(got, rows):
    model = Plain([r[1] for r in rows if not _held(r[0])])
    want = [(r[0], _held(r[0]), *model.score(r[1])) for r in rows]
    assert sorted(str(r[:5]) for r in got) == sorted(str(r[:5]) for r in want)
    order = lambda r: (str(r[:5]), round(r[5], 5), r[6])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert a[5] == pytest.approx(b[5], abs=1e-5) and a[6] == pytest.approx(b[6], abs=1e-5)


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_equals_a_plain_model(spark, n):
    rows = _rows(n)
    _check([tuple(r) for r in lm.score_documents(spark, spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()], rows)


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 50)
    rows = _rows(60)
    whole = [[], []]
    for words, of in lm.tokens(r[1] for r in rows):
        whole[0] += words.tolist()
        whole[1] += of.tolist()
    monkeypatch.setattr(lm, "PIECE", 1 << 20)
    (words, of), = lm.tokens(r[1] for r in rows)
    assert whole == [words.tolist(), of.tolist()]
    assert [sum(1 for x in of if x == k) for k in range(len(rows))] == [len(_words(r[1])) for r in rows]


def test_probabilities_add_up_to_one(spark):
    import numpy as np

    rows = _rows(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    reader = lm._Reader(lm.fit(docs))
    words = np.unique(np.concatenate([t for t, _ in lm.tokens(r[1] for r in rows)] + [np.array([12345], np.uint64)]))  # all, and one unknown
    for context in (words[0], words[3], lm.BEGIN, np.uint64(999)):
        logs = reader.logs(np.full(len(words), context), words)[2]
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-9)


def test_sql_gives_the_same():
    duckdb = pytest.importorskip("duckdb")
    import pyarrow as pa

    for n in (0, 300):
        rows = _rows(n)
        with duckdb.connect() as con:
            con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
            _check([tuple(r) for r in con.execute(SQL["op13_kneser_ney"]).fetchall()], rows)
