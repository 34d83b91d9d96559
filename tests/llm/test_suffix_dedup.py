"""Repeated strings against brute force: many surroundings of one passage, long texts, texts that small hashes confuse."""
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from dropcast.llm import suffix_dedup  # noqa: E402


def plain(texts, length=200):
    """Kept bytes of every text."""
    seen = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            w = hash(t[k:k + length])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        change = np.zeros(len(t) + 1, np.int64)
        for k in range(len(t) - length + 1):
            if seen[hash(t[k:k + length])] > 1:
                change[k] += 1
                change[k + length] -= 1
        out.append(bytes(np.frombuffer(t, np.uint8)[np.cumsum(change)[:-1] == 0]))
    return out


def _noise(dice, n):
    return "".join(dice.choices("abcdefghijklmnopqrstuvwxyz ", k=n))


def _check(spark, texts, parts=4):
    docs = spark.createDataFrame([(None if k % 3 == 0 else k % 50, t, "clash", 1, 2, 3) for k, t in enumerate(texts)],
                                 "doc_id long, text string, h1 string, kept int, runs int, id int").repartition(parts)
    got = suffix_dedup.remove_repeats(docs).collect()
    want = plain([t.encode() for t in texts])
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in got) == sorted((str(None if k % 3 == 0 else k % 50), w) for k, w in enumerate(want))


def test_one_passage_in_many_surroundings_and_variants(spark):
    dice = random.Random(3)
    passage, other = _noise(dice, 420), _noise(dice, 150)
    texts = [_noise(dice, dice.randrange(250)) + passage + _noise(dice, dice.randrange(250)) for _ in range(150)]
    for k in range(150):  # copies of a part with one byte changed: equal seeds, cores that differ here and there
        at = dice.randrange(len(passage) - 10)
        texts.append(_noise(dice, 60) + other + passage[:at] + "#" + passage[at + 1:] + _noise(dice, 20))
    _check(spark, [*texts, "", texts[0], texts[0], "x" * 700, passage[:200], passage[1:200]])


def test_rows_grow_with_the_copies(spark, monkeypatch):
    made = {}
    kept = suffix_dedup.cut
    for n in (40, 80, 160, 320):
        dice = random.Random(n)
        passage = _noise(dice, 420)
        docs = spark.createDataFrame([(k, _noise(dice, 300) + passage + _noise(dice, 300)) for k in range(n)], "doc_id long, text string")

        def counted(df, name, n=n):
            out = kept(df, name)
            if name == "suffix-positions":
                made[n] = out.count()
            return out

        monkeypatch.setattr(suffix_dedup, "cut", counted)
        assert suffix_dedup.remove_repeats(docs).where(F.size("spans") != 1).isEmpty()
    assert all(0 < made[n] <= 40 * n for n in made) and made[320] <= 12 * made[40]


def test_long_text_is_read_in_pieces(spark):
    dice = random.Random(9)
    part, far = _noise(dice, 300), _noise(dice, 500)
    long = _noise(dice, 899_900) + part + _noise(dice, 200_000) + far + _noise(dice, 100_000)
    _check(spark, [long, far + "!", "?" + part])


def test_different_texts_with_equal_small_hashes_and_null_ids(spark):
    some = spark.range(200_000).select(F.concat_ws("", *(F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 256) for k in range(4))).alias("text"))
    pair = some.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).first().t[:2]
    rows = [(None, pair[0]), (None, pair[1]), (7, pair[0])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), len(r.kept)) for r in got) == [("7", 0), ("None", 0), ("None", 256)]
