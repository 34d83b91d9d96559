"""Corpus operators on a small fixture with nulls, empty and long texts, ties, repeats and clashing column names."""
import base64
import hashlib
import re

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from dropcast.llm import ann, byte_bpe, embedding_dedup, licenses, minhash_dedup, mixing, sharding, suffix_dedup, token_counts, toxicity  # noqa: E402

PASSAGE = " ".join(f"word{k} of a passage" for k in range(40))
BASE = " ".join(f"token{k * 7 % 101}" for k in range(120))
TEXTS = [
    (1, BASE, "a"), (2, BASE, "a"), (3, BASE.replace("token14", "other"), "b"), (4, None, None), (5, "", "a"), (6, "one short", "b"),
    (7, "Alpha start. " + PASSAGE, "a"), (8, "Another é beginning ☃ " + PASSAGE + " and end", "c"), (9, "x " * 30_000, "c"),
    (10, "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + licenses._MIT.upper().replace("SUBLICENSE", "sub-license"), "a"),
    (6, "one short", "b"), (None, "no id here", "a"), (11, "...!?", "d"), (12, "it's 1234 <|endoftext|> <s> ▁x  y\n\n z", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "lang", 1, "clash", 2.0) for r in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, id int, rep string, part double").repartition(3)


def test_token_counts_equal_the_library(docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path).collect())
    want = sorted((i or 0, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t, _ in TEXTS)
    assert got == want
    for t in ("a b  c   d", "  lead", "trail ", "▁ x ▁▁ y", "é è ê"):
        for most in (1, 2, 3):
            assert sum(map(len, sp.encode(token_counts.safe_parts(t, most)))) == len(sp.encode(t))


def test_byte_bpe_equals_the_library(docs):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    got = sorted((r.doc_id or 0, list(r.ids)) for r in ids.collect())
    assert got == sorted((i or 0, enc.encode_ordinary(t or "")) for i, t, _ in TEXTS)
    back = sorted((r.doc_id or 0, bytes(r.data)) for r in byte_bpe.decode(ids, path, public_tokenizers.PATTERN).collect())
    assert back == sorted((i or 0, (t or "").encode()) for i, t, _ in TEXTS)


def test_licence_of_a_whole_text(docs):
    got = {r.doc_id: r.license_id for r in licenses.scan(docs).collect()}
    assert got.pop(10) == "MIT" and not any(got.values())
    lines = docs.sparkSession.createDataFrame([(1, "text\nReleased under the MIT Licence.\nmore"), (2, None)], "doc_id long, text string")
    assert [(r.doc_id, r.line_no, r.license_id) for r in licenses.scan_lines(lines).collect()] == [(1, 1, "MIT")]


def test_mixture_stays_within_a_block(spark):
    rows = [(k, "abcd"[0 if k % 3 == 0 else k % 4]) for k in range(600)] + [(k, None) for k in range(600, 640)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), frame_slots=40, block_rows=4).toPandas()
    assert len(got) == 640 and got.position.is_unique
    blocks = got.drop_duplicates("slot").sort_values("slot")
    assert list(blocks.slot) == list(range(len(blocks)))
    assert ((blocks.slot >= blocks.release) & (blocks.slot < blocks.deadline)).all()
    source = blocks.source.fillna("-")
    quota, n = blocks.quota.groupby(source).max(), source.value_counts()
    v = np.linspace(0, (n / quota).max(), 50_001)
    ideal = {s: np.minimum(quota[s] * v, n[s]) for s in n.index}
    total = sum(ideal.values())
    for s in n.index:
        run = (source == s).cumsum().to_numpy()
        assert np.abs(run - np.interp(np.arange(1, len(run) + 1), total, ideal[s])).max() < 1.001


def test_shards(docs):
    got = sharding.shard(docs, 3).toPandas()
    assert len(got) == len(TEXTS)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert got[got.doc_id.isin([1, 2])].shard.nunique() == 1 and (got[got.doc_id == 4]["size"] == 8).all()
    assert sharding.longest_first([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_suffix_dedup_equals_brute_force(docs):
    texts = [(t or "").encode() for _, t, _ in TEXTS]
    seen = {}
    for b in texts:
        for k in range(len(b) - 199):
            seen[b[k:k + 200]] = seen.get(b[k:k + 200], 0) + 1
    want = []
    for (i, _, _), b in zip(TEXTS, texts):
        covered = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                covered[k:k + 200] = True
        want.append((i or 0, hashlib.sha256(np.frombuffer(b, np.uint8)[~covered].tobytes()).hexdigest()))
    for seed in (suffix_dedup.SEED, 20):
        got = suffix_dedup.remove_repeats(docs, seed=seed)
        assert sorted((r.doc_id or 0, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got.collect()) == sorted(want)


def test_near_duplicates(docs):
    got = {r.doc_id: (r.class_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    words = [re.findall(r"\w+", t or "") for t in (BASE, TEXTS[2][1])]
    a, b = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in words)
    assert len(a & b) / len(a | b) >= 0.8
    assert [got[k] for k in (1, 2, 3)] == [(1, True), (1, False), (1, False)]
    assert all(got[k] == (k, True) for k in (4, 5, 6, 7, 9, 10, 11, 12)) and got[None] == (None, True)
    assert got[8] == (7, False)  # nearly all of both texts is the same passage
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_probability_jaccard_estimate():
    rng = np.random.default_rng(1)
    h = rng.integers(1, 2**63, 300).astype(np.uint64)
    h.sort()
    a, b = (h[:240], rng.integers(1, 4, 240)), (h[40:], rng.integers(1, 4, 260))
    brute = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in {*x, *y})
                for x, y in [(dict(zip(*a)), dict(zip(*b)))] for d in {*x} & {*y})
    assert abs(minhash_dedup.probability_jaccard(a, b) - brute) < 1e-9
    owner = np.repeat([0, 1], [240, 260])
    sig = minhash_dedup.signatures(owner, np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2, 4000)
    assert abs((sig[0] == sig[1]).mean() - brute) < 0.04


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 16))
    x[200:260] = x[:60] + 0.02 * rng.normal(size=(60, 16))
    x[260:300] = x[5]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 2.0])]
    return spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, rep string"), x


def test_embedding_near_duplicates(vectors):
    df, x = vectors
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, list_block=16).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    assert len(got) == 306 and all(got[k].n_links == 0 and got[k].kept for k in range(900, 906))
    assert [got[k].n_links for k in range(300)] == list(near.sum(axis=1) - 1)
    a, b = np.nonzero(near)
    assert [got[k].component_id for k in range(300)] == list(embedding_dedup.roots(300, a, b))


def test_search_recall_and_ties(vectors):
    df, x = vectors
    got = ann.search(df, F.col("vec_id") % 20 == 0, n_pivots=64, prefix=32, probe=0.5).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        if q >= 300:
            continue
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.lexsort((np.arange(300), far))[:10]
        hit += len({*best} & {*g.vec_id})
        assert list(g.sort_values("rank").score) == sorted(g.score)
    assert hit >= 0.9 * 150


def test_toxic_spans(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    docs, labels = [], []
    for k in range(400):
        words = list(rng.choice(vocabulary, 40))
        bad = k % 4 == 0
        if bad:
            words[int(rng.integers(40))] = ["zzvile", "zzrotten", "zzfoul"][k % 3]
        docs.append((k, " ".join(words) + "."))
        labels.append((k, 1, int(bad)))
    docs += [(1000, None), (1001, "")]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in toxicity.toxic_documents(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 400]
    assert held and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    span = got[0].spans[0]
    assert docs[0][1].encode()[span.start:span.end].decode().startswith("zz")
    assert got[1000].score == 0 and got[1001].predicted == 0
