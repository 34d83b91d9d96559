"""The pipeline's rows against a plain recomputation of its stages on a small fixture."""
import base64

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402


def shingles(text):
    words = text.replace(".", "").split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def without_repeats(texts, length=200):
    seen = {}
    for t in texts.values():
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]] = seen.get(t[k:k + length], 0) + 1
    out = {}
    for i, t in texts.items():
        keep = np.ones(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                keep[k:k + length] = False
        out[i] = "".join(c for c, x in zip(t, keep) if x)
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    texts, toxic = {}, set()
    for k in range(240):
        words = list(rng.choice(vocabulary, 40))
        if k % 4 == 0:
            words[int(rng.integers(40))] = ["zzvile", "zzrotten", "zzfoul"][k % 3]
            toxic.add(k)
        texts[k] = " ".join(words) + "."
    passage = " ".join(rng.choice(vocabulary, 45))
    for k in (1, 2, 3):
        texts[k] = f"{texts[k]} {passage} {texts[k + 4][:30]}"
    texts |= {500: texts[5], 501: texts[5], 502: texts[6].replace(texts[6].split()[-1], "other."), 600: ""}
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t in texts.items()] + [(601, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    clean = {i: t for i, t in texts.items() if i not in toxic}
    kept = {}
    for i, t in sorted(clean.items()):
        near = (len(shingles(t) & shingles(o)) / len(shingles(t) | shingles(o)) >= 0.8 for o in kept.values() if t and o)
        if not any(near):
            kept[i] = t
    assert len(clean) - len(kept) == 3
    cut = without_repeats(kept)
    assert sum(len(cut[i]) < len(kept[i]) for i in kept) == 3
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: enc.encode_ordinary(t) for i, t in cut.items()} | {601: []}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r.doc_id: list(r.ids) for r in got} == want
    assert all(r.exact and r.n_tokens == len(r.ids) for r in got)
