"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Documents carry the labels; the tokens' labels are derived: in a toxic document, the words that toxic documents use
far more often than chance (a likelihood-ratio test over document frequencies) are toxic tokens. The field has two
states, weights for the word and its two neighbours (hashed) and for the transitions, and is trained on the marginals
of the forward-backward algorithm. A document's score is the largest marginal of its tokens; spans are runs of tokens
whose marginal is at least one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, mix64, text_slices
from .minhash_dedup import shingles

TOXIC_ROWS, CLEAN_ROWS, TRAIN_CHARS = 1000, 1500, 50_000
BUCKETS = 1 << 20
VALUES = (1.0, 0.7, 0.05, 0.05)  # of the features: word, its beginning, word before, word after
LONGEST = 64
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
COPIED = 0.3  # a training text with a larger share of shingles from earlier ones is a copy
PURE = 0.5  # least share of toxic texts among the training texts with a marking word
EVIDENCE = 14.0  # log-likelihood ratio: chance below one in a million
LEAST_EVIDENCE = 6.0  # of the strongest words of a toxic text that has no word with EVIDENCE
THRESHOLD = 0.3
_ENDS = np.zeros(256, np.int64)
_ENDS[list(b".!?\n")] = 1


def sequences(words: Words) -> np.ndarray:
    """Start of every sequence of tokens: sentences (up to . ! ? or a line's end), longer ones in stretches of ``LONGEST``."""
    n = len(words.hashes)
    ends = np.concatenate([[0], np.cumsum(_ENDS[np.frombuffer(words.data, np.uint8)])])[words.start] if n else np.zeros(0)
    new = np.ones(n, bool)
    new[1:] = ends[1:] != ends[:-1]
    first = words.first[:-1]
    new[first[first < n]] = True
    at = np.flatnonzero(new)
    depth = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    return np.flatnonzero(depth % LONGEST == 0)


def features(words: Words, starts: np.ndarray) -> np.ndarray:
    """Array (4, tokens): 64-bit keys of the word, its beginning, the word before and the one after in the sequence."""
    h = words.hashes
    before, after = np.zeros_like(h), np.zeros_like(h)
    before[1:], after[:-1] = h[:-1], h[1:]
    before[starts] = 0
    ends = np.append(starts[1:], len(h)) - 1
    after[ends[ends >= 0]] = 0
    return np.stack([mix64(x + np.uint64(k)) for k, x in enumerate((h, words.prefixes(), before, after))])


def split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and fingerprint (never 0) of keys."""
    return (keys % np.uint64(BUCKETS)).astype(np.int64), (keys >> np.uint64(48)).astype(np.uint16) | np.uint16(1)


@dataclass
class Chain:
    """Weights of the field: per feature bucket (the last one, always 0, is for features that do not own their bucket),
    the owners' fingerprints, bias, and log potentials of the transitions [from, to]."""
    weights: np.ndarray
    owners: np.ndarray
    bias: float
    moves: np.ndarray

    def owned(self, keys: np.ndarray) -> np.ndarray:
        bucket, mark = split(keys)
        return np.where(self.owners[bucket] == mark, bucket, BUCKETS).astype(np.int32)

    def emissions(self, feats: np.ndarray) -> np.ndarray:
        return sum(v * self.weights[f] for v, f in zip(VALUES, feats)) + self.bias

    def marginals(self, e: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: P(toxic) of every token, and expected counts of the transitions (2 x 2)."""
        m, p, counts = self.moves, np.zeros(len(e)), np.zeros((2, 2))
        lengths = np.diff(np.append(starts, len(e)))
        order = np.argsort(lengths, kind="stable")
        cuts = np.searchsorted(lengths[order], [1, 3, 5, 9, 17, 33, LONGEST + 1])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            some = order[lo:hi]
            if not len(some):
                continue
            n, top = lengths[some], int(lengths[some].max())
            at = np.minimum(starts[some][None, :] + np.arange(top)[:, None], len(e) - 1)
            live = np.arange(top)[:, None] < n[None, :]
            x = np.where(live, e[at], 0.0)
            a, b = np.zeros_like(x), np.zeros_like(x)  # log odds of state 1 over 0
            a[0] = x[0]
            for t in range(1, top):
                a[t] = x[t] + np.logaddexp(m[0, 1], m[1, 1] + a[t - 1]) - np.logaddexp(m[0, 0], m[1, 0] + a[t - 1])
            for t in range(top - 2, -1, -1):
                s = x[t + 1] + b[t + 1]
                b[t] = np.where(live[t + 1], np.logaddexp(m[1, 0], m[1, 1] + s) - np.logaddexp(m[0, 0], m[0, 1] + s), 0.0)
            own = 1 / (1 + np.exp(-np.clip(a + b, -60, 60)))
            p[at[live]] = own[live]
            if top > 1:
                s = x[1:] + b[1:]
                joint = np.stack([m[0, 0] + 0 * s, m[0, 1] + s, m[1, 0] + a[:-1], m[1, 1] + a[:-1] + s])
                joint = np.exp(joint - joint.max(axis=0))
                counts += ((joint / joint.sum(axis=0)) * live[1:]).sum(axis=(1, 2)).reshape(2, 2)
        return p, counts


def copies(words: Words) -> np.ndarray:
    """Texts that repeat earlier ones (their words would count as evidence again and again)."""
    owner, h = shingles(words)
    _, which = np.unique(h, return_inverse=True)
    first = np.full(len(which), len(words.first), np.int64)
    np.minimum.at(first, which, owner)
    n = len(words.first) - 1
    return np.bincount(owner, first[which] < owner, n) > COPIED * np.maximum(np.bincount(owner, minlength=n), 1)


def marks(units: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """For each token, the log-likelihood ratio by which its unit (hash; 0: none) marks toxic texts, by document frequencies."""
    n = len(toxic)
    vocabulary, unit = np.unique(units, return_inverse=True)
    pairs = np.unique(unit.astype(np.int64) * n + owner)
    used, text = pairs // n, pairs % n
    both = np.bincount(used, minlength=len(vocabulary)).astype(float)
    base = np.clip(toxic.mean(), 1e-6, 1 - 1e-6)
    share = np.clip(np.bincount(used, toxic[text].astype(float), len(vocabulary)) / both, 1e-12, 1 - 1e-12)
    evidence = both * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    return np.where((share > max(base, PURE)) & (vocabulary != 0), evidence, 0.0)[unit]


def token_labels(words: Words, toxic: np.ndarray) -> np.ndarray:
    """True for the tokens of toxic texts whose word or beginning of a word marks toxic texts."""
    n = len(toxic)
    owner = np.repeat(np.arange(n), np.diff(words.first))
    evidence = np.maximum(marks(words.hashes, owner, toxic), marks(words.prefixes(), owner, toxic))
    strong = (evidence >= EVIDENCE) & toxic[owner]
    # a toxic text has a toxic token: where none is sure, its strongest words
    most = np.zeros(n)
    np.maximum.at(most, owner, evidence)
    explained = np.bincount(owner, strong, n) > 0
    return strong | (toxic & ~explained)[owner] & (evidence >= LEAST_EVIDENCE) & (evidence >= most[owner])


def train(texts: list[str], toxic: list[bool], epochs: int = EPOCHS) -> Chain:
    """Texts that repeat earlier ones are left out. Full-batch adaptive gradient ascent on the penalised likelihood of the derived token labels."""
    kept = np.flatnonzero(~copies(Words(texts)))
    toxic = np.array(toxic, bool)[kept]
    words = Words([texts[k] for k in kept])
    chain = Chain(np.zeros(BUCKETS + 1), np.zeros(BUCKETS, np.uint16), -4.0, np.zeros((2, 2)))
    if not len(words.hashes):
        return chain
    starts = sequences(words)
    keys, y = features(words, starts), token_labels(words, toxic).astype(float)
    for some in (keys, keys[:, y == 1]):  # of features in one bucket, one of a toxic token owns it
        bucket, mark = split(some)
        for b, m in zip(bucket, mark):
            chain.owners[b] = m
    feats = np.stack([chain.owned(k) for k in keys])
    del keys, some
    follows = np.ones(len(y), bool)
    follows[starts] = False
    seen = np.array([[((y[:-1] == i) & (y[1:] == j) & follows[1:]).sum() for j in (0, 1)] for i in (0, 1)], float)
    squares, bias_square, move_square = np.full(BUCKETS + 1, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(epochs):
        p, counts = chain.marginals(chain.emissions(feats), starts)
        rest = y - p
        g = sum(v * np.bincount(f, rest, BUCKETS + 1) for v, f in zip(VALUES, feats)) - DECAY * chain.weights
        g[-1] = 0
        squares += g * g
        chain.weights += RATE * g / np.sqrt(squares)
        bias_square += rest.sum() ** 2
        chain.bias += RATE * rest.sum() / bias_square**0.5
        move = seen - counts - DECAY * chain.moves
        move_square += move * move
        chain.moves += RATE * move / np.sqrt(move_square)
    return chain


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
        toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, train_chars: int = TRAIN_CHARS) -> Chain:
    """Train on a bounded sample of the labelled rows where ``usable`` (a condition on the id) holds: at most
    ``toxic_rows`` and ``clean_rows`` ids in hash order, of these the texts of at most ``train_chars`` characters.
    Ids with both labels or without one are left out."""
    sides = (labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & usable).groupBy(F.col(id_col).alias("_id"))
             .agg(F.min("toxic").alias("lo"), F.max("toxic").alias("hi")).where("lo = hi"))
    order = [F.xxhash64("_id"), F.col("_id")]
    ids = (sides.where("hi = 1").orderBy(*order).limit(toxic_rows)
           .union(sides.where("hi = 0").orderBy(*order).limit(clean_rows)).select("_id", "hi"))
    sample = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where(F.length("_text") <= train_chars)
    sample = sample.join(F.broadcast(ids), F.col("_doc") == F.col("_id"))  # at most toxic_rows + clean_rows ids
    rows = sorted(sample.groupBy("_id").agg(F.min("_text").alias("text"), F.first("hi").alias("hi")).collect(), key=lambda r: r["_id"])
    return train([r["text"] for r in rows], [r["hi"] == 1 for r in rows])


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, score, spans array<struct<start, end, p>>) of every row: the largest marginal of its tokens, and the
    offending spans as byte offsets in the UTF-8 text with their largest marginal. Texts without words (null, empty)
    score 0. Repeated rows come back as often; other columns are ignored. No shuffle; whole texts of any length."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)))
    head = ["id", *(f"c{k}" for k in range(len(carry)))]
    schema = ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in head), "score double, spans array<struct<start: long, end: long, p: double>>"])
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # a fixed number of weights
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), 2 << 20):
                words, n = Words(batch.column(1).slice(lo, hi - lo).to_pylist()), hi - lo
                best, spans = np.zeros(n), [[] for _ in range(n)]
                if len(words.hashes):
                    starts = sequences(words)
                    p, _ = model.marginals(model.emissions(model.owned(features(words, starts))), starts)
                    some = np.flatnonzero(np.diff(words.first))
                    best[some] = np.maximum.reduceat(p, words.first[:-1][some])
                    hot = np.flatnonzero(p >= 0.5)
                    text = np.searchsorted(words.first, hot, side="right") - 1
                    new = np.ones(len(hot), bool)
                    new[1:] = (np.diff(hot) > 1) | (np.diff(text) > 0)
                    at = np.flatnonzero(new)
                    for i, j in zip(at, np.append(at[1:], len(hot))):
                        k, run_ = text[i], hot[i:j]
                        begin = words.begin[k]
                        spans[k].append({"start": int(words.start[run_[0]] - begin), "end": int(words.end[run_[-1]] - begin), "p": float(p[run_].max())})
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, n) for c in head), pa.array(best), pa.array(spans, span)], names=[*head, "score", "spans"])

    out = rows.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)), "score", "spans")


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted, spans) of every row; predicted is 1 from ``threshold`` on."""
    chain = fit(docs, labels, ~held_out(F.col(id_col)), id_col, text_col)
    return score(docs, chain, id_col, text_col).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
