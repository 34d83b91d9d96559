"""Near-duplicate documents by ProbMinHash over weighted shingles, banding, and exact verification.

A document is a bag of shingles of five words, weighted by how often they occur. Each shingle sends arrivals of a
Poisson process whose rate is its weight; every arrival falls on one register, and a register keeps the shingle that
arrives first. Two documents agree in a register with the probability Jaccard similarity of their bags. Arrivals of
a shingle stop once they come later than the document's latest register.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, connected_components, cut, mix64, packed, text_slices, unpacked

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
BLOCK = 64
#: Most cells of a table of texts by shingles in a task; beyond, pairs are compared one by one.
TABLE_CELLS = 20_000_000
#: Four bits of every register, in longs: pairs are compared in the JVM before their texts are fetched.
SKETCH = [f"s{k}" for k in range(BANDS * ROWS * 4 // 64 + 1)]


def _salt(n: int) -> np.uint64:
    return np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)


def shingles(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash) of every run of ``size`` words; a shorter text is one shingle, a wordless one none."""
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    at = np.repeat(words.first[:-1], count) + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    end = words.first[1:][owner]
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        inside = at + j < end
        h = words.hashes[np.minimum(at + j, max(len(words.hashes) - 1, 0))] if len(at) else out
        out = out + np.where(inside, mix64(h + _salt(j + 1)), np.uint64(0))
    return owner, mix64(out)


def bags(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with their counts, by text, then shingle."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures: array (n_texts, registers) of winning shingles (0 for texts without shingles)."""
    first = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, np.uint64)
    time, turn = np.zeros(len(hashes)), 0
    weights = weights.astype(float)
    while len(hashes):
        turn += 1
        r = mix64(hashes + _salt(turn))
        time = time - np.log(((r >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / weights
        at = owner * registers + (mix64(r) % np.uint64(registers)).astype(np.int64)
        early = time < first[at]
        where, when = at[early], time[early]
        np.minimum.at(first, where, when)
        won = when == first[where]
        winner[where[won]] = hashes[early][won]
        texts = np.flatnonzero(np.diff(owner, prepend=-1))  # of the texts still at work
        latest = first.reshape(n_texts, registers)[owner[texts]].max(axis=1)
        alive = time < np.repeat(latest, np.diff(np.append(texts, len(owner))))
        if not alive.all():
            owner, hashes, weights, time = owner[alive], hashes[alive], weights[alive], time[alive]
    return winner.reshape(n_texts, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two bags (sorted shingles, weights)."""
    both = np.union1d(a[0], b[0])
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])], y[np.searchsorted(both, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    y_before = np.concatenate([[0.0], np.cumsum(y)])
    x_from = x.sum() - np.concatenate([[0.0], np.cumsum(x)])
    common = np.flatnonzero((x > 0) & (y > 0))
    lo = np.searchsorted(ratio, ratio[common], side="left")
    return float((1.0 / (x_from[lo] / x[common] + y_before[lo] / y[common])).sum())


def profile(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key1, key2, bands, sketch columns): a 128-bit hash of the text's sequence of words, its band keys and four
    bits of each register; keys and bands are null or empty for wordless texts."""
    longs = ", ".join(f"{c} long" for c in SKETCH)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, key1 long, key2 long, bands array<long>, {longs}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(1), 2 << 20):
                words, n = Words(batch.column(1).slice(lo, hi - lo).to_pylist()), hi - lo
                owner, h = shingles(words)
                some = np.flatnonzero(np.diff(words.first))
                keys = np.zeros((2, n), np.uint64)
                nth = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], np.diff(words.first))
                for k in range(2):
                    if len(some):
                        keys[k, some] = np.add.reduceat(mix64(words.hashes + mix64((nth + 1).astype(np.uint64) * _salt(1) + np.uint64(k))), words.first[:-1][some])
                sig = signatures(*bags(owner, h), n, BANDS * ROWS)
                nibbles = np.zeros((n, len(SKETCH) * 16), np.uint8)
                nibbles[:, :BANDS * ROWS] = mix64(sig) & np.uint64(15)
                sketch = (nibbles[:, ::2] | nibbles[:, 1::2] << 4).view(np.int64)
                sig = sig.reshape(n, BANDS, ROWS)
                bands = np.zeros((n, BANDS), np.uint64)
                for j in range(ROWS):
                    bands = mix64(bands + sig[:, :, j] + _salt(j + 1))
                none = np.ones(n, bool)
                none[some] = False
                offsets = np.concatenate([[0], np.cumsum(np.where(none, 0, BANDS))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[~none].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), *(pa.array(k.view(np.int64), mask=none) for k in keys), lists,
                     *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(len(SKETCH)))],
                    names=["id", "key1", "key2", "bands", *SKETCH])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col)).mapInArrow(run, schema)


def most_bits(threshold: float) -> float:
    differ = BANDS * ROWS * (1 - threshold)
    return 2 * differ + 5 * (4 * differ * threshold + differ) ** 0.5


def alike(threshold: float) -> Column:
    """Whether the sketches a_* and b_* may belong to a pair at ``threshold``: a register that differs changes two of its
    four bits on average, and the bound is five standard deviations above the mean at the threshold (a pair at the
    threshold fails it with a probability below 1e-6)."""
    bits = [F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH]
    return reduce(lambda x, y: x + y, bits) <= most_bits(threshold)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts have a probability Jaccard similarity of ``threshold`` or more."""
    both = (pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                some = batch.iloc[lo:lo + 256]
                found = {}
                for column in ("text_a", "text_b"):
                    for t in some[column]:
                        found.setdefault(t, len(found))
                owner, h, w = bags(*shingles(Words(list(found))))
                at = np.searchsorted(owner, np.arange(len(found) + 1))
                bag = lambda t: (h[(r := slice(at[found[t]], at[found[t] + 1]))], w[r])
                good = [probability_jaccard(bag(x), bag(y)) >= threshold - 1e-12 for x, y in zip(some["text_a"], some["text_b"])]
                yield some.loc[good, ["a", "b"]]

    return both.select("a", "b", "text_a", "text_b").mapInPandas(check, "a long, b long")


def compared_in_blocks(members: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between different components of members (band, bucket, rep, part) that share buckets, enough of
    them to join all components that any link joins.

    Members that are connected over buckets form a group, dealt into blocks of ``BLOCK``; every pair of blocks is a
    task that compares its two blocks. Tasks return the links that join components, never pairs.
    """
    stars = members.join(cut(members.groupBy("band", "bucket").agg(F.min("rep").alias("a")), "near-stars"), ["band", "bucket"])
    groups = connected_components(stars.select("a", F.col("rep").alias("b")).where("a != b").distinct()).select(F.col("vertex").alias("rep"), F.col("root").alias("grp"))
    sizes = groups.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    small = max(1, groups.count() // (4 * BLOCK))  # tasks for the groups of one block
    one = F.col("n_blocks") == 1
    dealt = (groups.join(cut(sizes, "near-sizes"), "grp").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
             .join(members.select("rep", "part").distinct(), "rep").join(classes.select("rep", *SKETCH).dropDuplicates(["rep"]), "rep").join(texts, "rep")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
             .withColumn("task", F.when(one, F.pmod(F.xxhash64("grp"), F.lit(small))).otherwise(F.xxhash64("grp", "lo", "hi"))))

    def compare(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        _, lo, hi = key
        some = some.sort_values("rep", ignore_index=True)
        owner, h, w = bags(*shingles(Words(list(some["text"]))))
        at = np.searchsorted(owner, np.arange(len(some) + 1))
        sketch, parts = some[SKETCH].to_numpy().view(np.uint64), some["part"].to_numpy()
        found = []
        for _, rows in some.groupby("grp").indices.items():
            left = rows[some["mine"].to_numpy()[rows] == lo]
            right = rows[some["mine"].to_numpy()[rows] == hi]
            bits = np.bitwise_count(sketch[left][:, None, :] ^ sketch[right][None, :, :]).sum(axis=2)
            a, b = np.nonzero((bits <= most_bits(threshold)) & (parts[left][:, None] != parts[right][None, :]))
            sure = np.full((len(left), len(right)), np.nan)  # similarity where no shingle repeats: common / all
            own = np.isin(owner, rows)
            shingle = np.unique(h[own], return_inverse=True)[1]
            if len(rows) * (shingle.max(initial=0) + 1) <= TABLE_CELLS and len(a) > len(rows):
                has = np.zeros((len(rows), shingle.max(initial=0) + 1), np.float32)
                has[np.searchsorted(rows, owner[own]), shingle] = 1
                plain = np.bincount(np.searchsorted(rows, owner[own]), w[own] > 1, len(rows)) == 0
                x, y = np.searchsorted(rows, left), np.searchsorted(rows, right)
                common, n = has[x] @ has[y].T, has.sum(axis=1)
                every = n[x][:, None] + n[y][None, :] - common
                sure = np.where(plain[x][:, None] & plain[y][None, :], common / every, np.nan)
            keep = ~(sure[a, b] < threshold - 1e-6)  # nan: not known yet
            a, b = a[keep], b[keep]
            order = np.argsort(bits[a, b], kind="stable")
            up: dict[int, int] = {}

            def top(x: int) -> int:
                while x in up:
                    x = up[x]
                return x

            for i, j in zip(left[a[order]].tolist(), right[b[order]].tolist()):
                p, q = top(int(parts[i])), top(int(parts[j]))
                if p != q and probability_jaccard((h[at[i]:at[i + 1]], w[at[i]:at[i + 1]]), (h[at[j]:at[j + 1]], w[at[j]:at[j + 1]])) >= threshold - 1e-12:
                    up[max(p, q)] = min(p, q)
                    found.append((some["rep"][i], some["rep"][j]))
        return pd.DataFrame(found, columns=["a", "b"])

    return dealt.groupBy("task", "lo", "hi").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, kept) of every row: class_id is the smallest id reachable over links, kept marks one row a class.

    A link joins texts with the same sequence of words, and pairs that share a band and have an exact probability
    Jaccard similarity of at least ``threshold``. (A pair at 0.8 shares no band with probability 5e-5;
    candidates whose signatures differ too much for the threshold are not fetched, see ``alike``.) Texts without
    any word (null, empty, punctuation only) and rows without id are their own class and kept. Rows that repeat an id
    come back as often and share the verdict of the id (of an id's different texts the smallest is verified). Other columns are ignored.

    Equal texts are one representative from the first grouping on. In a band's bucket, every representative is
    compared with the smallest one; members that are then left in different components are compared with each other
    in blocks (``compared_in_blocks``). So a group of copies costs about its size, not its square, and no candidate pair is left out: each was
    either verified or already inside one component.
    """
    rows = cut(profile(docs, id_col, text_col), "near-profile")
    words = rows.where("key1 is not null and id is not null")
    classes = cut(words.groupBy("key1", "key2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), *(F.first(c).alias(c) for c in SKETCH)), "near-classes")
    posted = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    buckets = cut(posted.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "near-buckets")
    members = cut(posted.join(buckets, ["band", "bucket"]).withColumn("part", F.col("rep")), "near-members")
    sketch_a, sketch_b = (classes.select(F.col("rep").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in SKETCH)) for x in "ab")
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).where("rep is not null and text is not null")
    texts = cut(texts.join(members.select("rep").distinct(), "rep", "left_semi").groupBy("rep").agg(F.min("text").alias("text")), "near-texts")

    def still_open(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components of the links, and the members of the buckets that they leave in several components."""
        parts = connected_components(links).select(F.col("vertex").alias("rep"), "root")
        placed = cut(members.drop("part").join(parts, "rep", "left").select("band", "bucket", "rep", F.coalesce("root", "rep").alias("part")), "near-placed")
        split = placed.groupBy("band", "bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p != q").select("band", "bucket")
        return parts, cut(placed.join(cut(split, "near-split"), ["band", "bucket"]), "near-open")

    leads = cut(members.groupBy("band", "bucket").agg(F.min("rep").alias("lead")), "near-leads")
    pairs = members.join(leads, ["band", "bucket"]).where("rep != lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = cut(pairs.join(sketch_b, "b").join(sketch_a, "a").where(alike(threshold)).select("a", "b"), "near-pairs")
    links = cut(verified(pairs, texts, threshold), "near-links")
    parts, members = still_open(members, links)
    rest = cut(compared_in_blocks(members, classes, texts, threshold), "near-rest")
    if not rest.isEmpty():
        parts = connected_components(links.union(rest)).select(F.col("vertex").alias("rep"), "root")

    own = classes.join(parts, "rep", "left").select("key1", "key2", F.coalesce("root", "rep").alias("class_id"))
    of_rows = words.select("id", "key1", "key2").join(cut(own, "near-own"), ["key1", "key2"])
    # an id with several texts: the smallest of their classes
    verdict = of_rows.groupBy("id").agg(F.min("class_id").alias("class_id"))
    return (docs.select(F.col(id_col).alias("_id")).join(cut(verdict, "near-verdict"), F.col("_id") == F.col("id"), "left")
            .select(F.col("_id").alias(id_col), F.coalesce("class_id", "_id").alias("class_id"),
                    F.coalesce(F.col("class_id") == F.col("_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged. Rows that repeat an id and are kept all stay."""
    gone = near_duplicates(docs, id_col, text_col, threshold).where("not kept").select(F.col(id_col).alias("_gone")).distinct()
    rows = packed(docs, id_col)
    return unpacked(rows.join(gone, F.col(id_col) == F.col("_gone"), "left_anti"), docs.columns)
