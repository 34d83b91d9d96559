"""Near-duplicate embeddings by a pivot-permutation index: ordered nearest pivots, inverted pivot lists, verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut

THRESHOLD = 0.95
NEAREST, SHARED = 12, 2
MOST_PIVOTS = 65_536
LIST_BLOCK = 1024


def usable(vec: Column) -> Column:
    """Neither null nor zero, all components finite."""
    big = F.lit(float("inf"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """Indices of the n nearest pivots by cosine, nearest first, ties to the smaller index."""
    d = min(vectors.shape[1], pivots.shape[1])
    score = vectors[:, :d] @ pivots[:, :d].T
    return np.argsort(-score, axis=1, kind="stable")[:, :n]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indices over the links a - b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            return root
        root = new
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    nearest: int = NEAREST, vectors_per_pivot: int = 64, most_pivots: int = MOST_PIVOTS,
                    list_block: int = LIST_BLOCK, shared: int = SHARED) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Links: pairs with a cosine of at least ``threshold`` in double precision that share at least ``shared`` of their
    ``nearest`` nearest pivots (all, if there are fewer pivots). n_links counts other rows linked directly, component_id is the smallest id reachable,
    kept marks the rows whose id it is. Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, nor do vectors of different lengths. Rows without id link with nothing, have a null component and
    are kept. Repeated rows count as further vectors. Other columns are ignored.

    Pivots are a sample of the n distinct vectors: one for every ``vectors_per_pivot``, beyond 262,144 vectors
    8 * sqrt(n), at most ``most_pivots`` (the only bounded part: every vector is posted). Equal vectors are one representative with a count. A list longer than
    ``list_block`` is split into blocks, and every pair of blocks is a task, so a long list is many tasks of bounded
    size. In a list the pivots that two members share are counted, pairs with enough of them are verified, and a pair
    counts in the list of the smallest pivot it shares; lists return sums and a spanning
    set of links for each member, never pairs.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    good = rows.where(usable(F.col("v")) & F.col("id").isNotNull())
    classes = cut(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    n = classes.count()
    n_pivots = max(1, min(most_pivots, -(-n // vectors_per_pivot), math.ceil(8 * math.sqrt(n))))
    sample = classes.select("rep", "v").orderBy(F.xxhash64("rep"), "rep").limit(n_pivots).collect()  # bounded by most_pivots
    width = max((len(r["v"]) for r in sample), default=0)
    pivots = np.zeros((len(sample), width))
    for k, r in enumerate(sample):
        pivots[k, :len(r["v"])] = unit([r["v"]])[0]

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["v"].map(len)
            for _, some in batch.groupby(sizes, sort=False):
                x = unit(list(some["v"]))
                lists = nearest_pivots(x, pivots, nearest)
                yield pd.DataFrame({"rep": some["rep"], "v": some["v"], "copies": some["copies"], "perm": list(lists.astype(np.int32))})

    item = classes.schema["v"].dataType.simpleString()
    posted = cut(classes.select("rep", "v", "copies").mapInPandas(post, f"rep long, v {item}, copies long, perm array<int>"), "vector-permutations")
    lists = posted.select(F.explode("perm").alias("pivot"), F.size("v").alias("width"), "rep", "v", "copies", "perm")
    blocks = lists.groupBy("pivot", "width").agg(F.count("*").alias("n")).withColumn("n_blocks", F.ceil(F.col("n") / list_block).cast("int")).drop("n")
    mine = F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int")
    dealt = (lists.join(blocks, ["pivot", "width"]).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")))

    def links(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        pivot, _, lo, hi = key
        some = some.sort_values("rep", ignore_index=True)
        x, perm, reps, copies = unit(list(some["v"])), np.stack(some["perm"]), some["rep"].to_numpy(), some["copies"].to_numpy()
        known, place = np.unique(perm, return_inverse=True)
        marks = np.zeros((len(some), len(known)), np.float32)
        marks[np.arange(len(some))[:, None], place.reshape(perm.shape)] = 1
        need = min(shared, perm.shape[1])
        left = np.arange(len(some)) if lo == hi else np.flatnonzero(some["mine"] == lo)
        right = left if lo == hi else np.flatnonzero(some["mine"] == hi)
        found = [np.zeros((2, 0), np.int64)]
        for k in range(0, len(left), 256):
            some_left = left[k:k + 256]
            retrieved = marks[some_left] @ marks[right].T >= need
            if not retrieved.any():
                continue
            a, b = np.nonzero(retrieved & (x[some_left] @ x[right].T >= threshold))
            a, b = some_left[a], right[b]
            if lo == hi:
                a, b = a[a < b], b[a < b]
            common = (perm[a][:, :, None] == perm[b][:, None, :]).any(axis=2)
            smallest = np.where(common, perm[a], np.iinfo(np.int32).max).min(axis=1)
            found.append(np.stack([a[smallest == pivot], b[smallest == pivot]]))
        a, b = np.concatenate(found, axis=1)
        n = np.bincount(a, copies[b], len(some)) + np.bincount(b, copies[a], len(some))
        linked = np.flatnonzero(n)
        return pd.DataFrame({"rep": reps[linked], "links": n[linked].astype(np.int64), "low": reps[roots(len(some), a, b)[linked]]})

    found = cut(dealt.groupBy("pivot", "width", "lo", "hi").applyInPandas(links, "rep long, links long, low long"), "vector-links")
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    own = (classes.join(sums, "rep", "left").join(parts, F.col("rep") == F.col("vertex"), "left")
           .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    own = cut(own, "vector-own").withColumnRenamed("v", "_v")
    linked = good.join(own, F.col("v") == F.col("_v")).select("id", "n_links", "component_id")
    alone = rows.where(~usable(F.col("v")) | F.col("id").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
