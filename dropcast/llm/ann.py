"""Approximate nearest neighbours by a permutation index: vectors as their ordered nearest pivots, posted in inverted
pivot files, ranked by footrule distance, then reranked by the true distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .embedding_dedup import usable

N_PIVOTS, PREFIX = 256, 64
PROBE = 0.2
SEGMENT_ROWS, QUERY_BLOCK = 2048, 4096


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector by Euclidean distance, nearest first, ties to the smaller pivot."""
    d = min(vectors.shape[1], pivots.shape[1])
    far = (pivots * pivots).sum(axis=1) - 2 * (vectors[:, :d] @ pivots[:, :d].T)
    return np.argsort(np.nan_to_num(far), axis=1, kind="stable")[:, :prefix].astype(np.int16)


class PivotFiles:
    """Inverted pivot files of a segment: for each pivot the rows that have it in their prefix, with its place there."""

    def __init__(self, perms: np.ndarray, n_pivots: int):
        self.rows, self.prefix = perms.shape
        order = np.argsort(perms.ravel(), kind="stable")
        self.row, self.place = order // self.prefix, (order % self.prefix).astype(np.int32)
        self.start = np.searchsorted(perms.ravel()[order], np.arange(n_pivots + 1))

    def closeness(self, perm: np.ndarray) -> np.ndarray:
        """Half of (largest possible minus footrule distance) to every row: sum over shared pivots of
        prefix - the later of both places (a pivot outside a prefix counts as at place ``prefix``)."""
        out = np.zeros(self.rows, np.int64)
        for place, pivot in enumerate(perm):
            part = slice(self.start[pivot], self.start[pivot + 1])
            out[self.row[part]] += self.prefix - np.maximum(self.place[part], place)
        return out


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           n_pivots: int = N_PIVOTS, prefix: int = PREFIX, probe: float = PROBE,
           segment_rows: int = SEGMENT_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every row where ``is_query`` holds, nearest first.

    Candidates are all rows but those with the query's own id; score is the Euclidean distance in double precision;
    ties go to the smaller id. Fewer candidates give fewer rows. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without id, take no part; vectors of different lengths never meet. Repeated rows
    are candidates as often as they come (a query's repeats answer once). Other columns are ignored.

    Fitting takes ``n_pivots`` vectors (the bounded sample); every vector is posted. The rows are dealt by hash into
    segments of about ``segment_rows``, the queries into blocks of at most about ``query_block``; a task holds the
    inverted files of one segment and one block of queries, reranks the ``probe`` share of the segment with the smallest
    footrule distance (equal distances: smaller ids first) and returns k rows a query.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), is_query.alias("q"))
    rows = rows.where(usable(F.col("v")) & F.col("id").isNotNull())
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()  # bounded by n_pivots
    pivots = np.zeros((len(sample), max((len(r["v"]) for r in sample), default=0)))
    for i, r in enumerate(sample):
        pivots[i, :len(r["v"])] = r["v"]

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, some in batch.groupby(batch["v"].map(len), sort=False):
                perm = permutations(np.array(list(some["v"]), np.float64), pivots, prefix)
                yield some.assign(perm=list(perm))

    item = rows.schema["v"].dataType.simpleString()
    kind = rows.schema["id"].dataType.simpleString()
    posted = cut(rows.mapInPandas(post, f"id {kind}, v {item}, q boolean, perm array<short>"), "ann-permutations")
    n, n_queries = posted.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    n_segments, n_blocks = max(1, -(-n // segment_rows)), max(1, -(-n_queries // query_block))
    spread = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    kept = posted.select("id", "v", "perm", F.size("v").alias("width"))
    base = kept.withColumn("segment", spread(n_segments)).withColumn("block", every(n_blocks))
    asked = posted.where("q").select("id", "v", "perm", F.size("v").alias("width")).dropDuplicates(["id", "v"])
    asked = asked.withColumn("block", spread(n_blocks)).withColumn("segment", every(n_segments))
    keys = ["segment", "block", "width"]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable", ignore_index=True)
            ids, x = right["id"].to_numpy(), np.array(list(right["v"]), np.float64)
            files = PivotFiles(np.stack(right["perm"]), len(pivots))
            most = min(len(ids), max(int(np.ceil(probe * len(ids))), 4 * k))
            for qid, v, perm in zip(left["id"], left["v"], left["perm"]):
                order = np.arange(len(ids)) - files.closeness(perm) * len(ids)
                order[ids == qid] = np.iinfo(np.int64).max
                near = np.sort(np.argpartition(order, most - 1)[:most])
                near = near[ids[near] != qid]
                gap = x[near] - np.asarray(v, np.float64)
                far = np.sqrt((gap * gap).sum(axis=1))
                top = np.lexsort((ids[near], far))[:k]
                out.append(pd.DataFrame({"query_id": qid, "id": ids[near][top], "score": far[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []})

    found = asked.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInPandas(best, f"query_id {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
