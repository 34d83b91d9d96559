"""Helpers shared by the corpus operators: tables, lineage cuts, skew-safe ranks, components, word hashes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce
from operator import and_
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import scratch_path


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors once per application (they need not have it installed)."""
    sc = spark.sparkContext
    if any(f.endswith("/dropcast_package.zip") for f in sc.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="dropcast-package-"), "dropcast_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts the lineage;
    the files outlive any executor)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(df: DataFrame) -> None:
    """Empty the files of a table that ``cut`` wrote, when what was read from it has been written in its turn."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(df.cut_path)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` and, as the struct ``row``, all its columns (f0, f1, ... whatever they are called), so
    that no name of a caller's column can clash with one that an operator adds."""
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`").alias(f"f{k}") for k, c in enumerate(docs.columns))).alias("row"))


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns packed in ``row``, under their names; ``changed`` ones are replaced."""
    return rows.select(*(changed.get(c, F.col(f"row.f{k}")).alias(c) for k, c in enumerate(columns)))


def grouped_rank(df: DataFrame, group: str, order: list[str], out: str, rows_per_bucket: int = 1024) -> DataFrame:
    """Gapless rank (from 0) of every row within its group, without one task per group.

    Rows are dealt into (group, hash bucket) cells of about ``rows_per_bucket`` rows at most;
    a row's rank is its place in the cell (by ``order``) plus the sizes of the group's earlier
    cells. A group with most of the rows spans most of the cells. Rows equal in every ``order``
    column are interchangeable; where they are more than a cell's worth they are dealt singly.
    """
    buckets = max(1, -(-df.count() // rows_per_bucket))
    equal = df.groupBy(*order).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_bucket)
    equal = cut(equal.select(*(F.col(c).alias(f"_e{k}") for k, c in enumerate(order)), F.lit(True).alias("_many")), "rank-equal")
    salt = F.lit(0).cast("long")
    if not equal.isEmpty():
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_e{k}")) for k, c in enumerate(order)))
        marked = df.join(checked_broadcast(equal), same, "left")
        df = cut(marked.select(*df.columns, F.when(F.col("_many"), F.monotonically_increasing_id()).alias("_salt")), "rank-salted")
        salt = F.col("_salt")
    celled = df.withColumn("_cell", F.pmod(F.xxhash64(*order, salt), F.lit(buckets)))
    before = (celled.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(
                  Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)))
              .select(F.col(group).alias("_g"), F.col("_cell").alias("_c"), F.coalesce("_before", F.lit(0)).alias("_before")))
    place = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1
    ranked = celled.withColumn("_place", place)
    same = ranked[group].eqNullSafe(before["_g"]) & (ranked["_cell"] == before["_c"])
    return (ranked.join(before, same).withColumn(out, (F.col("_place") + F.col("_before")).cast("long"))
            .drop("_cell", "_place", "_g", "_c", "_before", "_salt"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of the undirected ``edges(a, b)``; root is the smallest reachable vertex.

    Contraction: every vertex hooks to its smallest smaller neighbour, the hooks are compressed by
    pointer jumping, both ends of the edges are replaced by their roots, and edges inside a root go.
    At least half of the vertices that still have edges disappear in a round. All steps are
    pre-aggregated groupings and joins of written tables, so that a hub is split like any skewed join key.
    """
    spark = edges.sparkSession
    e = cut(edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    vertices = e.select(F.col("hi").alias("vertex")).union(e.select("lo")).distinct().withColumn("root", F.col("vertex"))
    maps = []
    while not e.isEmpty():
        hooks = cut(e.groupBy("hi").agg(F.min("lo").alias("up")), "hooks")
        while True:
            over = hooks.select(F.col("hi").alias("up"), F.col("up").alias("upper"))
            jumped = cut(hooks.join(over, "up", "left").select(
                "hi", F.coalesce("upper", "up").alias("up"), F.col("upper").isNotNull().alias("moved")), "hooks")
            hooks = jumped.select("hi", "up")
            if jumped.where("moved").isEmpty():
                break
        maps.append(hooks)
        left, right = (hooks.select(F.col("hi").alias(c), F.col("up").alias(f"{c}_up")) for c in ("hi", "lo"))
        moved = e.join(left, "hi", "left").join(right, "lo", "left").select(
            F.coalesce("hi_up", "hi").alias("x"), F.coalesce("lo_up", "lo").alias("y")).where("x != y")
        e = cut(moved.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "edges")
    for hooks in maps:
        step = hooks.select(F.col("hi").alias("root"), "up")
        vertices = vertices.join(step, "root", "left").select("vertex", F.coalesce("up", "root").alias("root"))
    return cut(vertices, "components")


# --- vectorised hashing of words -------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULT)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _lower(text: str) -> bytes:
    """Lower case with the same number of UTF-8 bytes (characters that would change theirs stay)."""
    out = text.lower().encode()
    if len(out) != len(text.encode()):
        out = "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in text).encode()
    return out


class Words:
    """Words of a batch of texts, lower-cased: maximal runs of ASCII letters, digits and non-ASCII characters.

    ``hashes``: 64-bit hash of each word; ``first``: index of each text's first word (one more entry at
    the end); ``start``/``end``: byte range of each word in ``data``, the lower-cased texts one after the other, text k from ``begin[k]``.
    """

    def __init__(self, texts: list[str | None]):
        parts = [_lower(t or "") for t in texts]
        lengths = np.array([len(p) + 1 for p in parts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(lengths)])
        self.data = b"\n".join(parts) + b"\n" if parts else b""
        buf = np.frombuffer(self.data, np.uint8)
        inside = _IS_WORD[buf]
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.begin)
        sizes = self.end - self.start
        if len(sizes):
            power = np.ones(int(sizes.max()), np.uint64)
            power[1:] = _MULT | np.uint64(1)
            power = np.cumprod(power)
            at = np.flatnonzero(inside)
            nth = np.cumsum(sizes)
            depth = np.arange(len(at)) - np.repeat(nth - sizes, sizes)
            self.hashes = mix64(np.add.reduceat(BYTE_CODES[buf[at]] * power[depth], nth - sizes))
        else:
            self.hashes = np.zeros(0, np.uint64)


    def prefixes(self, size: int = 5, least: int = 7) -> np.ndarray:
        """64-bit hash of the first ``size`` bytes of each word of at least ``least`` bytes, 0 for shorter ones."""
        buf = np.frombuffer(self.data, np.uint8)
        out = np.zeros(len(self.start), np.uint64)
        some = np.flatnonzero(self.end - self.start >= least)
        for j in range(size):
            out[some] = mix64(out[some] + BYTE_CODES[buf[self.start[some] + j]])
        return out


def text_slices(column, max_bytes: int = 4 << 20):
    """Consecutive index ranges of an Arrow string column with about ``max_bytes`` of text each
    (a single longer text is a range of its own)."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > max_bytes:
            yield lo, i
            lo, total = i, 0
        total += int(n)
    if lo < len(sizes):
        yield lo, len(sizes)
