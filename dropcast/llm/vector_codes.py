"""Vector compression: each part of a vector becomes the index of its nearest codebook entry.

The codebooks come from rounds of assigning and averaging (all in integers). A round does not visit single vectors
where it can help it: every block of vectors holds, for each part position, a metric tree built by the anchors
hierarchy, middle out. About sqrt(n) anchors are placed first, each the point furthest from its owner so far, and take
over the points nearer to them than to their owners; upwards, the two balls whose common ball is smallest are merged
until one is left; downwards, each anchor's points are treated alike until ``LEAF`` are left. Every ball caches the sum and the
number of its points and a radius. In a round, a ball inherits the list of candidate entries of the ball around it and
strikes out the entries that lie behind a bisector with its nearest entry, seen from anywhere in the ball. With one
entry left the whole ball is that entry's and its cached sum and count are added; points are looked at one by one
only in the smallest balls. The trees are built once and written; a round reads them and returns sums.

Defined results: vectors that are null or hold null or non-finite components take no part and have no row; repeated
rows count and come back as often; shorter vectors are filled up with zeros to the longest one's length, rounded up
to equal parts; null ids come last in the start codebook and equal ids are ordered by their vectors; with fewer vectors than
entries the codebooks have as many entries as there are vectors; without any, the result is empty. Components whose
absolute value is 2**18 or more are refused with an error, since sums of squares must fit a long. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.joins import checked_broadcast
from .common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK, LEAF = 2048, 24
_LARGEST = 1 << 28  # of a scaled component


class _Ball:
    def __init__(self, total, rows, below=(), radius=None, points=None):
        self.total, self.count, self.rows, self.below = total, len(rows), rows, below
        self.centre = total / self.count
        self.radius = np.sqrt(((points - self.centre) ** 2).sum(1).max()) if radius is None else radius


def _anchors(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Points (as rows) of about sqrt(n) anchors; each new anchor is the point furthest from its owner."""
    here = points[rows]
    anchor = [0]
    owner = np.zeros(len(rows), np.int64)
    far = np.sqrt(((here - here[0]) ** 2).sum(1))
    while len(anchor) ** 2 < len(rows):
        new = int(far.argmax())
        if far[new] == 0:  # all points lie on their anchors
            break
        apart = np.sqrt(((here[anchor] - here[new]) ** 2).sum(1))
        maybe = np.flatnonzero(far > apart[owner] / 2)  # others are nearer to their owner
        near = np.sqrt(((here[maybe] - here[new]) ** 2).sum(1))
        won = near < far[maybe]
        owner[maybe[won]], far[maybe[won]] = len(anchor), near[won]
        anchor.append(new)
    return [rows[owner == k] for k in range(len(anchor)) if (owner == k).any()]


def _grow(points: np.ndarray, rows: np.ndarray) -> _Ball:
    """Metric tree over points[rows], from its anchors upwards and downwards."""
    groups = _anchors(points, rows) if len(rows) > LEAF else []
    if len(groups) < 2:
        return _Ball(points[rows].sum(0), rows, points=points[rows])
    balls = [_grow(points, g) for g in groups]
    size = len(balls)
    centre, radius, count = np.array([b.centre for b in balls]), np.array([b.radius for b in balls]), np.array([b.count for b in balls], float)

    def joined(k: int) -> np.ndarray:
        """Radius of the common ball of ball k and every other."""
        share = count / (count + count[k])
        apart = np.sqrt(((centre - centre[k]) ** 2).sum(1))
        out = np.maximum(apart * (1 - share) + radius, apart * share + radius[k])
        out[k] = np.inf
        return out

    cost = np.array([joined(k) for k in range(size)])
    gone = np.zeros(size, bool)
    for _ in range(size - 1):
        a, b = divmod(int(cost.argmin()), size)
        both = np.concatenate([balls[a].rows, balls[b].rows])
        balls[a] = _Ball(balls[a].total + balls[b].total, both, (balls[a], balls[b]), points=points[both])
        centre[a], radius[a], count[a], gone[b] = balls[a].centre, balls[a].radius, balls[a].count, True
        row = np.where(gone, np.inf, joined(a))
        cost[a], cost[:, a] = row, row
        cost[b], cost[:, b] = np.inf, np.inf
    return balls[int(np.flatnonzero(~gone)[0])]


def _flat(root: _Ball) -> dict[str, np.ndarray]:
    """Balls in preorder: ``to`` is the index after a ball's last descendant, its points are order[lo:hi]."""
    order, lo, hi, to, radius, total = [], [], [], [], [], []
    stack: list[tuple[_Ball, int]] = [(root, -1)]
    at = 0
    while stack:
        ball, mark = stack.pop()
        if mark >= 0:
            to[mark] = len(lo)
            continue
        me = len(lo)
        lo.append(at if not ball.below else -1)
        hi.append(0)
        to.append(0)
        radius.append(ball.radius)
        total.append(ball.total)
        stack.append((ball, me))
        if ball.below:
            stack += [(b, -1) for b in reversed(ball.below)]
        else:
            order.append(ball.rows)
            at += len(ball.rows)
            hi[me] = at
    for k in range(len(lo) - 1, -1, -1):  # inner balls span their descendants
        if lo[k] < 0:
            lo[k], hi[k] = lo[k + 1], hi[to[k] - 1]
    return {"order": np.concatenate(order), "lo": np.array(lo), "hi": np.array(hi), "to": np.array(to),
            "radius": np.array(radius), "total": np.array(total)}


_TREE = {"part_balls": "int", "order": "int", "lo": "int", "hi": "int", "to": "int", "radius": "double", "total": "bigint"}


def trees(vectors: DataFrame, width: int, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """Blocks of vectors(id, label, vector): their ids, labels, scaled components and the balls of every part's tree."""
    kinds = [to_arrow_type(vectors.schema[c].dataType) for c in ("id", "label")]

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(2)
        sizes = column.value_lengths().to_numpy()
        x = np.zeros((len(column), width * parts))
        x[np.repeat(np.arange(len(column)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
        x = np.floor(x * scale)
        if np.abs(x).max(initial=0) >= _LARGEST:
            raise ValueError("vector components must lie within 2**18 of zero")
        points = x.astype(np.int64)
        grown = [_flat(_grow(points[:, p * width:(p + 1) * width], np.arange(len(points)))) for p in range(parts)]
        arrays = {"part_balls": np.array([len(g["lo"]) for g in grown])}
        arrays |= {c: np.concatenate([g[c].reshape(-1) for g in grown]) for c in list(_TREE)[1:]}
        whole = [pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(k).cast(kinds[k])) for k in range(2)]
        made = {c: pa.array([arrays[c]], pa.list_({"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[t])) for c, t in _TREE.items()}
        return pa.RecordBatch.from_arrays([*whole, pa.array([points.reshape(-1)], pa.list_(pa.int64())), *made.values()],
                                          names=["ids", "labels", "points", *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, BLOCK - rows)
                batch = batch.slice(len(part))
                waiting.append(part)
                rows += len(part)
                if rows == BLOCK:
                    yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    head = ", ".join(f"{n} array<{vectors.schema[c].dataType.simpleString()}>" for n, c in (("ids", "id"), ("labels", "label")))
    return vectors.select("id", "label", "vector").mapInArrow(run, f"{head}, points array<bigint>, " + ", ".join(f"{c} array<{t}>" for c, t in _TREE.items()))


def _owners(tree: dict[str, np.ndarray], points: np.ndarray, book: np.ndarray, owned: Callable, single: Callable) -> None:
    """Hand the balls and points of a tree to their nearest entries: owned(ball, entry), single(rows, entries)."""
    lo, hi, to, radius = tree["lo"], tree["hi"], tree["to"], tree["radius"]
    centre = tree["total"] / (hi - lo)[:, None]
    entries = book.astype(float)
    small = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)) < 1 << 20  # squares are exact as doubles
    exact = (points.astype(float), entries) if small else (points, book)
    stack = [(0, np.arange(len(book)))]
    while stack:
        ball, candidates = stack.pop()
        far = ((entries[candidates] - centre[ball]) ** 2).sum(1)
        best = int(far.argmin())
        apart = np.sqrt(((entries[candidates] - entries[candidates[best]]) ** 2).sum(1))
        slack = 1e-9 * (far + far[best] + 1)
        candidates = candidates[far - far[best] <= 2 * radius[ball] * apart + slack]
        if len(candidates) == 1:
            owned(ball, int(candidates[0]))
        elif to[ball] == ball + 1:
            rows = tree["order"][lo[ball]:hi[ball]]
            x, e = exact[0][rows], exact[1][candidates]
            single(rows, candidates[((x ** 2).sum(1)[:, None] - 2 * (x @ e.T) + (e ** 2).sum(1)).argmin(1)])  # the first of equals
        else:
            child = ball + 1
            while child < to[ball]:
                stack.append((child, candidates))
                child = int(to[child])


def _read(batch: pa.RecordBatch, k: int, width: int, parts: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """The trees of block ``k`` of a batch, with the points of their part."""
    value = {c: batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (*_TREE, "points")}
    points = value["points"].reshape(-1, width * parts)
    first, n = 0, len(points)
    for p, balls in enumerate(value["part_balls"]):
        own = slice(first, first + balls)
        yield ({"order": value["order"][p * n:(p + 1) * n], **{c: value[c][own] for c in ("lo", "hi", "to", "radius")},
                "total": value["total"].reshape(-1, width)[own]}, points[:, p * width:(p + 1) * width])
        first += balls


def _improved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: every entry the floor of the mean of its parts; unused ones stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)  # the count comes last
        for batch in batches:
            for k in range(len(batch)):
                for p, (tree, points) in enumerate(_read(batch, k, width, parts)):
                    into = sums[p]

                    def owned(ball, entry, tree=tree, into=into):
                        into[entry, :width] += tree["total"][ball]
                        into[entry, width] += tree["hi"][ball] - tree["lo"][ball]

                    def single(rows, of, points=points, into=into):
                        np.add.at(into[:, :width], of, points[rows])
                        np.add.at(into[:, width], of, 1)

                    _owners(tree, points, books[p], owned, single)
        used = np.flatnonzero(sums.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums.reshape(-1)[used])], names=["slot", "total"])

    sums = np.zeros(parts * entries * (width + 1), np.int64)
    for row in blocks.mapInArrow(run, "slot int, total long").groupBy("slot").agg(F.sum("total").alias("total")).collect():  # bounded by the codebooks
        sums[row.slot] = row.total
    sums = sums.reshape(parts, entries, width + 1)
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)


def _codes(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code array<int>, error) of every vector."""
    parts, entries, width = books.shape
    ids, labels = (blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                n = len(batch.column("ids")[k].values)
                code, error = np.zeros((n, parts), np.int32), np.zeros(n, np.int64)
                for p, (tree, points) in enumerate(_read(batch, k, width, parts)):
                    def single(rows, of, p=p):
                        code[rows, p] = of

                    _owners(tree, points, books[p], lambda ball, entry, tree=tree: single(tree["order"][tree["lo"][ball]:tree["hi"][ball]], entry), single)
                    error += ((points - books[p][code[:, p]]) ** 2).sum(1)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts), pa.int32()), pa.array(code.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("ids")[k].values, batch.column("labels")[k].values, listed, pa.array(error)],
                                                 names=["id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"id {ids}, label {labels}, code array<int>, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code array<int>, error) of every usable vector, and the codebooks (part, entry, place in the part)."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(
        F.col("vector").isNotNull() & finite).withColumn("vector", F.col("vector").cast("array<double>"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts)
    start = kept.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    first = np.zeros((len(start), parts * width))
    for k, row in enumerate(start):
        first[k, :len(row.vector)] = row.vector
    books = np.floor(first * scale).astype(np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    blocks = cut(trees(kept, width, parts, scale), "vector-trees")
    for _ in range(rounds if len(start) and width else 0):
        books = _improved(blocks, books)
    return _codes(blocks, books), books


def label_codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as two hexadecimal digits a part, errors also summed
    over equal labels (nulls together), and the digest of all codebook components, comma-joined by part, entry, place."""
    codes, books = compress(vectors)
    codes = cut(codes, "vector-codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    text = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return codes.join(checked_broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), text.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
