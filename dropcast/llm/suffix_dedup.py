"""Removal of repeated byte strings by distributed prefix doubling over positions.

Two positions are equal if the ``LENGTH`` bytes from there are equal. Ranks start from short strings and double
their length; positions whose rank is unique can't be equal to any other and go. One row for every byte of the corpus
in every round would cost many times the input, so positions travel together as long as they can:

1. Seeds. Every window of ``LENGTH`` bytes has a seed: of its strings of ``SEED`` bytes the one with the smallest
   hash (ties: the first). Equal windows have equal seeds at the same place. Consecutive windows with one seed position
   are a run; its bytes are its context. Runs get ranks by (seed, context): Spark sorts and counts them. All windows of
   a run whose rank is shared are repeated; a seed with one context only is unique, and all its windows go.
2. Steps. What is left are seeds with several contexts. Of each context one run stands for all. It is parted into steps
   of ``STEP`` positions, at the same distances from the seed in all contexts, so that equal positions lie in steps of the same
   number. All positions of a step are repeated if the bytes of the whole step are; of equal steps one stands for all.
3. Doubling. The windows of a step share its core, the bytes that all of them hold. Spark ranks the steps by (seed, step, first
   50 bytes of the core), then by (rank, next 50) and (rank, the rest): after each round only the steps
   that share their rank with another stay.
4. The positions of the steps that are left become rows and are ranked by all their ``LENGTH`` bytes.
5. Repeated positions are gathered for each text, and the bytes that they cover are cut out.

Texts are known by two 64-bit hashes. Equal texts have equal spans, so neither ids nor row numbers are needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, cut, discard, mix64

LENGTH, SEED = 200, 32
PIECE = 900_000
STEP = 16
_BITS = np.uint64(20)
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full((1 << 20) + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Names:
    """Hash names of all substrings of a buffer of less than 2**20 bytes: equal strings have equal names."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = _powers()
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE_CODES[buf] * power[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.inverse[start])


def runs(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, seed: int):
    """Runs of windows inside the texts buf[begin:end]: (text, first window, windows, seed name, context name)."""
    names, none = Names(buf), np.zeros(0, np.int64)
    n = len(buf) - seed + 1
    long = np.flatnonzero(end - begin >= length)
    if not len(long):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    x = names.of(np.arange(n), seed)
    low = (x >> _BITS << _BITS) | np.arange(n, dtype=np.uint64)  # hash, then position
    width, done = length - seed + 1, 1
    while done * 2 <= width:
        low, done = np.minimum(low[:-done], low[done:]), done * 2
    if width > done:
        low = np.minimum(low[:done - width], low[width - done:])
    at = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
    step = np.zeros(len(buf) + 1, np.int32)
    step[begin[long]] += 1
    step[end[long] - length + 1] -= 1
    p = np.flatnonzero(np.cumsum(step)[:len(at)] > 0)
    s = at[p]
    new = np.ones(len(p), bool)
    new[1:] = (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)
    k = np.flatnonzero(new)
    first, count, place = p[k], np.diff(np.append(k, len(p))), s[k]
    context = mix64(names.of(first, count - 1 + length) + mix64((count << 20 | (place - first)).astype(np.uint64)))
    return np.searchsorted(begin, first, side="right") - 1, first, count, x[place], context


KEY = ("h1", "h2")


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def seeds(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(seed, context, h1, h2, lo, n) of every run of windows of docs(h1, h2, text); lo counts bytes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            pieces: list[tuple[int, int, bytes]] = []  # row, offset, bytes
            total = 0

            def flush():
                parts = [x[2] for x in pieces]
                end = np.cumsum([len(x) for x in parts])
                text, first, count, s, c = runs(np.frombuffer(b"".join(parts), np.uint8), end - [len(x) for x in parts], end, length, seed)
                row = pa.array(np.array([x[0] for x in pieces], np.int64)[text])
                lo = first - (end - [len(x) for x in parts])[text] + np.array([x[1] for x in pieces], np.int64)[text]
                return pa.RecordBatch.from_arrays(
                    [pa.array(s.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(lo, pa.int64()), pa.array(count, pa.int32())], names=["seed", "context", *KEY, "lo", "n"])

            for row in range(len(texts)):
                data = texts[row].as_py()
                data = data.encode() if data else b""
                for offset in range(0, max(len(data) - length + 1, 0), PIECE):
                    part = data[offset:offset + PIECE + length - 1]
                    if pieces and total + len(part) > PIECE:
                        yield flush()
                        pieces, total = [], 0
                    pieces.append((row, offset, part))
                    total += len(part)
            if pieces:
                yield flush()

    return docs.select(*KEY, "text").mapInArrow(run, "seed long, context long, h1 long, h2 long, lo long, n int")


def _contexts(docs: DataFrame, picked: DataFrame, length: int) -> DataFrame:
    """The bytes of each picked run: (seed, context, alone, n, data). A text that comes several times gives them several times."""
    lists = picked.groupBy(*KEY).agg(F.collect_list(F.struct("seed", "context", "alone", "lo", "n")).alias("runs"))
    joined = docs.select(*KEY, "text").join(lists, list(KEY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().flatten()  # seed, context, alone, lo, n
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            lo, end = np.asarray(flat[3]), np.asarray(flat[3]) + np.asarray(flat[4]) - 1 + length
            data, k = [], 0
            for text, size in zip(batch.column(0), sizes.tolist()):
                whole = text.as_py().encode()
                data += [whole[i:j] for i, j in zip(lo[k:k + size].tolist(), end[k:k + size].tolist())]
                k += size
            yield pa.RecordBatch.from_arrays([*flat[:3], flat[4], pa.array(data, pa.binary())], names=["seed", "context", "alone", "n", "data"])

    return joined.select("text", "runs").mapInArrow(run, "seed long, context long, alone boolean, n int, data binary")


def _positions(some: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Names]:
    """All window positions of contexts: (row, start in the joined bytes), each row's begin, and the names of the joined bytes."""
    n = some["n"].to_numpy().astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(n - 1 + length)])
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[row]
    return row, start, begin, Names(np.frombuffer(b"".join(some["data"]), np.uint8))


def _slices(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Rows with contexts of at most 2 * length bytes, as many together as one buffer takes."""
    most = max(1, (1 << 19) // length)
    for batch in batches:
        for k in range(0, len(batch), most):
            yield batch.iloc[k:k + most].reset_index(drop=True)


def _rounds(length: int) -> list[tuple[int, int]]:
    """(offset, bytes) of the strings that ranks of cores grow by: a quarter of the length, then as many again, up to the core's end."""
    core = length - STEP + 1
    out, h = [(0, max(1, length // 4))], max(1, length // 4)
    while h < core:
        out.append((h, min(h, core - h)))
        h += min(h, core - h)
    return out


def _parted(data: DataFrame, length: int, seed: int) -> DataFrame:
    """(seed, context, alone, first, n, whole, r0, r1, ...) of the steps of data(seed, context, alone, n, data): first position
    in the context, positions, rank of the step's bytes, ranks of the growing strings of its core."""
    rounds = _rounds(length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(batches, length):
            row, start, begin, names = _positions(part, length)
            seeds_ = part["seed"].to_numpy().view(np.uint64)
            found = names.of(np.arange(len(names.sums) - seed), seed)
            place = np.array([b + int(np.argmax(found[b:e] == s)) for b, e, s in zip(begin[:-1], begin[1:], seeds_)])
            step = (place[row] - start) // STEP
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1])
            at = np.flatnonzero(new)
            row, first, count, step = row[at], start[at], np.diff(np.append(at, len(new))), step[at]
            rank = mix64(seeds_[row] + mix64(step.astype(np.uint64)))
            whole = mix64(rank + names.of(first, count - 1 + length) + mix64((count << 20 | (place[row] - first)).astype(np.uint64)))
            out = {c: part[c].to_numpy()[row] for c in ("seed", "context", "alone")}
            out |= {"first": first - begin[row], "n": count, "whole": whole.view(np.int64)}
            core = place[row] - STEP * step
            for k, (offset, size) in enumerate(rounds):
                rank = mix64(rank + names.of(core + offset, size))
                out[f"r{k}"] = rank.view(np.int64)
            yield pd.DataFrame(out)

    return data.mapInPandas(run, "seed long, context long, alone boolean, first int, n int, whole long, "
                            + ", ".join(f"r{k} long" for k in range(len(rounds))))


def _ranked(steps: DataFrame, data: DataFrame, length: int) -> DataFrame:
    """(rank, open, seed, context, first): all positions of steps(seed, context, first, n, open), ranked by ``length`` bytes."""
    lists = steps.groupBy("seed", "context").agg(F.collect_list(F.struct("first", "n", "open")).alias("steps"))
    joined = data.select("seed", "context", "n", "data").join(lists, ["seed", "context"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(batches, length):
            names, begin = _positions(part, length)[3:1:-1]
            row = np.repeat(np.arange(len(part)), [len(x) for x in part["steps"]])
            first, n, open_ = (np.array([s[c] for x in part["steps"] for s in x]) for c in ("first", "n", "open"))
            step = np.repeat(np.arange(len(row)), n)
            at = np.arange(len(step)) - np.repeat(np.cumsum(n) - n, n) + first[step]
            row = row[step]
            rank = mix64(names.of(begin[row] + at, length) + part["seed"].to_numpy().view(np.uint64)[row])
            yield pd.DataFrame({"rank": rank.view(np.int64), "open": open_[step], **{c: part[c].to_numpy()[row] for c in ("seed", "context")}, "first": at})

    return joined.mapInPandas(run, "rank long, open boolean, seed long, context long, first int")


def _shared(rows: DataFrame, rank: str) -> DataFrame:
    """Ranks that several rows have."""
    return rows.groupBy(rank).agg(F.count("*").alias("c")).where("c > 1").select(rank)


def repeated(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(h1, h2, lo, n): runs of n positions from lo on whose ``length`` bytes start elsewhere too, of docs(h1, h2, text).
    The same run comes once for each copy of its text."""
    found = seeds(docs, length, seed)
    contexts = cut(found.groupBy("seed", "context").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in (*KEY, "lo", "n"))), "suffix-contexts")
    several = contexts.groupBy("seed").agg(F.count("*").alias("c")).where("c > 1").select("seed")
    picked = cut(contexts.join(several, "seed", "left_semi").select("seed", "context", (F.col("copies") == 1).alias("alone"), *KEY, "lo", "n"), "suffix-picked")
    twice = cut(contexts.where("copies > 1").select("seed", "context"), "suffix-twice")
    discard(contexts)  # the runs of all other texts: most of the rows
    given = _contexts(docs, picked, length)
    texts = picked.select(*KEY).distinct()  # a text that several rows have gives its contexts as often
    several_rows = not docs.join(texts, list(KEY), "left_semi").groupBy(*KEY).count().where("count > 1").isEmpty()
    data = cut(given.dropDuplicates(["seed", "context"]) if several_rows else given, "suffix-data")

    steps = cut(_parted(data, length, seed), "suffix-steps")
    ranks = [f"r{k}" for k in range(len(_rounds(length)))]
    equal = cut(steps.groupBy("whole").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("seed", "context", "alone", "first", "n", *ranks)))
                .withColumn("open", F.col("alone") & (F.col("copies") == 1)), "suffix-equal")
    whole = cut(steps.where("alone").join(equal.where("copies > 1").select("whole"), "whole", "left_semi").select("seed", "context", "first", "n"), "suffix-whole")
    discard(steps)
    left = equal.select("seed", "context", "first", "n", "open", *ranks)
    before = equal
    for rank in ranks:
        left = cut(left.join(_shared(left, rank), rank, "left_semi").drop(rank), "suffix-round")
        discard(before)
        before = left
    rows = cut(_ranked(left, data, length), "suffix-positions")
    discard(left)
    discard(data)
    single = rows.where("open").join(_shared(rows, "rank"), "rank", "left_semi").select("seed", "context", "first", F.lit(1).alias("n"))

    alone = picked.where("alone").select("seed", "context", *KEY, "lo")
    parts = whole.unionByName(single).join(alone, ["seed", "context"]).select(*KEY, (F.col("lo") + F.col("first")).alias("lo"), F.col("n").cast("long").alias("n"))
    return found.join(twice, ["seed", "context"], "left_semi").select(*KEY, "lo", F.col("n").cast("long").alias("n")).unionByName(parts)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                   as_text: bool = False) -> DataFrame:
    """(id, carried columns, n_bytes, spans array<struct<start, end>>, kept) of every row: ``kept`` are the UTF-8 bytes of
    the text outside of ``spans``, the maximal runs of bytes that strings of ``length`` bytes cover which also start
    anywhere else in the corpus (the same text included, matches within one text only, overlaps count).

    Null and empty texts, and texts of less than ``length`` bytes, lose nothing. Equal texts of at least ``length`` bytes
    lose everything, all copies of them; repeated rows are copies too and come back as often. Null ids are ids. With
    ``as_text``, kept is a string, and what is left of a character that a span cuts goes as well.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *text_key(text), text.alias("text"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)))
    at = repeated(rows, length, seed).groupBy(*KEY).agg(F.collect_set(F.struct("lo", "n")).alias("runs"))
    joined = rows.join(at, list(KEY), "left").select("id", *(f"c{k}" for k in range(len(carry))), "text", "runs")
    names = ["id", *(f"c{k}" for k in range(len(carry)))]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("runs")):
                data = text.as_py().encode()
                sizes.append(len(data))
                own, rest = [], data
                if found.is_valid and len(found.values):
                    lo, n = (np.asarray(found.values.field(k)) for k in (0, 1))
                    change = np.zeros(len(data) + 1, np.int64)
                    np.add.at(change, lo, 1)
                    np.add.at(change, lo + n - 1 + length, -1)
                    covered = np.cumsum(change)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                    own = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    rest = np.frombuffer(data, np.uint8)[~covered].tobytes()
                spans.append(own)
                kept.append(rest.decode(errors="ignore") if as_text else rest)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sizes, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.string() if as_text else pa.binary())], names=[*names, "n_bytes", "spans", "kept"])

    head = ", ".join(f"{c} {joined.schema[c].dataType.simpleString()}" for c in names)
    out = joined.mapInArrow(run, f"{head}, n_bytes long, spans array<struct<start: long, end: long>>, kept {'string' if as_text else 'binary'}")
    return out.select(F.col("id").alias(id_col), *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)), "n_bytes", "spans", "kept")
