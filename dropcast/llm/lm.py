"""Interpolated modified Kneser-Ney language model, counted in Spark, kept as sorted hash arrays that workers map.

Tokens are words (ASCII letters in lower case, parted by ASCII white space) and one end of text each. The model has
pairs: a word's probability after another is the discounted count of the pair, and what the discounts leave goes to the
word's continuation probability, from the number of different words before it, itself discounted and interpolated with
the uniform distribution over the known words and one unknown word. Discounts for counts of 1, 2, 3 and more follow
from the counts of counts. Each text starts after a begin mark.

1. Tasks count the pairs of their texts and hand every bucket (a range of context hashes) two sorted arrays: contexts, and
   the following words with counts. The pairs of frequent contexts, known from a sample, are spread over all buckets.
2. A bucket's task adds up equal pairs, writes them as sorted arrays of hashes and counts to the shared folder, and
   passes on per word what its pairs say: count, singles, doubles and others as a context, different words before it.
3. A second grouping, by ranges of word hashes, adds these up and writes the arrays of the words in the same way.
4. Scoring tasks map the files and look the sorted distinct hashes of a batch of text up, file by file.

Hashes have 64 bits; different words (pairs) with equal hashes would be counted as one, at 10**8 words with a
probability below 0.001. Files are written under a name of their own and renamed, so that a repeated task does no harm.

Defined results: a null or empty text is its end alone; rows with equal ids and repeated rows are texts of their own; a
null id is never held out. Without training texts every probability is 1. Texts of any length are read in pieces of about
``PIECE`` bytes, cut at white space. Only id and text are read, whatever the other columns are called.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import _MULT, BYTE_CODES, mix64

PIECE = 4 << 20  # bytes of text that are scored or counted at a time
COUNTED = 1 << 21  # tokens whose pairs a task adds up before it hands them on
BUCKET_BYTES = 8 << 20  # of text for each bucket of pairs
SAMPLE_TEXTS, FREQUENT = 2000, 0.002  # contexts with this share of the sample's tokens are spread over all buckets
BEGIN, END = mix64(np.array([1, 2], np.uint64) * _MULT)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SPACES = re.compile(rb"[\x20\x09-\x0D]")


# --- tokens ----------------------------------------------------------------------------------


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every word of ``data``."""
    buf = np.frombuffer(data.lower(), np.uint8)
    inside = ~_SPACE[buf]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), start
    sizes = end - start
    power = np.full(int(sizes.max()), _MULT | np.uint64(1), np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    nth = np.cumsum(sizes)
    depth = np.arange(nth[-1]) - np.repeat(nth - sizes, sizes)
    return mix64(np.add.reduceat(BYTE_CODES[buf[inside]] * power[depth], nth - sizes)), start


def _cuts(data: bytes) -> Iterator[bytes]:
    """Pieces of about PIECE bytes that begin at white space (a longer word stays whole)."""
    at = 0
    while len(data) - at > PIECE and (space := _SPACES.search(data, at + PIECE)):
        yield data[at:space.start()]
        at = space.start()
    yield data[at:]


def tokens(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(token hashes, index of their text) of consecutive texts, about PIECE bytes at a time; each text ends with END."""
    waiting: list[bytes] = []
    texts_: list[tuple[int, bool]] = []  # text, and whether the piece ends it
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        begin = np.cumsum([0] + [len(p) + 1 for p in waiting])
        words, start = _hashes(b" ".join(waiting))
        piece = np.searchsorted(begin, start, side="right") - 1
        ends = np.flatnonzero([last for _, last in texts_])
        place = np.concatenate([piece * 2, ends * 2 + 1])  # a piece's end comes after its words
        order = np.argsort(place, kind="stable")
        of = np.array([k for k, _ in texts_], np.int64)
        return np.concatenate([words, np.full(len(ends), END)])[order], of[place[order] // 2]

    for k, text in enumerate(texts):
        pieces = list(_cuts((text or "").encode()))
        for j, piece in enumerate(pieces):
            if waiting and size + len(piece) > PIECE:
                yield flush()
                waiting, texts_, size = [], [], 0
            waiting.append(piece)
            texts_.append((k, j == len(pieces) - 1))
            size += len(piece) + 1
    if waiting:
        yield flush()


def _before(now: np.ndarray, last: np.uint64) -> np.ndarray:
    """The token before each token; BEGIN at the start of a text."""
    out = np.concatenate([np.array([last], np.uint64), now[:-1]])
    out[out == END] = BEGIN
    return out


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(context * np.uint64(3) + word)


# --- files -----------------------------------------------------------------------------------


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)


def _write(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Arrays one after the other, 8 bytes at a time, behind a head of (name, type, length) in ``name``.head."""
    store, path = _store(folder)
    store.create_dir(path)
    own = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    with store.open_output_stream(own + ".head") as out:
        out.write(";".join(f"{k},{a.dtype.str},{len(a)}" for k, a in arrays.items()).encode())
    store.move(own, f"{path}/{name}")
    store.move(own + ".head", f"{path}/{name}.head")


def _read(folder: str, name: str) -> tuple[dict[str, np.ndarray], bool]:
    """The arrays of a file, memory-mapped; from a store without a local path they are read instead (second value: mapped)."""
    store, path = _store(folder)
    with store.open_input_stream(f"{path}/{name}.head") as f:
        head = [h.split(",") for h in f.read().decode().split(";")]
    mapped = isinstance(store, pa.fs.LocalFileSystem)
    if not any(int(n) for *_, n in head):
        data = np.zeros(0, np.uint8)
    elif mapped:
        data = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        with store.open_input_file(f"{path}/{name}") as f:
            data = np.frombuffer(f.read(), np.uint8)
    arrays, at = {}, 0
    for k, kind, n in head:
        size = np.dtype(kind).itemsize * int(n)
        arrays[k] = data[at:at + size].view(kind)
        at += size + -size % 8
    return arrays, mapped


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and whether they are there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _small(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as single bytes; larger ones apart, with their places."""
    large = np.flatnonzero(counts >= 255)
    return {name: np.minimum(counts, 255).astype(np.uint8), f"{name}_at": large.astype(np.uint64), f"{name}_large": counts[large].astype(np.int64)}


def _counts(arrays: dict[str, np.ndarray], name: str, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Counts at some places; 0 where not ``there``."""
    out = np.zeros(len(at), np.int64)
    out[there] = arrays[name][at[there]]
    large = np.flatnonzero(out == 255)
    out[large] = arrays[f"{name}_large"][np.searchsorted(arrays[f"{name}_at"], at[large])]
    return out


# --- model -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the totals: training tokens, distinct ones, distinct pairs, discounts of pairs and of words."""

    folder: str
    bits: int
    frequent: tuple[int, ...]
    tokens: int
    words: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    unseen: float  # share of the continuation probabilities that the discounts leave


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2, 3 and more from n[0..3] items with counts 1 to 4; 0.5, 1, 1.5 where these say nothing."""
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        out = tuple(k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3))
        if all(0 <= d <= k + 1 for k, d in enumerate(out)):
            return out
    return (0.5, 1.0, 1.5)


def _route(context: np.ndarray, word: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of a pair: the high bits of its context's hash, of the pair's where the context is frequent."""
    spread = np.isin(context, frequent)
    out = np.where(spread, _pair(word, context), context)
    return (out >> np.uint64(64 - bits)).astype(np.int64)


def _frequent_contexts(texts: DataFrame, rows: int) -> np.ndarray:
    """Hashes of at most 1/FREQUENT frequent contexts, judged by about SAMPLE_TEXTS texts' beginnings. They only
    decide where pairs are added up, not what is counted."""
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(max(1, rows // SAMPLE_TEXTS))) == 0).select(F.substring("text", 1, 2000).alias("text"))
    found = [t for t, _ in tokens(r.text for r in some.limit(2 * SAMPLE_TEXTS).collect())]
    words, n = np.unique(np.concatenate([*found, np.array([BEGIN], np.uint64)]), return_counts=True)
    return words[(n >= FREQUENT * n.sum()) | (words == BEGIN)]


def _lists(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array([c], pa.list_(pa.from_numpy_dtype(c.dtype))) for c in columns]


def _joined(table: pa.Table, column: str) -> np.ndarray:
    out = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(column).chunks]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _counted(v: np.ndarray, w: np.ndarray, c: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their counts."""
    table = pa.table({"v": v, "w": w} | ({} if c is None else {"c": c}))
    out = table.group_by(["v", "w"], use_threads=False).aggregate([([], "count_all")] if c is None else [("c", "sum")])
    return tuple(x.to_numpy() for x in (out["v"], out["w"], out["count_all" if c is None else "c_sum"]))


def _pair_counts(texts: DataFrame, frequent: np.ndarray, bits: int) -> DataFrame:
    """(bucket, contexts, following, words, counts): the pairs of some texts, context by context."""

    def out(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        v, w, c = _counted(*(np.concatenate(p) for p in zip(*parts)), None)
        bucket = _route(v, w, frequent, bits)
        order = np.lexsort((v, bucket))
        v, w, c, bucket = v[order], w[order], c[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for lo, hi in zip(edges[:-1], edges[1:]):
            first = np.flatnonzero(np.diff(v[lo:hi], prepend=~v[lo]))
            runs = np.diff(np.append(first, hi - lo)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[lo]]), *_lists(v[lo:hi][first].view(np.int64), runs, w[lo:hi].view(np.int64), c[lo:hi].astype(np.int32))],
                names=["bucket", "contexts", "following", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, last = [], 0, END
        for now, _ in tokens(t.as_py() for b in batches for t in b.column(0)):
            parts.append((_before(now, last), now))
            last = now[-1] if len(now) else last
            size += len(now)
            if size >= COUNTED:
                yield from out(parts)
                parts, size = [], 0
        if parts:
            yield from out(parts)

    return texts.select("text").mapInArrow(run, "bucket long, contexts array<long>, following array<int>, words array<long>, counts array<int>")


def _write_pairs(folder: str, bits: int) -> Callable[[pa.Table], pa.Table]:
    """Of a bucket: write its pairs; return for each range of words what the pairs say about the words."""

    def run(table: pa.Table) -> pa.Table:
        v = np.repeat(_joined(table, "contexts"), _joined(table, "following"))
        v, w, c = _counted(v, _joined(table, "words"), _joined(table, "counts").astype(np.int64))
        v, w = v.view(np.uint64), w.view(np.uint64)
        keys = _pair(v, w)
        order = np.argsort(keys)
        _write(folder, f"pairs-{table.column('bucket')[0].as_py()}", key=keys[order], **_small("count", c[order]))
        of = np.bincount(np.minimum(c, 5), minlength=6)[1:5].astype(np.int64)
        facts = pa.table({"word": np.concatenate([v, w]).view(np.int64), "total": np.concatenate([c, np.zeros(len(w), np.int64)]),
                          **{f"n{k}": np.concatenate([(c == k if k < 3 else c >= 3), np.zeros(len(w), bool)]).astype(np.int64) for k in (1, 2, 3)},
                          "before": np.concatenate([np.zeros(len(v), np.int64), np.ones(len(w), np.int64)])})
        facts = facts.group_by("word", use_threads=False).aggregate([(x, "sum") for x in _FACTS])
        word = facts["word"].to_numpy().view(np.uint64)
        part = (word >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
        rows = []
        for lo, hi in zip(edges[:-1], edges[1:]):
            own = order[lo:hi]
            values = [facts[f"{x}_sum"].to_numpy()[own] for x in _FACTS]
            rows.append([pa.array([part[own[0]]]), *_lists(word[own].view(np.int64), *values), *_lists(of if not rows else np.zeros(4, np.int64))])
        return pa.concat_tables(pa.Table.from_arrays(r, names=["part", "word", *_FACTS, "of_counts"]) for r in rows)

    return run


_FACTS = ("total", "n1", "n2", "n3", "before")
_FACT_ROWS = "part long, word array<long>, " + ", ".join(f"{x} array<long>" for x in _FACTS) + ", of_counts array<long>"


def _write_words(folder: str) -> Callable[[pa.Table], pa.Table]:
    """Of a range of words: write what the pairs say about them; return totals."""

    def run(table: pa.Table) -> pa.Table:
        facts = pa.table({x: _joined(table, x) for x in ("word", *_FACTS)}).group_by("word", use_threads=False).aggregate([(x, "sum") for x in _FACTS])
        word = facts["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        value = {x: facts[f"{x}_sum"].to_numpy()[order] for x in _FACTS}
        arrays: dict[str, np.ndarray] = {"key": word[order]}
        for x in _FACTS:
            arrays |= _small(x, value[x])
        _write(folder, f"words-{table.column('part')[0].as_py()}", **arrays)
        pairs_of, before = _joined(table, "of_counts").reshape(-1, 4).sum(0), value["before"]
        of = np.concatenate([pairs_of, np.bincount(np.minimum(before, 5), minlength=6)[1:5], [(before >= 3).sum()]])
        totals = (value["total"].sum(), (before > 0).sum(), before.sum(), *of)
        return pa.table({c: [int(x)] for c, x in zip(_TOTALS, totals)})

    return run


_TOTALS = ("tokens", "words", "pairs", "p1", "p2", "p3", "p4", "w1", "w2", "w3", "w4", "three")


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Model of all texts of ``docs``; its files lie below the shared checkpoint folder."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    bits = max(3, int(np.ceil(np.log2(max(1, size / BUCKET_BYTES)))))
    folder = scratch_path(spark, "language-model")
    frequent = _frequent_contexts(texts, rows)
    facts = _pair_counts(texts, frequent, bits).groupBy("bucket").applyInArrow(_write_pairs(folder, bits), _FACT_ROWS)
    parts = facts.groupBy("part").applyInArrow(_write_words(folder), ", ".join(f"{c} long" for c in _TOTALS))
    sums = {c: v or 0 for c, v in parts.agg(*(F.sum(c).alias(c) for c in _TOTALS)).first().asDict().items()}
    word_discounts = discounts([sums[f"w{k}"] for k in (1, 2, 3, 4)])
    left = sum(d * sums[n] for d, n in zip(word_discounts, ("w1", "w2", "three")))
    return Model(folder, bits, tuple(int(x) for x in frequent), sums["tokens"], sums["words"], sums["pairs"],
                 discounts([sums[f"p{k}"] for k in (1, 2, 3, 4)]), word_discounts, left / sums["pairs"] if sums["pairs"] else 1.0)


class _Reader:
    """Log probabilities of tokens. Files stay mapped for the reader's life; those that had to be read are let go at once."""

    def __init__(self, model: Model):
        self.model, self.frequent = model, np.array(model.frequent, np.uint64)
        store, path = _store(model.folder)
        found = store.get_file_info(pa.fs.FileSelector(path, allow_not_found=True))
        self.names = {f.base_name for f in found if f.base_name.endswith(".head")}
        self.mapped: dict[str, dict[str, np.ndarray]] = {}

    def _parts(self, kind: str, part: np.ndarray) -> Iterator[tuple[slice, dict[str, np.ndarray]]]:
        """Slices of equal ``part`` numbers (sorted) with the arrays of that file."""
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for lo, hi in zip(edges[:-1], edges[1:]):
            name = f"{kind}-{part[lo]}"
            if name in self.mapped:
                yield slice(lo, hi), self.mapped[name]
            elif f"{name}.head" in self.names:
                arrays, mapped = _read(self.model.folder, name)
                if mapped:
                    self.mapped[name] = arrays
                yield slice(lo, hi), arrays

    def words(self, word: np.ndarray) -> dict[str, np.ndarray]:
        """What the pairs say about words (sorted hashes); a word's count is its total as a context."""
        out = {x: np.zeros(len(word), np.int64) for x in _FACTS}
        for own, arrays in self._parts("words", (word >> np.uint64(64 - self.model.bits)).astype(np.int64)):
            at, there = _found(arrays["key"], word[own])
            for x in _FACTS:
                out[x][own] = _counts(arrays, x, at, there)
        return out

    def pairs(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Counts of pairs."""
        route, key = _route(context, word, self.frequent, self.model.bits), _pair(context, word)
        order = np.lexsort((key, route))
        key, found = key[order], np.zeros(len(key), np.int64)
        for own, arrays in self._parts("pairs", route[order]):
            found[own] = _counts(arrays, "count", *_found(arrays["key"], key[own]))
        out = np.empty(len(key), np.int64)
        out[order] = found
        return out

    def logs(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count of the word, its base log10 probability, its log10 probability after the context) of every token."""
        m = self.model
        distinct, of = np.unique(np.concatenate([context, word, np.array([BEGIN], np.uint64)]), return_inverse=True)
        fact = self.words(distinct)
        times = fact["total"].copy()
        times[distinct == END] = times[of[-1]]  # the end is no context; it comes as often as the begin mark
        base = np.log10((times + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        lower = (_less(fact["before"], m.word_discounts) / m.pairs if m.pairs else 0) + m.unseen / (m.words + 1)
        mass = sum(d * fact[f"n{k}"] for k, d in enumerate(m.pair_discounts, 1))
        c, w = of[:len(context)], of[len(context):-1]
        pair, which = np.unique(_pair(context, word), return_index=True, return_inverse=True)[1:]
        c1, w1, seen = c[pair], w[pair], self.pairs(context[pair], word[pair])
        total = fact["total"][c1]
        known = np.maximum(total, 1)
        p = np.where(total > 0, _less(seen, m.pair_discounts) / known + mass[c1] / known * lower[w1], lower[w1])
        return times[w], base[w], np.log10(p)[which]


def _less(counts: np.ndarray, discount: tuple[float, float, float]) -> np.ndarray:
    """Discounted counts."""
    return counts - np.array([0.0, *discount])[np.minimum(counts, 3)]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row: tokens with the end, those seen in training, and
    the sums of their base and model log10 probabilities; perplexity is 10 ** (-score / n_tokens)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model)
        for batch in batches:
            sums = np.zeros((2, len(batch)), np.int64), np.zeros((2, len(batch)))
            last = END
            for now, of in tokens(t.as_py() for t in batch.column(1)):
                known, base, logs = reader.logs(_before(now, last), now)
                last = now[-1] if len(now) else last
                for out, values in ((sums[0][0], None), (sums[0][1], known > 0), (sums[1][0], base), (sums[1][1], logs)):
                    out += np.bincount(of, values, len(batch)).astype(out.dtype)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (*sums[0], *sums[1]))],
                                             names=["id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)


def held_out(id_column: Column) -> Column:
    """Rows whose texts are never learned: crc32 of the id as text leaves 1 when divided by 5."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document, by the model of those
    that are not held out; scores are rounded to six decimals, since sums of doubles depend on their order."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = score(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))
