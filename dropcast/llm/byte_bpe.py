"""Byte-level BPE through a sentencepiece model written directly from the vocabulary.

Every vocabulary entry (a byte string) becomes a piece of printable characters, one per byte, scored by
its negative rank, so that sentencepiece's best-score merge is the vocabulary's lowest-rank merge.
Normalisation is the identity; texts are cut into pre-tokens by the vocabulary's pattern first.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import text_slices

CACHE_ENTRIES = 400_000


def byte_characters() -> list[str]:
    """One printable, non-blank character per byte: bytes that print as themselves in Latin-1 stay,
    the others are numbered from U+0100."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field in protocol-buffer wire format."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece BPE model: piece id = rank, score = -rank, the unknown piece last."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))) or len({t for t in by_rank if len(t) == 1}) != 256:
        raise ValueError("the vocabulary must have ranks 0, 1, 2, ... and all 256 single bytes")
    chars = byte_characters()
    pieces = b"".join(_field(1, _field(1, "".join(map(chars.__getitem__, t)).encode()) + _field(2, -float(r)))
                      for r, t in enumerate(by_rank))
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    off = (1 << 64) - 1  # -1: no such piece
    # trainer: model type 2 is BPE; ids of unknown, begin, end, padding
    trainer = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)) + b"".join(_field(n, off) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))  # no prefix, nothing removed or escaped
    return pieces + unknown + _field(2, trainer) + _field(3, normalizer)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.pieces = sorted(ranks, key=ranks.__getitem__)
        self.find = regex.compile(pattern).findall
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.table = dict(enumerate(byte_characters()))
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = [self.find(t) for t in texts]
        new = set().union(*found).difference(self.known)
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known.clear()
            new = set().union(*found)
        new = list(new)
        for lo in range(0, len(new), 50_000):
            some = new[lo:lo + 50_000]
            mapped = [p.encode().decode("latin-1").translate(self.table) for p in some]
            self.known.update(zip(some, self.sp.encode(mapped, out_type=int, num_threads=1)))
        return [list(chain.from_iterable(map(self.known.__getitem__, f))) for f in found]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBPE:
    """One tokenizer per Python worker."""
    return ByteBPE(read_ranks(path), pattern)


def _per_text(docs: DataFrame, id_col: str, column: str, fields: list[T.StructField], rows) -> DataFrame:
    """Map (id, column) to (id, *fields); ``rows`` turns a list of values into a list of tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([docs.schema[id_col], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            ranges = text_slices(values) if pa.types.is_string(values.type) else [(i, min(i + 512, len(values))) for i in range(0, len(values), 512)]
            for lo, hi in ranges:
                out = rows(values.slice(lo, hi - lo).to_pylist())
                columns = [pa.array([o[k] for o in out], arrow.field(k + 1).type) for k in range(len(fields))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], schema=arrow)

    return docs.select(id_col, column).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row. Null and empty texts give no ids; every row comes back once,
    repeated ids included; other columns are ignored. No shuffle."""
    def rows(texts):
        return [(ids,) for ids in tokenizer(path, pattern).encode([t or "" for t in texts])]

    return _per_text(docs, id_col, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)], rows)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, data binary) of every row of ids; null ids give no bytes."""
    def rows(values):
        return [(tokenizer(path, pattern).decode(ids or []),) for ids in values]

    return _per_text(encoded, id_col, ids_col, [T.StructField("data", T.BinaryType(), False)], rows)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding, then decoding of the ids, in one pass, as digests."""
    def rows(texts):
        bpe = tokenizer(path, pattern)
        return [(len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(bpe.decode(ids)).hexdigest())
                for ids in bpe.encode([t or "" for t in texts])]

    kinds = (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))
    return _per_text(docs, id_col, text_col, [T.StructField(n, k, False) for n, k in kinds], rows)


def coded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_tokens, exact): encoding, and whether decoding the ids gives the text's bytes again."""
    def rows(texts):
        bpe, texts = tokenizer(path, pattern), [t or "" for t in texts]
        return [(ids, len(ids), bpe.decode(ids) == t.encode()) for t, ids in zip(texts, bpe.encode(texts))]

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("n_tokens", T.LongType(), False),
              T.StructField("exact", T.BooleanType(), False)]
    return _per_text(docs, id_col, text_col, fields, rows)
